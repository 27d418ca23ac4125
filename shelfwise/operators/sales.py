"""Sales windows, forecasts, category rankings and the new-user pool."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise import settings as S
from shelfwise.functions.dates import on_sale_less_than, pt_text
from shelfwise.operators.groups import dense_ranks
from shelfwise.sources.partitions import PartitionedTable, latest_rows, read_partitions


def valid_sale(dynamic: DataFrame, state: str | None = "") -> DataFrame:
    """Rows with a known sale; ``state=None`` accepts every state."""
    if state is None:
        return dynamic.filter(F.col("sale") != S.UNKNOWN_SALE)
    return dynamic.filter((F.col("sale") < S.UNKNOWN_SALE) & (F.col("state") == state))


def known_amount(dynamic: DataFrame) -> DataFrame:
    return dynamic.filter(F.col("amount").isNotNull() & ~F.isnan("amount"))


def sale_window(goods_dynamic: DataFrame | PartitionedTable, as_of: str, days: int = S.SALE_DAYS,
                state: str | None = "") -> DataFrame:
    """Sale per goods over the ``days`` days that end on ``as_of``."""
    return window_totals(goods_dynamic, as_of, days, state).select("goods_id", "sale")


def window_totals(goods_dynamic: DataFrame | PartitionedTable, as_of: str, days: int = S.SALE_DAYS,
                  state: str | None = "") -> DataFrame:
    """``sale_window`` with ``rows``, the number of rows in each sum; stored, it can be moved to the next day."""
    first = pt_text(as_of, 1 - days, dashed=True)
    last = pt_text(as_of, dashed=True)
    rows = valid_sale(read_partitions(goods_dynamic, first, last), state)
    return rows.groupBy("goods_id").agg(F.sum("sale").cast("bigint").alias("sale"), F.count(F.lit(1)).alias("rows"))


def moved_window(totals: DataFrame, goods_dynamic: DataFrame | PartitionedTable, as_of: str, days: int = S.SALE_DAYS,
                 state: str | None = "") -> DataFrame:
    """The totals of the window that ends on ``as_of`` from those of the window of the day before.

    Only two partitions are read: the new day is added and the day that leaves is taken off. Goods
    without rows in the new window leave it, whatever their sum; all other sums are exact.
    """
    new, old = pt_text(as_of, dashed=True), pt_text(as_of, -days, dashed=True)
    frame = goods_dynamic.frame if isinstance(goods_dynamic, PartitionedTable) else goods_dynamic
    sign = F.when(F.col("pt") == new, 1).otherwise(-1).cast("bigint")
    changes = (valid_sale(frame.filter(F.col("pt").isin(new, old)), state).withColumn("_sign", sign).groupBy("goods_id")
               .agg(F.sum(F.col("sale") * F.col("_sign")).alias("sale"), F.sum("_sign").alias("rows")))
    return (totals.select("goods_id", "sale", "rows").unionByName(changes).groupBy("goods_id")
            .agg(F.sum("sale").alias("sale"), F.sum("rows").alias("rows")).filter("rows > 0"))


def sale_with_forecast(sale: DataFrame, forecast: DataFrame | PartitionedTable, pt: str | None = None) -> DataFrame:
    """Sale with the prediction of one forecast partition, the latest unless one is given."""
    return (sale.join(latest_rows(forecast, pt).select("goods_id", "prediction"), "goods_id", "left")
            .select("goods_id", "sale", "prediction"))


def fresh_goods(goods_static: DataFrame, as_of: str, days: int = S.FRESH_DAYS) -> DataFrame:
    """Goods on sale for less than ``days`` days."""
    return goods_static.filter(on_sale_less_than(as_of, days)).select("goods_id")


def category_top_sale(sale: DataFrame, goods_category: DataFrame, k: int = S.CATEGORY_RANKS) -> DataFrame:
    """Best-selling goods per category; ties share a rank and all stay."""
    listed = sale.join(goods_category.select("goods_id", "category"), "goods_id", "left")
    ranked = dense_ranks(listed, ["category"], "sale", "rank_sale", k)
    return ranked.select("goods_id", "category", "rank_sale", F.lit(0).alias("rank_prediction"))


def category_top_prediction(sale: DataFrame, goods_category: DataFrame, goods_static: DataFrame,
                            as_of: str, k: int = S.CATEGORY_RANKS,
                            fresh_days: int | None = S.FRESH_DAYS) -> DataFrame:
    """The same by forecast, among fresh goods; ``fresh_days=None`` ranks all goods."""
    if fresh_days is not None:
        sale = sale.join(fresh_goods(goods_static, as_of, fresh_days), "goods_id", "left_semi")
    listed = sale.join(goods_category.select("goods_id", "category"), "goods_id", "left")
    ranked = dense_ranks(listed, ["category"], "prediction", "rank_prediction", k)
    return ranked.select("goods_id", "category", F.lit(0).alias("rank_sale"), "rank_prediction")


def category_top(sale: DataFrame, goods_category: DataFrame, goods_static: DataFrame, as_of: str,
                 k: int = S.CATEGORY_RANKS, fresh_days: int | None = S.FRESH_DAYS) -> DataFrame:
    by_sale = category_top_sale(sale, goods_category, k)
    by_prediction = category_top_prediction(sale, goods_category, goods_static, as_of, k, fresh_days)
    return by_sale.unionByName(by_prediction)


def newuser_pool(sale: DataFrame, goods_static: DataFrame, as_of: str, n: int = S.NEW_USER_POOL_SIZE,
                 fresh_days: int = S.FRESH_DAYS) -> DataFrame:
    """The n best sellers and the n best fresh forecasts, as goods of the new user."""
    best = sale.orderBy(F.col("sale").desc_nulls_last(), "goods_id").limit(n)
    fresh = sale.join(fresh_goods(goods_static, as_of, fresh_days), "goods_id", "left_semi")
    promising = fresh.orderBy(F.col("prediction").desc_nulls_last(), "goods_id").limit(n)
    return best.select("goods_id").unionByName(promising.select("goods_id")).select(
        F.lit(S.NEW_USER).alias("user_id"), "goods_id", F.lit(1).alias("total_support"))
