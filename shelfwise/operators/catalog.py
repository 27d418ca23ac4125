"""Category lists of the goods catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise import settings as S


def category_explode(goods_static: DataFrame, platform: str | None = None,
                     null_as: str | None = S.NULL_CATEGORY) -> DataFrame:
    """One row per goods and category id, over all platforms or over one.

    Without ``platform`` a null id becomes ``null_as``; with it, ids stay as they are.
    """
    if platform is not None:
        ids = F.explode(F.try_element_at("category", F.lit(platform)))
        return goods_static.select("goods_id", "shop_id", ids.alias("category"))
    lists = goods_static.select("goods_id", "shop_id", F.explode("category").alias("platform", "ids"))
    rows = lists.select("goods_id", "shop_id", F.explode("ids").alias("category"))
    if null_as is None:
        return rows
    return rows.withColumn("category", F.coalesce("category", F.lit(null_as)))
