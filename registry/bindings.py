"""The retail tables of the library, derived from the given TPC-H-like tables.

Every order line tells what its customer follows: lines 1, 5 a goods, lines 2, 6 a shop,
lines 3, 7 the tags of the part, line 4 a category. All customers and all lines take part.
Some parts carry markers (unknown sale, unknown amount, off state, no category), so that
the rules for such rows have something to do.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import replace
from datetime import timedelta
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfwise import settings as S
from shelfwise.functions.dates import as_day, pt_text
from shelfwise.plans.rules_daily import RuleInputs
from shelfwise.plans.similarity_daily import SimilarityInputs
from shelfwise.session import shared_folder, staged
from shelfwise.sources.documents import category_nodes, potential_goods
from shelfwise.sources.partitions import PartitionedTable, partition_list

# The day and window all queries use; 60 days so that sales meet forecasts.
AS_OF = "2001-06-30"
DAYS = 60
MIN_TAGS = 3
PROMISING = 30
#: Order lines that one task takes from an exchange where they are joined to their owners and parts.
LINES_PER_TASK = 250_000


def ship_date_between(first: int, last: int) -> Column:
    day = as_day(AS_OF)
    return F.col("l_shipdate").between(F.lit(day + timedelta(days=first)),
                                       F.lit(day + timedelta(days=last)))


class Retail:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def part(self) -> DataFrame:
        size = F.concat(F.lit("size"), F.floor(F.col("p_size") / 10))
        return self.table("part").select(
            F.col("p_partkey").alias("goods_id"), "p_type", "p_brand",
            F.concat("p_type", F.lit("/"), "p_brand").alias("category_id"),
            F.concat(F.split("p_name", " "), F.array("p_type", "p_brand", size)).alias("tags"))

    @cached_property
    def goods_static(self) -> DataFrame:
        shops = self.table("lineitem").groupBy(F.col("l_partkey").alias("goods_id")).agg(
            F.min("l_suppkey").alias("shop_id"))
        key = F.col("goods_id")
        first = F.when(key % 53 != 0, F.col("category_id"))
        categories = F.create_map(
            F.lit(S.DEFAULT_PLATFORM), F.array(first, F.col("p_type")),
            F.lit("OTHER"), F.array("p_brand"))
        return self.part.join(shops, "goods_id", "left").select(
            "goods_id", "shop_id",
            F.when(key % 59 != 0, categories).alias("category"),
            F.date_sub(F.lit(as_day(AS_OF)), (key % 120).cast("int")).alias("generate_time"))

    def _dynamic(self, lines: DataFrame) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        discount = F.col("l_discount").cast("decimal(4,2)")
        key = F.col("goods_id")
        daily = lines.groupBy(F.col("l_partkey").alias("goods_id"),
                              F.date_format("l_shipdate", "yyyy-MM-dd").alias("pt")).agg(
            F.sum("l_quantity").cast("bigint").alias("sold"),
            F.sum(price * (1 - discount)).cast("double").alias("turnover"))
        return daily.join(self.part.select("goods_id", "tags"), "goods_id").select(
            "goods_id",
            F.when(key % 97 == 0, F.lit(S.UNKNOWN_SALE)).otherwise(F.col("sold")).alias("sale"),
            F.when(key % 83 == 0, F.lit(float("nan"))).otherwise(F.col("turnover")).alias("amount"),
            "tags",
            F.when(key % 89 == 0, "off").otherwise("").alias("state"),
            "pt")

    @cached_property
    def goods_dynamic(self) -> DataFrame:
        # Dealt out by goods once, for the sums of a day as well as for the tags.
        return self._dynamic(self.table("lineitem").repartition("l_partkey"))

    def dynamic_days(self, first: int, last: int) -> DataFrame:
        """Days relative to AS_OF; the range reaches the parquet scan."""
        return self._dynamic(self.table("lineitem").filter(ship_date_between(first, last)))

    @cached_property
    def recent(self) -> DataFrame:
        return self.dynamic_days(1 - DAYS, 0)

    @cached_property
    def day(self) -> DataFrame:
        return self.dynamic_days(0, 0)

    @cached_property
    def latest_forecast(self) -> DataFrame:
        ahead = self.dynamic_days(1, DAYS).filter(F.col("sale") != S.UNKNOWN_SALE)
        return ahead.groupBy("goods_id").agg(F.sum("sale").cast("double").alias("prediction")).withColumn(
            "pt", F.lit(pt_text(AS_OF)))

    @cached_property
    def forecast(self) -> DataFrame:
        """Two days of forecasts; the older one is different for every goods, so it must not be used."""
        stale = self.latest_forecast.select(
            "goods_id", (F.col("prediction") * 3 + 1).alias("prediction"), F.lit(pt_text(AS_OF, -1)).alias("pt"))
        return staged(self.latest_forecast.unionByName(stale), "forecast")

    @cached_property
    def potential_raw(self) -> DataFrame:
        sold = self.recent.filter(F.col("sale") != S.UNKNOWN_SALE).groupBy("goods_id").agg(
            F.sum("sale").cast("double").alias("totalSale"))
        promising = self.latest_forecast.filter(F.col("prediction") >= PROMISING).select("goods_id")
        return (promising.join(self.part.select("goods_id", "tags"), "goods_id")
                .join(sold, "goods_id", "left")
                .select(F.col("goods_id").alias("goodsId"), "tags", "totalSale"))

    @cached_property
    def potential(self) -> DataFrame:
        return potential_goods(self.potential_raw)

    @cached_property
    def base_category(self) -> DataFrame:
        main, root = F.lit(S.DEFAULT_PLATFORM), F.lit(S.ROOT_PARENT)
        children = self.part.select(
            main.alias("platform"), F.col("category_id").alias("categoryId"),
            F.col("p_type").alias("pcid"), F.col("p_brand").alias("categoryName"),
            F.lit(False).alias("hasChild"))
        roots = self.part.select(main, "p_type", root, "p_type", F.lit(True))
        other = self.part.select(F.lit("OTHER"), "p_brand", root, "p_brand", F.lit(False))
        return children.union(roots).union(other).distinct()

    @cached_property
    def category_nodes(self) -> DataFrame:
        return category_nodes(self.base_category)

    @cached_property
    def tree_nodes(self) -> DataFrame:
        """The categories and a platform of hard cases from the given tables.

        Part sizes form one chain of up to 50 levels, with a leaf below each; nations are the
        parents of one another in pairs; the parents of regions do not exist.
        """
        sizes = self.table("part").select("p_size").distinct()
        before = F.lag("p_size").over(Window.orderBy("p_size"))  # at most 50 rows
        deep, yes, no = F.lit("DEEP").alias("platform"), F.lit(True).alias("has_child"), F.lit(False).alias("has_child")
        name = F.concat(F.lit("size "), F.col("p_size"))
        chain = sizes.select(deep, name.alias("node"), F.coalesce(F.concat(F.lit("size "), before), F.lit(S.ROOT_PARENT)).alias("parent"),
                             name.alias("text"), yes)
        leaves = sizes.select(deep, F.lit("sized").alias("node"), name.alias("parent"), F.lit("sized").alias("text"), no)
        nation, other = (F.concat(F.lit("nation "), c) for c in (F.col("n_nationkey"), F.col("n_nationkey").bitwiseXOR(1)))
        cycles = self.table("nation").select(deep, nation.alias("node"), other.alias("parent"), F.col("n_name").alias("text"), yes)
        orphans = self.table("region").select(deep, F.col("r_name").alias("node"), F.concat(F.lit("no "), "r_name").alias("parent"),
                                              F.col("r_name").alias("text"), no)
        return reduce(DataFrame.unionByName, [self.category_nodes, chain, leaves, cycles, orphans])

    @cached_property
    def dynamic_table(self) -> str:
        """Name of a table of all days of the products, partitioned by day; made once for a session and folder."""
        name = "shelfwise_dynamic_" + hashlib.sha256(
            f"{self.spark.sparkContext.applicationId} {self.sf_dir}".encode()).hexdigest()[:16]
        if not self.spark.catalog.tableExists(name):
            path = f"{shared_folder(self.spark)}/shelfwise/{name}"
            (self.goods_dynamic.select("goods_id", "sale", "amount", "tags", "state", "pt").repartition("pt").write
             .partitionBy("pt").option("path", path).format("parquet").saveAsTable(name))
        return name

    @cached_property
    def dynamic(self) -> PartitionedTable:
        return PartitionedTable.of_table(self.spark, self.dynamic_table)

    @cached_property
    def forecast_table(self) -> PartitionedTable:
        """The forecasts as files below a folder for each day."""
        path = f"{shared_folder(self.spark)}/shelfwise/forecast-{uuid.uuid4().hex}"
        self.forecast.write.partitionBy("pt").parquet(path)
        return PartitionedTable.of_folder(self.spark, path, self.forecast.schema)

    @cached_property
    def days(self) -> DataFrame:
        return partition_list(self.spark, self.dynamic_table)

    def dealt(self, rows: DataFrame, *keys: str) -> DataFrame:
        """Rows dealt out by the keys to as many tasks as the number of order lines asks for, so that the memory of
        one does not grow with them; left to Spark where the session's number of partitions is enough."""
        tasks = -(-self.n_lines // LINES_PER_TASK)
        few = tasks <= int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return rows if few else rows.repartition(tasks, *keys)

    @cached_property
    def n_lines(self) -> int:
        """The number of order lines, which parquet files tell without being read."""
        return self.table("lineitem").count()

    @cached_property
    def followed_pairs(self) -> DataFrame:
        """Distinct (user, type, value) with the first order that shows it."""
        kinds = F.array(*[F.lit(k) for k in (S.FOCUS_GOODS, S.FOCUS_SHOP, S.FOCUS_TAG, S.FOCUS_CATEGORY)])
        lines = self.table("lineitem").select(
            "l_orderkey", F.col("l_partkey").alias("goods_id"), "l_suppkey",
            F.get(kinds, (F.col("l_linenumber") - 1) % 4).alias("type"))
        owners = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        values = (F.when(F.col("type") == S.FOCUS_GOODS, F.array(F.col("goods_id").cast("string")))
                  .when(F.col("type") == S.FOCUS_SHOP, F.array(F.col("l_suppkey").cast("string")))
                  .when(F.col("type") == S.FOCUS_TAG, F.col("tags"))
                  .otherwise(F.array("category_id")))
        owned = self.dealt(lines, "l_orderkey").join(self.dealt(owners, "l_orderkey"), "l_orderkey")
        rows = self.dealt(owned, "goods_id").join(
            self.dealt(self.part.select("goods_id", "tags", "category_id"), "goods_id"), "goods_id")
        followed = rows.select(
            F.col("o_custkey").cast("string").alias("user_id"), "type",
            F.explode(values).alias("value"), "l_orderkey")
        return self.dealt(followed, "user_id", "type", "value").groupBy("user_id", "type", "value").agg(F.min("l_orderkey").alias("document"))

    @cached_property
    def focus(self) -> DataFrame:
        return self.followed_pairs.select("user_id", "type", "value")

    @cached_property
    def focus_raw(self) -> DataFrame:
        """One document per user, type and order; an order has few lines, so it stays short."""
        prefix = F.when(F.col("type") == S.FOCUS_CATEGORY, S.DEFAULT_PLATFORM + ".").otherwise("")
        item = F.struct(F.concat(prefix, F.col("value")).alias("id"))
        return self.dealt(self.followed_pairs, "user_id", "type", "document").groupBy("user_id", "type", "document").agg(
            F.collect_list(item).alias("values")).select(
            F.col("user_id").alias("userId"),
            F.concat(F.lit("Customer#"), F.lpad("user_id", 9, "0")).alias("userName"),
            "type", "values")

    @cached_property
    def recommend(self) -> DataFrame:
        n_parts = self.table("part").agg(F.count(F.lit(1))).scalar()
        days = self.table("orders").select("o_custkey").distinct().select(
            "o_custkey", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("k"))
        shown = F.transform(F.sequence(F.lit(0), F.lit(4)),
                            lambda j: (F.col("o_custkey") * 7 + F.col("k") * 13 + j * 31) % F.col("n"))
        return days.withColumn("n", n_parts).select(
            F.col("o_custkey").cast("string").alias("user_id"),
            F.when(F.col("k") % 2 == 1, S.HOT).otherwise(S.POTENTIAL).alias("type"),
            shown.alias("values"),
            F.date_format(F.date_sub(F.lit(as_day(AS_OF)), F.col("k")), "yyyyMMdd").alias("pt"))

    @cached_property
    def rule_inputs(self) -> RuleInputs:
        """Inputs of the daily plan as stored tables, which is what a daily plan reads."""
        dynamic = staged(self.recent, "dynamic")
        forecast = self.forecast_table
        return RuleInputs(staged(self.focus, "focus"), staged(self.goods_static, "static"), dynamic,
                          forecast, staged(self.potential, "potential"), self.recommend)

    @cached_property
    def whole_rule_inputs(self) -> RuleInputs:
        """The same with the table of all days of the products, later ones too, from which a plan reads its window."""
        return replace(self.rule_inputs, goods_dynamic=self.dynamic)

    @cached_property
    def similarity_inputs(self) -> SimilarityInputs:
        rule = self.rule_inputs
        return SimilarityInputs(rule.focus, rule.goods_static, rule.goods_dynamic, rule.forecast,
                                rule.potential, rule.recommend, self.category_nodes)
