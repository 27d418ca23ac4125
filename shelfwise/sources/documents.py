"""Nested documents with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, StringType, StructField,
                               StructType)

from shelfwise import settings as S
from shelfwise.operators.groups import block_list, in_blocks

FOCUS_SCHEMA = StructType([
    StructField("userId", StringType()),
    StructField("userName", StringType()),
    StructField("type", StringType()),
    StructField("values", ArrayType(StructType([StructField("id", StringType())]))),
])
CATEGORY_SCHEMA = StructType([
    StructField("platform", StringType()),
    StructField("categoryId", StringType()),
    StructField("pcid", StringType()),
    StructField("categoryName", StringType()),
    StructField("hasChild", BooleanType()),
])
POTENTIAL_SCHEMA = StructType([
    StructField("goodsId", StringType()),
    StructField("tags", ArrayType(StringType())),
    StructField("totalSale", DoubleType()),
])


def read_documents(spark: SparkSession, path: str, schema: StructType, fmt: str = "json") -> DataFrame:
    """Documents under a declared schema: no inference pass, and an empty source is fine."""
    return spark.read.schema(schema).format(fmt).load(path)


def focus_flatten(focus_raw: DataFrame, with_name: bool = True) -> DataFrame:
    """One row per followed value; a category id keeps what follows its first dot."""
    value = F.col("item.id")
    dotted = (F.col("type") == S.FOCUS_CATEGORY) & value.contains(".")
    rows = focus_raw.withColumn("item", F.explode("values")).select(
        F.col("userId").alias("user_id"),
        F.col("userName").alias("user_name"),
        "type",
        F.when(dotted, F.get(F.split(value, r"\."), F.lit(1))).otherwise(value).alias("value"),
    )
    return rows if with_name else rows.drop("user_name")


def category_nodes(base_category: DataFrame) -> DataFrame:
    return base_category.select(
        "platform",
        F.col("categoryId").alias("node"),
        F.col("pcid").alias("parent"),
        F.col("categoryName").alias("text"),
        F.col("hasChild").alias("has_child"),
    )


def nodes_by_platform(nodes: DataFrame, block: int = S.LIST_BLOCK) -> DataFrame:
    """Node lists per platform, sorted, repeats kept, in blocks of ``block`` nodes."""
    fields = ["node", "parent", "text", "has_child"]
    counted = nodes.groupBy("platform", *fields).agg(F.count(F.lit(1)).alias("copies"))
    dealt = in_blocks(counted, ["platform"], fields, block).withColumn("record", F.struct(*fields))
    return dealt.groupBy("platform", "block").agg(block_list("record").alias("nodes"))


def potential_goods(potential_raw: DataFrame, ids_only: bool = False) -> DataFrame:
    """Potential goods; only the asked columns are read from the source."""
    goods = potential_raw.select(F.col("goodsId").alias("goods_id"), "tags",
                                 F.col("totalSale").alias("total_sale"))
    return goods.select("goods_id") if ids_only else goods
