"""Sources, partitions, tables and column functions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from registry.base import query
from registry.bindings import AS_OF, DAYS, Retail
from shelfwise import settings as S
from shelfwise.functions import arrays, dates
from shelfwise.operators import catalog, sales
from shelfwise.session import shared_folder
from shelfwise.sources import documents, partitions, tables, versions

ITEM_ROWS = "SELECT user_id, type, pt, unnest(values) AS goods_id, "


@query("focus_flatten", """
    SELECT user_id, 'Customer#' || lpad(user_id, 9, '0') AS user_name, type, value FROM focus""")
def focus_flatten(t: Retail) -> DataFrame:
    return documents.focus_flatten(t.focus_raw)


@query("focus_flatten_unnamed", "SELECT user_id, type, value FROM focus")
def focus_flatten_unnamed(t: Retail) -> DataFrame:
    return documents.focus_flatten(t.focus_raw, with_name=False)


@query("category_nodes", "SELECT platform, node, parent, text, has_child FROM category_nodes")
def category_nodes(t: Retail) -> DataFrame:
    return documents.category_nodes(t.base_category)


@query("nodes_by_platform", f"""
    SELECT platform, block, count(*) AS n_nodes, string_agg(node || '<' || parent, ',' ORDER BY node, parent) AS nodes
    FROM (SELECT *, (row_number() OVER (PARTITION BY platform ORDER BY node, parent) - 1) // {S.LIST_BLOCK} AS block FROM category_nodes)
    GROUP BY platform, block""")
def nodes_by_platform(t: Retail) -> DataFrame:
    names = F.transform("nodes", lambda n: F.concat(n["node"], F.lit("<"), n["parent"]))
    return documents.nodes_by_platform(t.category_nodes).select(
        "platform", "block", F.size("nodes").cast("bigint").alias("n_nodes"),
        F.array_join(names, ",").alias("nodes"))


@query("potential_goods", "SELECT goods_id, array_to_string(tags, ',') AS tags, total_sale FROM potential")
def potential_goods(t: Retail) -> DataFrame:
    return documents.potential_goods(t.potential_raw).select(
        "goods_id", F.array_join("tags", ",").alias("tags"), "total_sale")


@query("potential_goods_ids", "SELECT goods_id FROM potential")
def potential_goods_ids(t: Retail) -> DataFrame:
    return documents.potential_goods(t.potential_raw, ids_only=True)


@query("read_partitions", """
    SELECT goods_id, sale, state, pt FROM goods_dynamic WHERE pt BETWEEN '2001-05-02' AND '2001-06-30'""")
def read_partitions(t: Retail) -> DataFrame:
    rows = partitions.read_partitions(t.dynamic, "2001-05-02", AS_OF)
    return rows.select("goods_id", "sale", "state", "pt")


@query("read_one_partition", "SELECT goods_id, sale, state, pt FROM goods_dynamic WHERE pt = '2001-06-30'")
def read_one_partition(t: Retail) -> DataFrame:
    return partitions.read_partitions(t.dynamic, AS_OF).select("goods_id", "sale", "state", "pt")


@query("read_unpartitioned", """
    SELECT goods_id, shop_id, strftime(generate_time, '%Y-%m-%d') AS generated FROM goods_static""")
def read_unpartitioned(t: Retail) -> DataFrame:
    return t.goods_static.select("goods_id", "shop_id",
                                 F.date_format("generate_time", dates.DASHED).alias("generated"))


# Tables. Each run writes its own table in the shared folder and reads it back.

def _history_table(t: Retail) -> str:
    """The recommendation history as a table partitioned by day."""
    name = f"shelfwise_history_{uuid.uuid4().hex}"
    path = f"{shared_folder(t.spark)}/shelfwise/{name}"
    t.recommend.write.partitionBy("pt").option("path", path).format("parquet").saveAsTable(name)
    return name


def _rows(table: DataFrame) -> DataFrame:
    return table.select("user_id", "type", F.explode("values").alias("goods_id"), "pt")


@query("overwrite_partition", """
    SELECT user_id, 'kept' AS type, unnest(values) AS goods_id, '20010629' AS pt
    FROM recommend WHERE pt = '20010628'
    UNION ALL SELECT user_id, type, unnest(values), pt FROM recommend WHERE pt <> '20010629'""")
def overwrite_partition(t: Retail) -> DataFrame:
    name = _history_table(t)
    other = t.recommend.filter(F.col("pt") == "20010628").withColumn("type", F.lit("kept"))
    tables.overwrite_partition(other, name, "20010629")
    return _rows(t.spark.table(name))


@query("save_partition_table", """
    SELECT user_id, type, unnest(values) AS goods_id, pt, TRUE AS saved, FALSE AS saved_incomplete FROM recommend
    UNION ALL SELECT user_id, type, unnest(values), '20010701', TRUE, FALSE FROM recommend WHERE pt = '20010629'""")
def save_partition_table(t: Retail) -> DataFrame:
    name = _history_table(t)
    latest = t.recommend.filter(F.col("pt") == "20010629")
    saved = tables.save_partition_table(latest.withColumn("extra", F.lit(1)), name, "20010701")
    incomplete = tables.save_partition_table(latest.drop("type"), name, "20010702")
    return _rows(t.spark.table(name)).select(
        "*", F.lit(saved).alias("saved"), F.lit(incomplete).alias("saved_incomplete"))


@query("create_table_if_not_exist", """
    SELECT user_id, type, unnest(values) AS goods_id, pt, 'user_id,type,values' AS columns
    FROM recommend WHERE pt = '20010629'""")
def create_table_if_not_exist(t: Retail) -> DataFrame:
    name = f"shelfwise_created_{uuid.uuid4().hex}"
    tables.create_table_if_not_exist(t.spark, name, t.recommend.schema)
    again = tables.create_table_if_not_exist(t.spark, name, t.recommend.schema)
    tables.overwrite_partition(t.recommend.filter(F.col("pt") == "20010629"), name, "20010629")
    return _rows(t.spark.table(name)).withColumn("columns", F.lit(",".join(again.fieldNames())))


@query("write_together", """
    SELECT 'history' AS source, user_id, goods_id, 1 AS n FROM (
        SELECT user_id, unnest(values) AS goods_id FROM recommend WHERE pt = '20010629')
    UNION ALL SELECT 'sale', NULL, goods_id, sale FROM sale_only""")
def write_together(t: Retail) -> DataFrame:
    """Two tables of one version, then one of them anew: readers see the last state of both."""
    folder = f"{shared_folder(t.spark)}/shelfwise/together-{uuid.uuid4().hex}"
    day = lambda pt: t.recommend.filter(F.col("pt") == pt).select("user_id", F.explode("values").alias("goods_id"))
    versions.write_together({"history": day("20010628"), "sale": sales.sale_window(t.recent, AS_OF, DAYS)}, folder)
    versions.write_together({"history": day("20010629")}, folder)
    last = versions.read_together(t.spark, folder)
    return last["history"].select(F.lit("history").alias("source"), "user_id", "goods_id", F.lit(1).cast("bigint").alias("n")).unionByName(
        last["sale"].select(F.lit("sale").alias("source"), F.lit(None).cast("string").alias("user_id"), "goods_id", F.col("sale").alias("n")))


@query("drop_table_if_exists", "SELECT pt, count(*) AS n_rows, FALSE AS still_there FROM recommend GROUP BY pt")
def drop_table_if_exists(t: Retail) -> DataFrame:
    name = f"shelfwise_dropped_{uuid.uuid4().hex}"
    tables.overwrite_table(t.recommend, name)
    counts = t.spark.table(name).groupBy("pt").agg(F.count(F.lit(1)).alias("n_rows"))
    kept = counts.collect()  # one row per partition
    tables.drop_table_if_exists(t.spark, name)
    tables.drop_table_if_exists(t.spark, name)
    there = t.spark.catalog.tableExists(name)
    return t.spark.createDataFrame(kept, counts.schema).withColumn("still_there", F.lit(there))


@query("export_table", """
    SELECT goods_id, NULL AS sale, prediction, pt FROM forecast_days
    UNION ALL SELECT goods_id, sale, NULL, pt FROM goods_dynamic""")
def export_table(t: Retail) -> DataFrame:
    folder = f"{shared_folder(t.spark)}/shelfwise/export-{uuid.uuid4().hex}"
    dynamic = t.goods_dynamic.select("goods_id", "sale", "pt")
    tables.export_tables({"forecast": t.forecast, "goods_dynamic": dynamic}, folder, "json")
    forecast = t.spark.read.schema(t.forecast.schema).json(f"{folder}/forecast")
    back = t.spark.read.schema(dynamic.schema).json(f"{folder}/goods_dynamic")
    return forecast.unionByName(back, allowMissingColumns=True)


@query("export_latest_partition", """
    SELECT goods_id, sale, pt FROM goods_dynamic WHERE pt = (SELECT max(pt) FROM goods_dynamic)""")
def export_latest_partition(t: Retail) -> DataFrame:
    path = f"{shared_folder(t.spark)}/shelfwise/export-{uuid.uuid4().hex}"
    latest = tables.latest_partition(t.spark, t.dynamic_table).select("goods_id", "sale", "pt")
    tables.export_table(latest, path)
    return t.spark.read.parquet(path)


# Partition look-ups.

@query("latest_pt", "SELECT replace(max(pt), '-', '') AS pt FROM goods_dynamic")
def latest_pt(t: Retail) -> DataFrame:
    return partitions.latest_pt(t.days)


@query("latest_pt_as_spelled", "SELECT max(pt) AS pt FROM goods_dynamic")
def latest_pt_as_spelled(t: Retail) -> DataFrame:
    return partitions.latest_pt(t.days, normalise=False)


@query("earliest_pt", "SELECT min(pt) AS pt FROM goods_dynamic")
def earliest_pt(t: Retail) -> DataFrame:
    return partitions.earliest_pt(t.days)


@query("partition_list", "SELECT DISTINCT pt FROM recommend")
def partition_list(t: Retail) -> DataFrame:
    return partitions.partition_list(t.spark, _history_table(t))


@query("has_partition_between", """
    SELECT bool_or(pt > '2001-06-29' AND pt <= '2001-06-30') AS found FROM goods_dynamic""")
def has_partition_between(t: Retail) -> DataFrame:
    return partitions.has_partition_between(
        t.days, "2001-06-29", "2001-06-30")


@query("has_partition_starts_with", "SELECT bool_or(starts_with(pt, '2001-07')) AS found FROM goods_dynamic")
def has_partition_starts_with(t: Retail) -> DataFrame:
    return partitions.has_partition_starts_with(t.days, "2001-07")


@query("has_partition", "SELECT bool_or(pt = '2003-01-01') AS found FROM goods_dynamic")
def has_partition(t: Retail) -> DataFrame:
    return partitions.has_partition(t.days, "2003-01-01")


@query("nearest_partition_before", "SELECT max(pt) AS pt FROM goods_dynamic WHERE pt < '2001-06-30'")
def nearest_partition_before(t: Retail) -> DataFrame:
    return partitions.nearest_partition_before(t.days, AS_OF)


# Date and array functions.

@query("shift_pt", """
    SELECT DISTINCT pt, strftime(CAST(pt AS DATE) - 6, '%Y%m%d') AS six_before,
           strftime(CAST(pt AS DATE) + 3, '%Y-%m-%d') AS three_after FROM goods_dynamic""")
def shift_pt(t: Retail) -> DataFrame:
    return t.days.select(
        "pt", dates.shift_pt("pt", -6).alias("six_before"),
        dates.shift_pt("pt", 3, dates.DASHED).alias("three_after"))


@query("pt_to_date", "SELECT DISTINCT pt, replace(pt, '-', '') AS respelled FROM goods_dynamic")
def pt_to_date(t: Retail) -> DataFrame:
    return partitions.respelled(t.days)


@query("pt_diff", """
    SELECT DISTINCT pt, CAST(datediff('day', CAST(pt AS DATE), DATE '2001-06-30') AS DOUBLE) AS days
    FROM goods_dynamic""")
def pt_diff(t: Retail) -> DataFrame:
    return t.days.select(
        "pt", dates.pt_diff("pt", F.lit(AS_OF)).alias("days"))


@query("relative_pt", """
    SELECT event_id, strftime(ts - INTERVAL 2 HOUR, '%Y%m%d%H') AS two_hours_before,
           strftime(CAST(ts AS DATE) + 1, '%Y%m%d') AS next_day FROM events""")
def relative_pt(t: Retail) -> DataFrame:
    return t.table("events").select(
        "event_id", dates.hour_pt_before("ts").alias("two_hours_before"),
        dates.next_day_pt("ts").alias("next_day"))


@query("array_to_vector", """
    SELECT goods_id, pt, sale + 0.5 AS first, amount AS second FROM goods_dynamic WHERE NOT isnan(amount)""")
def array_to_vector(t: Retail) -> DataFrame:
    values = F.array(F.col("sale") + F.lit(0.5).cast("double"), F.col("amount"))
    vectors = sales.known_amount(t.goods_dynamic).select("goods_id", "pt", arrays.array_to_vector(values).alias("v"))
    back = arrays.vector_to_array("v")
    return vectors.select("goods_id", "pt", F.get(back, F.lit(0)).alias("first"), F.get(back, F.lit(1)).alias("second"))


@query("to_array", "SELECT goods_id, 1 AS size, shop_id AS element FROM goods_static")
def to_array(t: Retail) -> DataFrame:
    one = arrays.to_array("shop_id")
    return t.goods_static.select("goods_id", F.size(one).alias("size"), F.get(one, F.lit(0)).alias("element"))


@query("intersect_keep_dup", """
    SELECT a.goods_id, array_to_string([x for x in list_concat(a.tags, a.tags) if list_contains(b.tags, x)], ',') AS shared
    FROM part_info a LEFT JOIN part_info b ON b.goods_id = a.goods_id + 1
    WHERE b.goods_id IS NOT NULL
    UNION ALL SELECT max(goods_id), NULL FROM part_info""")
def intersect_keep_dup(t: Retail) -> DataFrame:
    following = t.part.select((F.col("goods_id") - 1).alias("goods_id"), F.col("tags").alias("next_tags"))
    both = t.part.select("goods_id", F.concat("tags", "tags").alias("tags")).join(following, "goods_id", "left")
    shared = arrays.intersect_keep_dup("tags", "next_tags")
    return both.select("goods_id", F.array_join(shared, ",").alias("shared"))


@query("feature_columns", "SELECT goods_id % 7 AS f_one, goods_id * 2 AS f_two FROM part_info")
def feature_columns(t: Retail) -> DataFrame:
    wide = t.part.select("goods_id", (F.col("goods_id") % 7).alias("f_one"), (F.col("goods_id") * 2).alias("f_two"))
    return arrays.feature_columns(wide)


@query("typed_focus_goods", """
    SELECT user_id, CAST(value AS BIGINT) AS goods_id FROM focus WHERE type = 'goods'""")
def typed_focus_goods(t: Retail) -> DataFrame:
    ids = arrays.typed_id("value", t.goods_static.schema["goods_id"].dataType)
    return t.focus.filter(F.col("type") == "goods").select("user_id", ids.alias("goods_id"))


# Filters on the product tables.

@query("valid_sale", """
    SELECT goods_id, sale, pt FROM goods_dynamic
    WHERE sale < 2147483647 AND state = ''""")
def valid_sale(t: Retail) -> DataFrame:
    return sales.valid_sale(t.goods_dynamic).select("goods_id", "sale", "pt")


@query("valid_sale_any_state", """
    SELECT goods_id, sale, pt FROM goods_dynamic
    WHERE sale <> 2147483647""")
def valid_sale_any_state(t: Retail) -> DataFrame:
    return sales.valid_sale(t.goods_dynamic, None).select("goods_id", "sale", "pt")


@query("known_amount", "SELECT goods_id, amount, pt FROM goods_dynamic WHERE NOT isnan(amount)")
def known_amount(t: Retail) -> DataFrame:
    return sales.known_amount(t.goods_dynamic).select("goods_id", "amount", "pt")


@query("fresh_goods", "SELECT goods_id FROM fresh")
def fresh_goods(t: Retail) -> DataFrame:
    return sales.fresh_goods(t.goods_static, AS_OF)


@query("category_explode", "SELECT goods_id, shop_id, category FROM goods_category")
def category_explode(t: Retail) -> DataFrame:
    return catalog.category_explode(t.goods_static)


@query("category_explode_platform", "SELECT goods_id, shop_id, category FROM wish_category")
def category_explode_platform(t: Retail) -> DataFrame:
    return catalog.category_explode(t.goods_static, "WISH")


@query("tags_explode", "SELECT goods_id, pt, unnest(tags) AS tag FROM goods_dynamic")
def tags_explode(t: Retail) -> DataFrame:
    return t.goods_dynamic.select("goods_id", "pt", F.explode("tags").alias("tag"))
