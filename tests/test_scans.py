"""What scans read, seen in their plans, and look-ups that open no file."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import sales, similarity
from shelfwise.session import CLUSTER_CONF, prepared
from shelfwise.sources import documents, partitions, tables

DAYS = ["2001-06-28", "2001-06-29", "2001-06-30"]
SCHEMA = "goods_id bigint, sale bigint, amount double, tags array<string>, state string, pt string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("scans") / "dynamic")
    rows = [(g, g * 10, 1.0, ["a"], "" if g else "off", day) for day in DAYS for g in range(5)]
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("pt").parquet(path)
    return path


def scan(df, field):
    """A field of the only file scan in the plan."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    (found,) = re.findall(rf"^{field}: (.*)$", plan, re.M)
    return found


def test_one_partition_and_a_range(spark, folder):
    table = partitions.PartitionedTable.of_folder(spark, folder, SCHEMA)
    one = partitions.read_partitions(table, "2001-06-29").select("goods_id")
    assert one.count() == 5 and "= 2001-06-29)" in scan(one, "PartitionFilters")
    some = partitions.read_partitions(table, "2001-06-29", "2001-06-30").select("goods_id")
    filters = scan(some, "PartitionFilters")
    assert some.count() == 10 and ">= 2001-06-29)" in filters and "<= 2001-06-30)" in filters
    assert scan(some, "ReadSchema") == "struct<goods_id:bigint>"


def test_filters_and_columns_reach_the_scan(spark, folder):
    table = partitions.PartitionedTable.of_folder(spark, folder, SCHEMA)
    window = sales.valid_sale(partitions.read_partitions(table, "2001-06-29", "2001-06-30")).select("goods_id", "sale")
    assert "LessThan(sale,2147483647)" in scan(window, "PushedFilters") and "EqualTo(state,)" in scan(window, "PushedFilters")
    assert scan(window, "ReadSchema") == "struct<goods_id:bigint,sale:bigint,state:string>"


def test_potential_scan_reads_the_asked_columns(spark, tmp_path):
    path = str(tmp_path / "potential")
    spark.createDataFrame([("1", ["a"], 2.0)], documents.POTENTIAL_SCHEMA).write.parquet(path)
    raw = documents.read_documents(spark, path, documents.POTENTIAL_SCHEMA, "parquet")
    assert scan(documents.potential_goods(raw, ids_only=True), "ReadSchema") == "struct<goodsId:string>"
    assert "totalSale" in scan(documents.potential_goods(raw), "ReadSchema")


def test_look_ups_open_no_file(spark, folder, tmp_path):
    """The files of this table are no parquet files."""
    for day in DAYS:
        (tmp_path / f"pt={day}").mkdir()
        (tmp_path / f"pt={day}" / "part-0.parquet").write_text("not parquet")
    broken = partitions.PartitionedTable.of_folder(spark, str(tmp_path), SCHEMA)
    assert broken.names == tuple(DAYS)
    assert partitions.day_to_run(broken) == DAYS[-1] and partitions.day_to_run(broken, DAYS[0]) == DAYS[0]
    with pytest.raises(ValueError, match="no partition"):
        partitions.day_to_run(broken, "2001-07-01")
    assert "= 2001-06-30)" in scan(partitions.latest_rows(broken), "PartitionFilters")
    assert partitions.latest_rows(partitions.PartitionedTable.of_folder(spark, folder, SCHEMA)).select("pt").distinct().collect() == [(DAYS[-1],)]


def test_catalogue_names(spark, folder, tmp_path):
    spark.read.schema(SCHEMA).parquet(folder).write.partitionBy("pt").option("path", str(tmp_path / "t")).saveAsTable("scans_of_a_table")
    try:
        table = partitions.PartitionedTable.of_table(spark, "scans_of_a_table")
        assert table.names == tuple(DAYS)
        latest = partitions.latest_rows(table)
        assert latest.count() == 5 and "= 2001-06-30)" in scan(latest, "PartitionFilters")
        for part in Path(tmp_path / "t").glob("*/*.parquet"):
            part.write_text("broken")
        assert partitions.PartitionedTable.of_table(spark, "scans_of_a_table").names == tuple(DAYS)
    finally:
        spark.sql("DROP TABLE scans_of_a_table")


def test_table_without_partitions(spark):
    none = partitions.PartitionedTable(spark.createDataFrame([], SCHEMA), ())
    assert partitions.latest_rows(none).count() == 0
    with pytest.raises(ValueError, match="no partition"):
        partitions.day_to_run(none)


def test_sessions_built_elsewhere(spark):
    name = "spark.sql.unionOutputPartitioning"
    other = spark.newSession()
    other.conf.set(name, "true")
    prepared(other)
    assert other.conf.get(name) == CLUSTER_CONF[name]


def test_window_that_moves_reads_two_partitions(spark, folder):
    """Two days, unknown and off rows, goods that leave, come back and have a sum of zero."""
    rows = [(1, 5, 0.0, None, "", "2001-06-27"), (1, 7, 0.0, None, "", "2001-06-29"), (2, 3, 0.0, None, "", "2001-06-28"),
            (3, 2147483647, 0.0, None, "", "2001-06-29"), (4, 4, 0.0, None, "off", "2001-06-30"), (5, 0, 0.0, None, "", "2001-06-30"),
            (6, -2, 0.0, None, "", "2001-06-29"), (6, 2, 0.0, None, "", "2001-06-30"), (7, None, 0.0, None, "", "2001-06-29")]
    dynamic = spark.createDataFrame(rows, SCHEMA)
    totals = sales.window_totals(dynamic, "2001-06-28", 2)
    for day in ("2001-06-29", "2001-06-30", "2001-07-01", "2001-07-02"):
        totals = sales.moved_window(totals, dynamic, day, 2)
        want = sales.window_totals(dynamic, day, 2)
        assert sorted(totals.collect()) == sorted(want.collect())
    table = partitions.PartitionedTable.of_folder(spark, folder, SCHEMA)
    moved = sales.moved_window(spark.createDataFrame([], "goods_id bigint, sale bigint, rows bigint"), table, DAYS[-1], 2)
    assert re.search(r"pt#\d+ IN \(2001-06-30,2001-06-28\)", scan(moved, "PartitionFilters"))


def test_bucketed_history_is_not_shuffled(spark, rows):
    table = "bucketed_history"
    schema = "user_id string, type string, `values` array<bigint>, pt string"
    history = spark.createDataFrame([(f"u{i % 40}", kind, [i, i + 1, i], pt) for i in range(80) for kind in ("hot", "potential")
                                     for pt in ("20010628", "20010629")], schema)
    tables.drop_table_if_exists(spark, table)
    tables.create_table_if_not_exist(spark, table, history.schema, buckets=8, by=["user_id"])
    for pt in ("20010628", "20010629"):
        tables.overwrite_partition(history.filter(F.col("pt") == pt), table, pt)
    assert tables.bucketing(spark, table) == (8, ["user_id"])
    assert rows(spark.table(table)) == rows(history)
    lists = spark.createDataFrame([(f"u{i % 50}", g, g) for i in range(50) for g in range(i, i + 4)], "user_id string, goods_id bigint, position int")
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = similarity.suppress_history(lists, spark.table(table), "hot", "2001-06-30")
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert rows(got) == rows(similarity.suppress_history(lists, history, "hot", "2001-06-30"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
        tables.drop_table_if_exists(spark, table)
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    above = []
    for line in reversed(lines[:at]):
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < depth:
            above.append(line.strip(" :+-"))
            depth = indent
    assert above and not any(line.startswith("Exchange") for line in above) and any("Exchange" in line for line in lines)
