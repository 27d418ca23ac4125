"""Every registered query against its SQL at the smallest scale, and list properties."""

import math

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def shape(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    df = entry.queries()[name](spark, SF)
    result = sql.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert shape(df.columns, df.collect()) == shape(columns, result.fetchall())


def test_lists_before_the_fallback(spark):
    got = {}
    for r in entry.queries()["result_lists"](spark, SF).collect():
        got[r.user_id, r.type] = r.goods.split(",")
    for (user, kind), goods in got.items():
        assert len(goods) <= 5 and len(set(goods)) == len(goods)
        if kind == "hot":
            assert not set(goods) & set(got.get((user, "potential"), []))
    shown = {(r.user_id, str(r.goods_id)) for r in entry.queries()["recent_pairs"](spark, SF).collect()}
    assert not shown & {(u, g) for (u, _), goods in got.items() for g in goods}
