"""The pipeline and the registered queries on the smallest tables."""

import collections

import duckdb
import pytest

import corpus_pipeline
from shelfwise.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        rows = after.collect()
        assert after.columns == columns, name
        assert {r.doc_id for r in rows} <= {r.doc_id for r in before.collect()}
        before = spark.createDataFrame(rows, docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF).collect()
    lengths = collections.Counter()
    for r in packed:
        lengths[r.sequence_id] += r.length
    assert max(lengths.values()) <= 2048
    assert {r.doc_id for r in packed} == {r.doc_id for r in before.collect()}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    result = connection.execute(queries.ORACLES[name])
    columns = [c[0] for c in result.description]
    out = queries.QUERIES[name](spark, SF)
    assert sorted(out.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in out.collect()))) == sorted(map(repr, result.fetchall()))
