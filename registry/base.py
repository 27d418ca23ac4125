"""Registration of queries and of the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from registry.bindings import Retail
from registry.sql_tables import with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(retail) -> DataFrame`` under ``name``.

    ``sql`` is written over the logical tables of ``sql_tables``; those it mentions are
    put in front of it as common table expressions.
    """
    def keep(build: Callable[[Retail], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Retail(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return build
    return keep
