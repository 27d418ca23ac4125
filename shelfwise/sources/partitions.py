"""Partition scans and look-ups over a table's partition names."""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from shelfwise.functions.dates import COMPACT, date_to_pt, pt_to_date


@dataclass(frozen=True)
class PartitionedTable:
    """A frame partitioned by ``pt`` and the names of its partitions, which no look-up has to read files for.

    There is a name a day, so the names are few whatever the size of the table.
    """

    frame: DataFrame
    names: tuple[str, ...]

    @classmethod
    def of_table(cls, spark: SparkSession, name: str) -> PartitionedTable:
        """A table of the catalogue, with the catalogue's names."""
        return cls(spark.table(name), tuple(sorted(r.pt for r in partition_list(spark, name).collect())))

    @classmethod
    def of_folder(cls, spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet") -> PartitionedTable:
        """Files below ``pt=...`` folders, with the names of the folders; ``schema`` has the column pt."""
        frame = spark.read.schema(schema).format(fmt).load(path)
        found = (re.search(r"/pt=([^/]*)/[^/]*$", file) for file in frame.inputFiles())
        return cls(frame, tuple(sorted({unquote(m[1]) for m in found if m})))


def read_partitions(table: DataFrame | PartitionedTable, pt_from: str, pt_to: str | None = None) -> DataFrame:
    """Rows of one partition, or of a closed range of partitions."""
    frame = table.frame if isinstance(table, PartitionedTable) else table
    if pt_to is None:
        return frame.filter(F.col("pt") == pt_from)
    return frame.filter(F.col("pt").between(pt_from, pt_to))


def partition_list(spark: SparkSession, table: str) -> DataFrame:
    """Partition names from the catalogue alone; no data file is opened."""
    return spark.sql(f"SHOW PARTITIONS {table}").select(
        F.regexp_extract("partition", r"^[^=]+=([^/]*)", 1).alias("pt"))


def distinct_partitions(table: DataFrame) -> DataFrame:
    """The same list from a frame that has no catalogue entry."""
    return table.select("pt").distinct()


def _latest_name(table: DataFrame | PartitionedTable) -> str | None:
    if isinstance(table, PartitionedTable):
        return max(table.names, default=None)
    return as_value(latest_pt(distinct_partitions(table), normalise=False))


def latest_rows(table: DataFrame | PartitionedTable, pt: str | None = None) -> DataFrame:
    """Rows of the given or else the greatest partition, pruned by a literal name. An empty table stays as it is.

    A ``PartitionedTable`` knows the name; for a plain frame its column pt is read.
    """
    name = pt if pt is not None else _latest_name(table)
    frame = table.frame if isinstance(table, PartitionedTable) else table
    return frame if name is None else frame.filter(F.col("pt") == name)


def day_to_run(table: DataFrame | PartitionedTable, as_of: str | None = None) -> str:
    """The given day, which must be a partition of the table, or its latest one; with dashes. Looked up as in ``latest_rows``."""
    if as_of is None:
        as_of = _latest_name(table)
        if as_of is None:
            raise ValueError("the table has no partition")
    elif not (as_of in table.names if isinstance(table, PartitionedTable) else as_value(has_partition(distinct_partitions(table), as_of))):
        raise ValueError(f"the table has no partition {as_of}")
    return as_of


def _spelling(normalise: bool):
    return F.replace(F.col("pt"), F.lit("-"), F.lit("")) if normalise else F.col("pt")


def latest_pt(partitions: DataFrame, normalise: bool = True) -> DataFrame:
    """Greatest partition name, by default without dashes."""
    return partitions.agg(F.max(_spelling(normalise)).alias("pt"))


def earliest_pt(partitions: DataFrame, normalise: bool = False) -> DataFrame:
    return partitions.agg(F.min(_spelling(normalise)).alias("pt"))


def has_partition_between(partitions: DataFrame, start: str, stop: str) -> DataFrame:
    """Is there a partition after ``start``, up to and including ``stop``?"""
    return _any(partitions, (F.col("pt") > start) & (F.col("pt") <= stop))


def has_partition_starts_with(partitions: DataFrame, prefix: str) -> DataFrame:
    return _any(partitions, F.col("pt").startswith(prefix))


def has_partition(partitions: DataFrame, pt: str) -> DataFrame:
    return _any(partitions, F.col("pt") == pt)


def _any(partitions: DataFrame, test) -> DataFrame:
    return partitions.agg(F.coalesce(F.bool_or(test), F.lit(False)).alias("found"))


def nearest_partition_before(partitions: DataFrame, pt: str) -> DataFrame:
    """Greatest partition before ``pt``; null when there is none."""
    return partitions.agg(F.max(F.when(F.col("pt") < pt, F.col("pt"))).alias("pt"))


def as_value(one_row: DataFrame):
    """The single value of a look-up, for use as a plain Python argument."""
    return one_row.first()[0]


def respelled(partitions: DataFrame, fmt: str = COMPACT) -> DataFrame:
    """Partition names with their spelling changed to ``fmt``."""
    return partitions.select("pt", date_to_pt(pt_to_date("pt"), fmt).alias("respelled"))
