"""Ranking and list building that hold when one key owns a large share of the rows.

A plain ``dense_rank`` window sends every tied row of a key to one task, and a plain
``collect_list`` builds one row per key however long it gets. The helpers here rank
distinct values instead of rows, and divide lists into blocks of a fixed number of places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.session import staged


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet; the key columns of ``left`` are kept."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = None
    for k in keys:
        test = left[k].eqNullSafe(renamed[f"_r_{k}"])
        condition = test if condition is None else condition & test
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def dense_ranks(df: DataFrame, keys: Sequence[str], value: str, rank: str, k: int | None = None) -> DataFrame:
    """Add the dense rank of ``value`` (descending, nulls last) within ``keys``.

    Only distinct (key, value) pairs pass through the window. With ``k`` each task
    keeps at most k of them per key before the exchange, and rows beyond rank k are
    dropped by the join that brings the ranks back to the rows.
    """
    order = Window.partitionBy(*keys).orderBy(F.col(value).desc_nulls_last())
    levels = df.select(*keys, value).distinct().withColumn(rank, F.dense_rank().over(order))
    if k is not None:
        levels = levels.filter(F.col(rank) <= k)
    return null_safe_join(df, levels, [*keys, value])


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
               position: str = "position") -> DataFrame:
    """The first ``k`` rows of each key in a total order, numbered from 1.

    Spark keeps at most k rows per key and task before the exchange.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(position, F.row_number().over(window)).filter(F.col(position) <= k)


def in_blocks(items: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, copies: str = "copies") -> DataFrame:
    """Deal the values of every key, in order, to blocks of ``size`` list places.

    A row stands for ``copies`` equal values (none: it takes no place). Added are block, from 0,
    place (that of the row's first value in the block) and copies, now those in the block; a row
    whose copies run over the end of a block comes once for each. Rows are dealt out by ranges of
    key and value; each range counts its places, the sums before it number them, so a key with any
    share of the rows is spread like all others. Null keys are a key.
    """
    ranged = staged(items.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy(*keys, "_range").agg(F.sum(copies).alias("_n"))
    ranges = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, "_range", F.coalesce(F.sum("_n").over(ranges), F.lit(0)).alias("_start"))
    # What stands before a range in the list of its key goes ahead of the range as one row, so no join brings it back.
    ahead = starts.filter(F.col("_start") > 0).withColumnRenamed("_start", copies).withColumn("_ahead", F.lit(True))
    inside = Window.partitionBy("_range", *keys).orderBy(F.desc("_ahead"), *order).rowsBetween(Window.unboundedPreceding, -1)
    placed = (ranged.withColumn("_ahead", F.lit(False)).unionByName(ahead, allowMissingColumns=True)
              .withColumn("_before", F.coalesce(F.sum(copies).over(inside), F.lit(0))).filter(~F.col("_ahead")))
    first, last = F.col("_before"), F.col("_before") + F.greatest(F.col(copies), F.lit(1)) - 1
    begin = F.greatest(F.col("_first"), F.col("block") * size)
    return (placed.withColumn("_first", first)
            .withColumn("block", F.explode(F.sequence(F.floor(first / size), F.floor(last / size))))
            .withColumn("place", (begin - F.col("block") * size).cast("int"))
            .withColumn(copies, F.greatest(F.least(F.col("_first") + F.col(copies), (F.col("block") + 1) * size) - begin, F.lit(0)).cast("int"))
            .drop("_range", "_ahead", "_before", "_first"))


def block_list(value: str, copies: str = "copies", when: Column | None = None) -> Column:
    """The list of a block's values in the order of their places, each as often as it has copies."""
    piece = F.struct("place", F.array_repeat(value, F.col(copies)).alias("v"))
    pieces = F.array_sort(F.collect_list(piece if when is None else F.when(when, piece)))
    return F.flatten(F.transform(pieces, lambda p: p["v"]))


def lists_of(rows: DataFrame, keys: Sequence[str], value: str = "goods_id",
             position: str = "position") -> DataFrame:
    """Short ordered lists from rows already cut to a few positions per key."""
    ordered = F.array_sort(F.collect_list(F.struct(position, value)))
    return rows.groupBy(*keys).agg(
        F.transform(ordered, lambda x: x[value]).alias("values"))
