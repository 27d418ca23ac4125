"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.session import staged


def _least(edges: DataFrame) -> DataFrame:
    """u, v and m: the least of u and all its neighbours. Two shuffles, no list of neighbours.

    The minima are stored, so that the join is of two plain tables and the edges of a hub can be split.
    """
    least = staged(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "minima")
    return edges.join(least, "u")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node and component (its least node) for every node of the edges u, v; loops are ignored.

    Each round's edges are written to the shared folder, so lost executors cost one round at most.
    The number of rounds grows with the logarithm of the longest path.
    """
    now = staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while (state := _state(now)) != before:
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: every larger neighbour of u is tied to the least node around u.
        large = staged(_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        # Small star: u and its smaller neighbours are tied to the least of them.
        ties = _least(large)
        now = staged(ties.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                   F.struct("u", F.col("m").alias("v")))).alias("e"))
                     .select("e.u", "e.v").filter("u <> v").distinct(), "small")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
