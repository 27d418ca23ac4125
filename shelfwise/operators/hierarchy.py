"""Category trees as a table of placed nodes."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, Row, functions as F

from shelfwise import settings as S
from shelfwise.operators.classes import ClassedPairs
from shelfwise.session import staged


def _stored(*frames: tuple[DataFrame, str]) -> list[tuple[DataFrame, Row]]:
    """Frames written to the shared folder side by side, each with its n (rows) and total (sum of its numbers), seen while writing."""
    def store(frame: DataFrame, name: str) -> tuple[DataFrame, Row]:
        seen = Observation()
        number = F.col(frame.columns[-1]) if name in ("levels", "distances") else F.lit(0)
        out = staged(frame.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(number).alias("total")), name)
        return out, Row(**seen.get)

    with ThreadPoolExecutor(len(frames)) as pool:
        return list(pool.map(lambda x: store(*x), frames))


def node_levels(nodes: DataFrame) -> DataFrame:
    """Smallest level of every node below a root (root = 1), for each platform; no path is built.

    Levels and the least distances between a node and those above it double their reach every
    round, so a tree of depth d takes about log2(d) rounds, and many ways to one node stay one row.
    Ends when a round changes no level.
    """
    rows = nodes.select("platform", "node", "parent")
    roots = rows.filter(F.col("parent") == S.ROOT_PARENT).select("platform", "node", F.lit(1).alias("level")).distinct()
    edges = rows.filter((F.col("parent") != S.ROOT_PARENT) & (F.col("parent") != F.col("node"))).select(
        "platform", F.col("parent").alias("above"), "node", F.lit(1).alias("steps")).distinct()
    (levels, now), (below, _) = _stored((roots, "levels"), (edges, "distances"))
    before = None
    while now != before:
        reached = levels.withColumnRenamed("node", "above").join(below, ["platform", "above"]).select(
            "platform", "node", (F.col("level") + F.col("steps")).alias("level"))
        middle = below.select("platform", F.col("node").alias("_middle"), F.col("above").alias("_above"), F.col("steps").alias("_steps"))
        further = middle.join(below.withColumnRenamed("above", "_middle"), ["platform", "_middle"]).filter(
            F.col("_above") != F.col("node")).select("platform", F.col("_above").alias("above"), "node", (F.col("steps") + F.col("_steps")).alias("steps"))
        before = now
        (levels, now), (below, _) = _stored(
            (levels.unionByName(reached).groupBy("platform", "node").agg(F.min("level").alias("level")), "levels"),
            (below.unionByName(further).groupBy("platform", "above", "node").agg(F.min("steps").alias("steps")), "distances"))
    return levels


def category_closure(nodes: DataFrame) -> DataFrame:
    """Every place of every node below a root: level (root = 1) and path of ids.

    Round j has all walks of 2^j steps down; behind the places found so far they give those of up
    to twice the depth. So a tree of depth d takes about log2(d) rounds of two joins, written side
    by side to the shared folder. A node already on its own path is not placed again, so cycles end.
    Walks are those of the whole table, parts that no root reaches included.
    """
    child = nodes.select("platform", "node", "parent", "text", "has_child")
    record = ["parent", "node", "text", "has_child"]
    roots = child.filter(F.col("parent") == S.ROOT_PARENT).select("platform", *record, F.lit(1).alias("level"), F.array("node").alias("path"))
    steps = child.filter((F.col("parent") != S.ROOT_PARENT) & (F.col("parent") != F.col("node"))).select(
        "platform", F.col("parent").alias("above"), *record, F.array("node").alias("walk"))
    (last, new), (walks, _) = _stored((roots, "places"), (steps, "walks"))
    places = [last]
    while new.n:
        found = reduce(DataFrame.unionByName, places).select("platform", F.col("node").alias("above"), "path")
        further = found.join(walks, ["platform", "above"]).filter(~F.arrays_overlap("path", "walk")).select(
            "platform", *record, (F.size("path") + F.size("walk")).alias("level"), F.concat("path", "walk").alias("path"))
        first = walks.select("platform", F.col("above").alias("_above"), F.col("node").alias("above"), F.col("walk").alias("_walk"))
        longer = (first.join(walks, ["platform", "above"])
                  .filter(~F.arrays_overlap("_walk", "walk") & ~F.array_contains("walk", F.col("_above")))
                  .select("platform", F.col("_above").alias("above"), *record, F.concat("_walk", "walk").alias("walk")))
        (last, new), (walks, _) = _stored((further, "places"), (longer, "walks"))
        places.append(last)
    return reduce(DataFrame.unionByName, places[:-1] or places)


def unplaced_nodes(nodes: DataFrame, closure: DataFrame) -> DataFrame:
    """Nodes that no root reaches: orphans and cycles."""
    keys = ["platform", "node", "parent"]
    return nodes.join(closure.select(*keys), keys, "left_anti")


def min_levels(levels: DataFrame) -> DataFrame:
    """Smallest level per node id, over the trees of all platforms."""
    return levels.groupBy("node").agg(F.min("level").alias("level"))


def category_min_level(levels: DataFrame, ids: DataFrame) -> DataFrame:
    """Smallest level of each asked id; -1 when it is in no tree."""
    wanted = ids.select(F.col("id")).distinct()
    return wanted.join(min_levels(levels).withColumnRenamed("node", "id"), "id", "left").select(
        "id", F.coalesce("level", F.lit(-1)).alias("level"))


def category_levels(closure: DataFrame, ids: DataFrame) -> DataFrame:
    """Levels of each asked id with the number of its places there; null and 0 when it is in no tree."""
    wanted = ids.select(F.col("id")).distinct()
    counted = closure.groupBy(F.col("node").alias("id"), "level").agg(F.count(F.lit(1)).alias("n"))
    return wanted.join(counted, "id", "left").select("id", "level", F.coalesce("n", F.lit(0)).alias("n"))


def category_find(closure: DataFrame, ids: DataFrame) -> DataFrame:
    """Node records of the asked ids, one per place in a tree."""
    return (closure.join(ids.select(F.col("id").alias("node")).distinct(), "node", "left_semi")
            .select("platform", "node", "parent", "text", "has_child", "level"))


def category_count(closure: DataFrame) -> DataFrame:
    return closure.agg(F.count(F.lit(1)).alias("n_nodes"))


def category_depth(goods: DataFrame, levels: DataFrame) -> DataFrame:
    """Deepest category of each goods from its id list ``ids``; unknown or none gives 0."""
    rows = goods.select("goods_id", F.explode_outer("ids").alias("node"))
    return (rows.join(levels, "node", "left").groupBy("goods_id")
            .agg(F.greatest(F.max(F.coalesce("level", F.lit(-1))), F.lit(0)).alias("depth")))


def goods_depth(goods: DataFrame, goods_static: DataFrame, levels: DataFrame,
                platform: str = S.DEFAULT_PLATFORM) -> DataFrame:
    """Depth of the asked goods that have a category list on the platform."""
    lists = goods_static.select("goods_id", F.try_element_at("category", F.lit(platform)).alias("ids"))
    known = lists.filter(F.col("ids").isNotNull()).join(
        goods.select("goods_id").distinct(), "goods_id", "left_semi")
    return category_depth(known, levels)


def focus_goods_depth(pairs: DataFrame | ClassedPairs, goods_static: DataFrame, levels: DataFrame,
                      platform: str = S.DEFAULT_PLATFORM) -> DataFrame | ClassedPairs:
    """Distinct (user, goods) with the depth of the goods; goods outside the catalogue drop out.

    Depths are worked out once per goods and joined to the pairs afterwards, or to the goods of ``ClassedPairs``,
    which stay in factors.
    """
    if isinstance(pairs, ClassedPairs):
        return pairs.with_goods(_depths(pairs.goods(), goods_static, levels, platform))
    distinct = pairs.filter(F.col("goods_id").isNotNull()).select("user_id", "goods_id").distinct()
    depths = _depths(distinct.select("goods_id").distinct(), goods_static, levels, platform)
    return distinct.join(depths, "goods_id").select("user_id", "goods_id", "depth")


def _depths(goods: DataFrame, goods_static: DataFrame, levels: DataFrame, platform: str) -> DataFrame:
    """Depth of those of the goods that the catalogue has."""
    lists = goods_static.select("goods_id", F.try_element_at("category", F.lit(platform)).alias("ids"))
    return category_depth(lists.join(goods, "goods_id", "left_semi"), levels)
