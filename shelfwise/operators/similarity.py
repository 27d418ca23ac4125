"""Similarity of users and pool goods, and the best goods per user.

The full product of users and pool is never formed. Tags generate the pairs with a
similarity above 0. All other goods differ for a user only by their category depth, so
the first goods of each depth stand for them (``base_goods``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise import settings as S
from shelfwise.functions.dates import pt_text
from shelfwise.operators.classes import ClassedPairs
from shelfwise.operators.groups import first_rows
from shelfwise.operators.pool_scores import best_in_small_pool
from shelfwise.operators.rules import recent_pairs
from shelfwise.operators.sales import valid_sale
from shelfwise.operators.tag_batches import carriers, tag_matches
from shelfwise.session import small_enough, staged
from shelfwise.sources.partitions import PartitionedTable, read_partitions

#: Goods and tag rows of a pool whose pairs with users are all made, and of one from which only the best of a user are wanted.
POOL_TAG_ROWS = 200_000
BEST_TAG_ROWS = 4_000_000


def pool_order() -> list[Column]:
    """Best selling first, unknown totals last, goods_id between equals."""
    return [F.col("sale").desc_nulls_last(), F.col("goods_id").asc()]


def hot_pool(goods_dynamic: DataFrame | PartitionedTable, as_of: str, days: int = S.SALE_DAYS,
             n: int = S.HOT_POOL_SIZE) -> DataFrame:
    """The n goods with the highest sale, with the tags of their latest day."""
    first = pt_text(as_of, 1 - days, dashed=True)
    rows = valid_sale(read_partitions(goods_dynamic, first, pt_text(as_of, dashed=True)), None)
    best = (rows.groupBy("goods_id")
            .agg(F.max_by("tags", "pt").alias("tags"), F.sum("sale").cast("bigint").alias("sale"))
            .orderBy(*pool_order()).limit(n))
    # At most n rows are left, so a single window over all of them is bounded.
    return best.withColumn("pool_rank", F.row_number().over(Window.orderBy(*pool_order())))


def potential_pool(potential: DataFrame) -> DataFrame:
    """All potential goods, one row per goods; their total sale gives the pool order."""
    return potential.groupBy("goods_id").agg(
        F.max_by("tags", F.coalesce("total_sale", F.lit(-1))).alias("tags"),
        F.max("total_sale").alias("sale"))


def default_goods(pool: DataFrame, n: int = S.KEPT_LENGTH) -> DataFrame:
    """The first n goods of a pool with their position."""
    best = pool.orderBy(*pool_order()).limit(n)
    return best.select("goods_id", F.row_number().over(Window.orderBy(*pool_order())).alias("position"))


def user_norms(frequency: DataFrame) -> DataFrame:
    """Sum of squared tag frequencies and number of tags per user."""
    n = F.col("n").cast("bigint")
    return frequency.groupBy("user_id").agg(
        F.sum(n * n).alias("squares"), F.count(F.lit(1)).alias("n_tags"))


def user_depths(focus_depth: DataFrame | ClassedPairs) -> DataFrame:
    """Sum of depths and number of goods per user."""
    if isinstance(focus_depth, ClassedPairs):
        return focus_depth.per_user(depth_sum=F.col("depth").cast("bigint")).select("user_id", "depth_sum", "n_goods")
    return focus_depth.groupBy("user_id").agg(
        F.sum(F.col("depth").cast("bigint")).alias("depth_sum"), F.count(F.lit(1)).alias("n_goods"))


def similarity_column(dot: Column, squares: Column, n_tags: Column) -> Column:
    return dot / (F.sqrt(squares) * F.sqrt(n_tags))


def distance_column(depth_sum: Column, n_goods: Column, depth: Column) -> Column:
    """log2 of the whole quotient (sum + depth) / goods; 1 where that is 0 or undefined."""
    total = (depth_sum + depth).cast("bigint")
    quotient = F.floor(total / n_goods)
    usable = (n_goods > 0) & (total >= 2 * n_goods)
    return F.when(usable, F.log2(quotient)).otherwise(F.lit(1.0))


def score_column(sim: Column, distance: Column) -> Column:
    return (1 + F.exp(sim)) / distance


def known_users(frequency: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Tag rows together with what is known per user, so that pairs need no further join."""
    users = user_norms(frequency)
    if extra is not None:
        users = users.join(extra, "user_id", "left")
    return frequency.join(users, "user_id")


def matched_pairs(frequency: DataFrame, pool: DataFrame, extra: DataFrame | None = None,
                  pool_columns: list[str] | None = None, max_pool_tags: int | None = None) -> DataFrame:
    """Pairs of user and pool goods that share a tag, with their dot product.

    With ``max_pool_tags`` a pool that was counted and found to have at most so many goods and tag rows is sent
    to the users, so that no pair is exchanged; any other is joined by tag.
    """
    known = known_users(frequency, extra)
    per_user = [c for c in known.columns if c not in ("user_id", "tag", "n")]
    per_goods = pool_columns or []
    tags = pool.select("goods_id", *per_goods, F.explode(F.array_distinct("tags")).alias("tag"))
    if max_pool_tags is not None and small_enough(pool.select(F.explode_outer("tags")), max_pool_tags):
        keys = ["goods_id", *per_goods]
        goods = carriers(tags.groupBy(*keys, "tag").agg(F.count(F.lit(1)).alias("rows")), keys, "rows")
        met = known.withColumn("n", F.col("n").cast("bigint")).join(tags.select("tag").distinct(), "tag", "left_semi")
        return tag_matches(met, goods, per_user, keys, "dot")
    return (known.join(tags, "tag").groupBy("user_id", *per_user, "goods_id", *per_goods)
            .agg(F.sum(F.col("n").cast("bigint")).alias("dot")))


def best_matches(frequency: DataFrame, pool: DataFrame, extra: DataFrame, n: int,
                 max_pool_tags: int = BEST_TAG_ROWS) -> DataFrame:
    """The n best goods per user among those that share a tag.

    Goods of the same tags and depth have the same score for every user, so only the first n of them can be wanted. A pool whose goods and tag rows were counted and found few is sent to every task, which
    leaves all but the pairs close to each user's n best. Any other pool is joined by tag and
    summed by Spark. Both ways end in the same score expression and order.
    """
    known = known_users(frequency, extra)
    own_tags = F.array_sort(F.array_distinct(F.filter("tags", lambda t: t.isNotNull())))
    carrying = pool.withColumn("tags", own_tags).filter(F.size("tags") > 0)
    pool = staged(first_rows(carrying, ["tags", "depth"], pool_order(), n, "_place").drop("_place"), "first-of-pool")
    if small_enough(pool.select(F.explode("tags")), max_pool_tags):
        tags = pool.select(F.explode("tags").alias("tag")).distinct()
        near = best_in_small_pool(known.join(tags, "tag", "left_semi"), pool, pool_order(), n)
        return first_rows(_scored_pairs(near), ["user_id"], best_order(), n).drop("position")
    pairs = _scored_pairs(matched_pairs(frequency, pool, extra, ["depth", "sale"]))
    return first_rows(pairs, ["user_id"], best_order(), n).drop("position")


def _scored_pairs(pairs: DataFrame) -> DataFrame:
    """The score of pairs, by one expression whatever way the pairs were found."""
    sim = similarity_column(F.col("dot"), F.col("squares"), F.col("n_tags"))
    distance = distance_column(F.col("depth_sum"), F.col("n_goods"), F.col("depth"))
    return pairs.select("user_id", "goods_id", F.col("sale").cast("double").alias("sale"),
                        score_column(sim, distance).alias("score"))


def tag_similarity(frequency: DataFrame, pool: DataFrame, extra: DataFrame | None = None,
                   max_pool_tags: int = POOL_TAG_ROWS) -> DataFrame:
    """Similarity of every pair that shares a tag; all other pairs have 0. What ``extra`` knows per user comes along."""
    own = [] if extra is None else [c for c in extra.columns if c != "user_id"]
    sim = similarity_column(F.col("dot"), F.col("squares"), F.col("n_tags"))
    return matched_pairs(frequency, pool, extra, max_pool_tags=max_pool_tags).select(
        "user_id", "goods_id", sim.alias("sim"), *own)


def category_distance(pairs: DataFrame, focus_depth: DataFrame | ClassedPairs, depths: DataFrame,
                      keep: Sequence[str] = ()) -> DataFrame:
    """Distance of each given pair; 1 for users without goods, depth 0 where unknown.

    Pairs that bring depth_sum and n_goods of ``user_depths`` from where they were made are not joined by user again.
    The columns ``keep`` of the pairs stay beside the distance.
    """
    facts = ["depth_sum", "n_goods"]
    if not set(facts) <= set(pairs.columns):
        pairs = pairs.select("user_id", "goods_id", *keep).join(user_depths(focus_depth), "user_id", "left")
    known = (pairs.select("user_id", "goods_id", *facts, *keep)
             .join(depths.select("goods_id", "depth"), "goods_id", "left"))
    distance = distance_column(F.col("depth_sum"), F.col("n_goods"), F.coalesce("depth", F.lit(0)))
    return known.select("user_id", "goods_id", *keep, distance.alias("distance"))


def similarity_score(similarity: DataFrame, distance: DataFrame) -> DataFrame:
    """Score of pairs that have a similarity and a distance; a distance that brought the similarity along needs no join.
    Null ids meet nothing."""
    score = score_column(F.col("sim"), F.col("distance"))
    if "sim" in distance.columns:
        return distance.select("user_id", "goods_id", score.alias("score")).dropna(subset=["user_id", "goods_id"])
    return similarity.join(distance, ["user_id", "goods_id"]).select(
        "user_id", "goods_id", score.alias("score"))


def base_goods(pool: DataFrame, n: int = S.KEPT_LENGTH) -> DataFrame:
    """The first n pool goods of every depth: at most (tree depth + 1) x n rows."""
    return first_rows(pool, ["depth"], pool_order(), n, "place").select("depth", "sale", "goods_id")


def base_candidates(users: DataFrame, pool: DataFrame, n: int = S.KEPT_LENGTH) -> DataFrame:
    """Per user the n best goods if no tag matched.

    The few base goods reach the tasks as one array; each user's order is worked out
    inside the row, so only n rows per user are written.
    """
    entry = F.struct("depth", "sale", "goods_id")
    listed = base_goods(pool, n).agg(F.collect_list(entry)).scalar()
    usable = F.transform("listed", lambda g: F.struct(
        (-score_column(F.lit(0.0), distance_column(F.col("depth_sum"), F.col("n_goods"), g["depth"]))
         ).alias("worse"),
        (-F.coalesce(g["sale"].cast("double"), F.lit(float("-inf")))).alias("less"),
        g["goods_id"].alias("goods_id"), g["sale"].alias("sale")))
    best = F.slice(F.array_sort(usable), 1, n)
    rows = users.withColumn("listed", listed).select("user_id", F.explode(best).alias("g"))
    return rows.select("user_id", F.col("g.goods_id").alias("goods_id"),
                       F.col("g.sale").cast("double").alias("sale"),
                       (-F.col("g.worse")).alias("score"))


def best_order() -> list[Column]:
    return [F.col("score").desc(), *pool_order()]


def top_similar(users: DataFrame, frequency: DataFrame, focus_depth: DataFrame | ClassedPairs | None,
                pool: DataFrame, depths: DataFrame | None, n: int = S.KEPT_LENGTH,
                max_pool_tags: int = BEST_TAG_ROWS) -> DataFrame:
    """The n best pool goods of every user by (1 + e^similarity) / distance.

    Exact: a goods outside the matched pairs can only be among the n best if it is among
    the first n of its depth, since those before it score at least as much. With
    ``focus_depth`` left out every distance is 1.
    """
    if focus_depth is None or depths is None:
        placed = pool.select("goods_id", "tags", "sale", F.lit(0).alias("depth"))
        unknown = F.lit(None).cast("bigint")
        extra = users.select("user_id").distinct().select(
            "user_id", unknown.alias("depth_sum"), unknown.alias("n_goods"))
    else:
        placed = pool.select("goods_id", "tags", "sale").join(
            depths.select("goods_id", "depth"), "goods_id", "left"
        ).withColumn("depth", F.coalesce("depth", F.lit(0)))
        extra = users.select("user_id").distinct().join(user_depths(focus_depth), "user_id", "left")
    placed = staged(placed, "placed-pool")
    matched = best_matches(frequency, placed, extra, n, max_pool_tags)
    base = base_candidates(extra, placed, n)
    # At most 2n rows per user from here on; one exchange serves both steps below.
    both = matched.unionByName(base).repartition("user_id").groupBy("user_id", "goods_id", "sale").agg(
        F.max("score").alias("score"))
    return first_rows(both, ["user_id"], best_order(), n).select("user_id", "goods_id", "position", "score")


def backfill(lists: DataFrame, defaults: DataFrame, n: int = S.KEPT_LENGTH) -> DataFrame:
    """Append default goods not yet listed to lists shorter than n, up to n.

    Lists hold at most n rows per user, defaults at most n rows.
    """
    ordered = F.array_sort(F.collect_list(F.struct("position", "goods_id")))
    own = lists.groupBy("user_id").agg(F.transform(ordered, lambda x: x["goods_id"]).alias("goods"))
    spare = defaults.filter(F.col("position") <= n).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "goods_id"))),
                    lambda x: x["goods_id"])).scalar()
    full = F.slice(F.concat("goods", F.array_except("spare", "goods")), 1, n)
    rows = own.withColumn("spare", spare).select("user_id", F.posexplode(full).alias("pos", "goods_id"))
    return rows.select("user_id", "goods_id", (F.col("pos") + 1).alias("position"))


def newuser_list(defaults: DataFrame) -> DataFrame:
    return defaults.select(F.lit(S.NEW_USER).alias("user_id"), "goods_id", "position")


def suppress_history(lists: DataFrame, recommend: DataFrame, kind: str, as_of: str,
                     days: int = S.REPEAT_FREE_DAYS, k: int = S.LIST_LENGTH) -> DataFrame:
    """Drop goods shown to the user under the same type lately, keep the first k in order.

    ``lists`` holds a few positions per user; a user left without goods keeps an empty list. The
    history passes by the user's list row by row and leaves only goods that the list has, so what
    is kept per user is bounded by the list. All steps go by user: a history bucketed by user_id
    is not shuffled.
    """
    shown = recent_pairs(recommend, as_of, days, kind).withColumnRenamed("goods_id", "_shown")
    own = lists.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("position", "goods_id"))).alias("_own"))
    listed = F.transform("_own", lambda x: x["goods_id"])
    met = F.collect_set(F.when(F.array_contains(listed, F.col("_shown")), F.col("_shown")))
    marked = own.join(shown, "user_id", "left").groupBy("user_id", "_own").agg(met.alias("_met"))
    still_open = F.filter("_own", lambda x: ~F.coalesce(F.array_contains("_met", x["goods_id"]), F.lit(False)))
    return marked.select("user_id", F.lit(kind).alias("type"),
                         F.transform(F.slice(still_open, 1, k), lambda x: x["goods_id"]).alias("values"))
