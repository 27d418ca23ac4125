"""Clever forms against brute force, on random frames with hot keys, and list properties."""

import math
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import follow, groups, merge, similarity


@pytest.fixture(scope="module")
def world(spark):
    """A third of all follows belong to one user, a third of all tags are one tag."""
    rng = random.Random(7)
    tags = [f"t{i}" for i in range(25)]
    def pick(n):
        return [("t0" if rng.random() < .33 else rng.choice(tags)) for _ in range(n)]
    users = ["hot"] * 150 + [f"u{rng.randrange(40)}" for _ in range(300)]
    focus = [(u, "tag", t) for u, t in zip(users, pick(len(users)))] + [("x", "tag", f"none{i}") for i in range(4)]
    goods = [(g, pick(rng.randrange(1, 9))) for g in range(60)] + [(g, pick(4)) for g in range(0, 60, 7)]
    return (spark.createDataFrame(focus, "user_id string, type string, value string"),
            spark.createDataFrame(goods, "goods_id bigint, tags array<string>"), focus, goods)


@pytest.mark.parametrize("min_tags", [1, 3, 5, 9])
def test_overlap_equals_membership_count(world, rows, min_tags):
    focus_df, day_df, focus, goods = world
    counts = {}
    for user, _, tag in focus:
        hits = [g for g, tags in goods if tag in tags] or [None]
        for g in hits:
            counts[user, g] = counts.get((user, g), 0) + 1
    wanted = sorted(((u, g, n) for (u, g), n in counts.items() if n >= min_tags), key=repr)
    got = follow.tag_overlap(focus_df, day_df, min_tags).select("user_id", "goods_id", "support_by_tag")
    assert rows(got) == wanted


def brute_best(users, freq, own, pool, depths, n):
    best = {}
    for u in users:
        f = freq.get(u, {})
        norm = math.sqrt(sum(v * v for v in f.values())) * math.sqrt(len(f)) if f else 0
        scored = []
        for g, tags, sale in pool:
            sim = sum(f.get(t, 0) for t in set(tags or [])) / norm if norm else 0.0
            mine = own.get(u)
            q = (sum(mine) + depths.get(g, 0)) // len(mine) if mine else 0
            distance = math.log2(q) if q >= 2 else 1.0
            scored.append((-(1 + math.exp(sim)) / distance, -(sale if sale is not None else -math.inf), g))
        best[u] = [g for *_, g in sorted(scored)[:n]]
    return best


@pytest.mark.parametrize("distance", [True, False])
@pytest.mark.parametrize("max_pool_tags", [10_000, 0])
@pytest.mark.parametrize("size", [8, 70])
def test_best_goods_equal_the_full_product(spark, distance, max_pool_tags, size):
    rng = random.Random(size)
    tags = [f"t{i}" for i in range(12)]
    users = ["hot"] + [f"u{i}" for i in range(30)]
    freq = {u: {t: rng.randrange(1, 6) for t in rng.sample(tags, 12 if u == "hot" else rng.randrange(1, 5))}
            for u in users[:25]}
    own = {u: [rng.randrange(0, 5) for _ in range(rng.randrange(1, 4))] for u in users[3:]}
    pool = [(g, rng.choice([None, [], rng.sample(tags, 3), ["none"], rng.sample(tags, 1) * 2]),
             rng.choice([None, 5.0, 5.0, 7.0, float(g)])) for g in range(size)]
    depths = {g: rng.randrange(0, 6) for g in range(0, size, 2)}
    top = similarity.top_similar(
        spark.createDataFrame([(u,) for u in users], "user_id string"),
        spark.createDataFrame([(u, t, n) for u, f in freq.items() for t, n in f.items()],
                              "user_id string, tag string, n bigint"),
        spark.createDataFrame([(u, i, d) for u, ds in own.items() for i, d in enumerate(ds)],
                              "user_id string, goods_id bigint, depth int") if distance else None,
        spark.createDataFrame(pool, "goods_id bigint, tags array<string>, sale double"),
        spark.createDataFrame(list(depths.items()), "goods_id bigint, depth int") if distance else None,
        n=15, max_pool_tags=max_pool_tags)
    got = {}
    for r in top.orderBy("user_id", "position").collect():
        got.setdefault(r.user_id, []).append(r.goods_id)
    assert got == brute_best(users, freq, own if distance else {}, pool, depths if distance else {}, 15)


def test_ranks_of_a_hot_tied_key_do_not_meet_in_one_task(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 100)).alias("k"),
        "id", (F.col("id") % 2).alias("v"))
    ranked = groups.dense_ranks(df, ["k"], "v", "r", 1)
    assert ranked.filter("k = 'hot'").count() == 5_000
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window ["):]
    assert "HashAggregate" in window and "WindowGroupLimit" in window


def test_blocks_of_a_hot_key_are_numbered_over_several_tasks(spark):
    items = spark.range(30_000).select(F.when(F.col("id") < 10_000, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                       "id", F.lit(1).alias("copies"))
    dealt = groups.in_blocks(items, ["k"], ["id"], 64).filter("k = 'hot'")
    assert dealt.filter((F.floor(F.col("id") / 64) != F.col("block")) | (F.col("id") % 64 != F.col("place"))).count() == 0
    assert dealt.count() == 10_000
    ranges = groups.in_blocks(items, ["k"], ["id"], 64)
    assert ranges.groupBy("k", "block").count().agg(F.max("count")).first()[0] == 64


def test_pools_with_many_untagged_goods_are_counted_as_they_are(spark):
    pool = spark.range(3000).select(F.col("id").alias("goods_id"), F.when(F.col("id") < 3, F.array(F.lit("t"))).alias("tags"),
                                    F.col("id").cast("double").alias("sale"), F.lit(0).alias("depth"))
    assert similarity.small_enough(pool.select(F.explode_outer("tags")), 2000) is False


def test_sums_through_the_factors_equal_sums_over_the_pairs(spark, rows):
    rng = random.Random(3)
    own = [(f"u{rng.randrange(9)}" if rng.random() < .6 else "hot", rng.choice(["a", "b", "c", None]), rng.randrange(1, 4)) for _ in range(40)]
    goods = [("a" if g % 3 else rng.choice("bc"), g, rng.randrange(1, 3)) for g in range(30)]
    day = [(g,) for g in range(0, 30, 4) for _ in range(g % 3 + 1)]
    whole = merge.Expansion(spark.createDataFrame(own + [("only null", None, 2)], "user_id string, category string, n_own bigint"),
                            spark.createDataFrame(goods, "category string, goods_id bigint, n_goods bigint"))
    for one in (whole, whole.times(spark.createDataFrame(day, "goods_id bigint"))):
        sums = one.sums(total=F.col("goods_id"), squares=F.col("goods_id") * F.col("goods_id"))
        assert "user_id" in sums.columns and rows(sums) == rows(one.pairs().groupBy("user_id").agg(
            F.sum("n"), F.sum(F.col("n") * F.col("goods_id")), F.sum(F.col("n") * F.col("goods_id") * F.col("goods_id"))))
    wanted = {}
    for user, category, n in own + [("only null", None, 2)]:
        for c, g, m in goods if category else [(None, 0, 1)]:
            if c == category:
                count, total = wanted.get(user, (0, 0))
                wanted[user] = count + n * m, total + n * m * g
    got = {r.user_id: (r.n_rows, r.total or 0) for r in whole.sums(total=F.col("goods_id")).collect()}
    assert got == wanted and got["only null"] == (2, 0)


def test_sums_over_an_empty_expansion(spark):
    empty = merge.Expansion(spark.createDataFrame([], "user_id string, category string, n_own bigint"),
                            spark.createDataFrame([], "category string, goods_id bigint, n_goods bigint"))
    assert empty.sums(total=F.col("goods_id")).count() == 0 and empty.pairs().count() == 0
