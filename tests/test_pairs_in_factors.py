"""Pairs of users and goods come from joins behind which they are neither exchanged nor told apart again."""

import random

import pytest
from pyspark.sql import functions as F

from registry import bindings
from shelfwise.operators import follow, hierarchy, merge, similarity
from shelfwise.operators.groups import in_blocks


def before_join(df):
    """The steps that come after the last join of the pairs."""
    return df._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]


@pytest.fixture(scope="module")
def focus(spark):
    random.seed(5)
    users = ["u1", "u2", "u3", None]
    rows = {(random.choice(users), "category", random.choice(["a", "b", "c", "d", "none"])) for _ in range(40)}
    rows |= {(random.choice(users), "tag", random.choice(["red", "blue", "old", "new", "odd", None])) for _ in range(60)}
    rows |= {(random.choice(users), "goods", str(random.randrange(9))) for _ in range(20)}
    return spark.createDataFrame([*rows, ("u4", "category", "none"), ("u1", "category", "a"), ("u5", "category", None)],
                                 "user_id string, type string, value string")


@pytest.fixture(scope="module")
def top(spark):
    return spark.createDataFrame([(g, c, 1, 0) for g, c in [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "b"), (3, "b"), (4, "c"), (None, "d"),
                                                           (None, "a"), (5, None)]],
                                 "goods_id bigint, category string, rank_sale int, rank_prediction int")


def test_goods_of_categories(spark, rows, focus, top):
    own = focus.filter("type = 'category'").select("user_id", F.col("value").alias("category")).distinct()
    listed = top.filter("category IS NOT NULL").select("goods_id", "category").distinct()
    by_follow = follow.category_follow_goods(focus, top)
    assert rows(by_follow) == rows(own.join(listed, "category").select("user_id", "goods_id").distinct())
    by_goods = follow.goods_follow_goods(own, top)
    assert rows(by_goods) == rows(own.join(listed, "category", "left").select("user_id", "goods_id").distinct())
    assert "Aggregate" not in before_join(by_follow) and "Aggregate" not in before_join(by_goods)


def test_depths_of_followed_goods(spark, rows, focus, top):
    static = spark.createDataFrame([(g, {"WISH": ["x", "y"][:g % 3]} if g % 4 else None) for g in range(7)],
                                   "goods_id bigint, category map<string, array<string>>").withColumn("shop_id", F.lit(1))
    levels = spark.createDataFrame([("x", 1), ("y", 2)], "node string, level int")
    plain = follow.followed(focus, "goods", "goods_id", static).unionByName(follow.category_follow_goods(focus, top))
    pairs = follow.followed_goods(focus, static, top)
    assert rows(pairs.rows()) == rows(plain.filter("goods_id IS NOT NULL").distinct())
    wanted = hierarchy.focus_goods_depth(plain, static, levels)
    found = hierarchy.focus_goods_depth(pairs, static, levels)
    assert rows(found.rows().select(*wanted.columns)) == rows(wanted)
    assert rows(similarity.user_depths(found)) == rows(similarity.user_depths(wanted))
    assert rows(found.owners()) == rows(wanted.select("user_id").distinct())


def test_expansion(spark, rows):
    own = spark.createDataFrame([("u", "a", 2), ("u", "b", 1), ("v", "b", 3), ("v", None, 4), (None, "a", 1), ("w", "z", 1)],
                                "user_id string, category string, n_own bigint")
    goods = spark.createDataFrame([("a", 1, 1), ("b", 1, 2), ("a", 2, 1), ("b", 2, 2), ("b", 3, 1), ("a", None, 1)],
                                  "category string, goods_id bigint, n_goods bigint")
    whole = merge.Expansion(own, goods)
    assert rows(whole.pairs()) == sorted([("u", 1, 4), ("u", 2, 4), ("u", 3, 1), ("u", None, 2), ("v", 1, 6), ("v", 2, 6), ("v", 3, 3),
                                          ("v", None, 4), (None, 1, 1), (None, 2, 1), (None, None, 1)], key=repr)
    dynamic = spark.createDataFrame([(1, ["x"]), (1, ["x"]), (1, ["y"]), (3, None), (9, ["x"])], "goods_id bigint, tags array<string>")
    columns = ["user_id", "goods_id", "tags", "n"]
    tagged = merge.expand_tags(whole, dynamic)
    assert rows(tagged.select(columns)) == rows(merge.expand_tags(whole.pairs(), dynamic).select(columns))
    assert "Aggregate" not in before_join(whole.pairs()) and "Aggregate" not in before_join(tagged)


def test_overlap_of_a_day_of_few_goods(spark, rows, focus):
    day = spark.createDataFrame([(1, ["red", "old", "red"]), (1, ["red"]), (2, ["blue", "new", "old"]), (3, None), (4, [None, "new"]), (5, ["x"])],
                                "goods_id bigint, tags array<string>")
    sale = spark.createDataFrame([(1, 5, 1.0), (2, 5, None), (4, None, 3.0), (4, 2, 3.0)], "goods_id bigint, sale bigint, prediction double")
    for least in (1, 2, 3):
        few, many = follow.followed_overlap(focus, day, least), follow.followed_overlap(focus, day, least, max_rows=-1)
        assert few.few and not many.few
        columns = ["user_id", "goods_id", "support_by_tag"]
        assert rows(few.rows().select(columns)) == rows(many.rows().select(columns)) != []
        for k in (1, 2):
            wanted = follow.tag_goods_top(many, sale, k)
            assert rows(follow.tag_goods_top(few, sale, k).select(*wanted.columns)) == rows(wanted)
    plan = follow.tag_overlap(focus, day, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan.split("MapInArrow")[0] and "MapInArrow" in plan


def test_similarity_to_a_small_pool(spark, rows):
    random.seed(3)
    frequency = spark.createDataFrame([(u, t, random.randrange(1, 5)) for u in ("a", "b", "c") for t in random.sample("pqrstuvw", 4)],
                                      "user_id string, tag string, n bigint")
    pool = spark.createDataFrame([(g, random.choices("pqrstx", k=3) if g else None) for g in range(6)] + [(5, ["p", "u"])],
                                 "goods_id bigint, tags array<string>")
    small = similarity.tag_similarity(frequency, pool)
    assert rows(small) == rows(similarity.tag_similarity(frequency, pool, max_pool_tags=0)) != []
    depths = spark.createDataFrame([(g, g % 3) for g in range(5)], "goods_id bigint, depth int")
    own = spark.createDataFrame([("a", 1, 7), ("a", 2, 4), ("b", 1, 2)], "user_id string, goods_id bigint, depth int")
    carried = similarity.tag_similarity(frequency, pool, similarity.user_depths(own))
    assert rows(similarity.category_distance(carried, own, depths)) == rows(similarity.category_distance(small, own, depths))
    assert "Aggregate" not in small._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")[0]


def test_batches_cut_in_the_middle_of_a_user(spark, rows, monkeypatch):
    many = spark.range(3000).selectExpr("cast(id % 7 as string) AS user_id", "concat('t', id % 90) AS tag").distinct().withColumn("n", F.lit(2))
    pool = spark.range(90).selectExpr("id AS goods_id", "array(concat('t', id), concat('t', id div 2)) AS tags")
    wanted = rows(similarity.tag_similarity(many, pool, max_pool_tags=0))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    try:
        assert rows(similarity.tag_similarity(many, pool)) == wanted
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_blocks_without_a_join_of_all_values(spark, rows):
    items = spark.range(500).selectExpr("if(id % 9 = 0, null, id % 3) AS key", "id AS value", "id % 4 AS copies")
    dealt = in_blocks(items, ["key"], ["value"], 10)
    wanted = {}
    for key, value, copies in sorted(map(tuple, items.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        wanted.setdefault(key, []).extend([value] * copies)
    got = {}
    for r in dealt.orderBy("key", "block", "place", "value").collect():
        got.setdefault(r["key"], []).extend([r["value"]] * r["copies"])
        assert r["place"] + r["copies"] <= 10
    assert got == wanted and "Join" not in dealt._jdf.queryExecution().optimizedPlan().toString()


def test_input_is_dealt_out_by_its_size(spark, rows, monkeypatch):
    sf = "/root/testdata/sf0.001"
    plain = rows(bindings.Retail(spark, sf).focus_raw.select("userId", "type", F.size("values")))
    monkeypatch.setattr(bindings, "LINES_PER_TASK", 500)
    fine = bindings.Retail(spark, sf).focus_raw
    tasks = -(-bindings.Retail(spark, sf).n_lines // 500)
    assert rows(fine.select("userId", "type", F.size("values"))) == plain
    assert f"RepartitionByExpression [user_id" in fine._jdf.queryExecution().optimizedPlan().toString() and tasks > 4


def test_products_are_exchanged_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = bindings.Retail(spark, "/root/testdata/sf0.001").goods_dynamic._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # the order lines and the parts
