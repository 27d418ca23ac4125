"""Sums over pairs of users and goods are taken where the pairs are made, and agree with sums over their rows."""

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from registry.bindings import Retail
from registry.pair_marks import marks
from registry.rule_queries import AS_OF, DAYS, MIN_TAGS
from shelfwise.operators import evidence, rules, similarity
from shelfwise.plans import rules_daily
from test_evidence import results, tables  # noqa: F401

SF = "/root/testdata/sf0.001"


def behind(df, step="MapInArrow"):
    """The steps that come after the given one."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert step in plan
    return plan.split(step)[0]


def test_sums_by_sides_as_by_pairs(rows, tables, monkeypatch):  # noqa: F811
    monkeypatch.setattr(evidence, "MARKS", 16)
    goods, user = F.coalesce(F.col("goods_id"), F.lit(-5)), F.when(F.col("user_id") != "c", F.ascii("user_id"))
    mark = evidence.PairMark(goods, user, (goods * 7 + user * 3) % 11, lambda g, u: np.fmod(g * 7 + u * 3, 11))
    many, few = results(tables, False), results(tables, True)
    counts = [f"total_support_{kind}" for kind in evidence.KINDS]
    for name, group, totals in (
            ("support", counts, []), ("candidates", [], ["total_support"]), ("fresh", ["support_by_potentialhot"], []),
            ("priorities", [], ["priority_hot", "priority_potential", "sale", "prediction"]), ("one pass", ["sale"], ["prediction"]),
            ("delete", [], []), ("minus", [], ["prediction"])):
        wanted = rules.summed(rules.rows_of(many[name]), mark, group, totals)
        got = rules.sums_of(few[name], mark, group, totals)
        assert dict(got.dtypes) == dict(wanted.dtypes), name
        assert rows(got.select(wanted.columns)) == rows(wanted) != [], name
        if name not in ("delete", "minus"):
            sides = few[name].evidence.count_sums(mark) if name == "support" else few[name].evidence.sums(few[name].goods, mark, group, totals)
            assert not any(step in behind(sides) for step in ("Join", "Aggregate", "Repartition")), name
    lists = [rules.both_lists(some["priorities"], 1, 1, 1) for some in (few, many)]
    for one, other in zip(*lists):
        assert rows(one) == rows(other) != []


def test_ordered_goods_take_four_bytes_each():
    order = evidence.Order(np.array([3, 0, 3, 1], "int32"), None, 5)
    assert {order.places.dtype, order.at.dtype, order.starts.dtype} == {np.dtype("int32")} and evidence.GOODS_ROWS >= 10_000_000
    assert [list(a) for a in order.cells([(np.array([7, 8, 9]), np.array([3, 2, 1]))])] == [[7, 7, 9], [0, 2, 3]]


def test_marks_of_whole_arrays():
    rng = np.random.default_rng(5)
    for low in (0, -10**12):
        goods, user = rng.integers(low, 10**11, 200), rng.integers(low, 10**15, 90)
        wanted = [[pow(abs(int(g) + int(u)) % 3_000_000_019, 2) % 1_000_003 for g in goods] for u in user]
        assert (marks(goods[None, :], user[:, None]) == np.array(wanted)).all()


def test_the_daily_plan_keeps_users_and_goods_apart(spark):
    t = Retail(spark, SF)
    pairs = rules_daily.listable_pairs(t.rule_inputs, AS_OF, rules_daily.rule_sale(t.rule_inputs, AS_OF, DAYS), MIN_TAGS)
    assert isinstance(pairs, rules.Pairs)
    top = entry.queries()["tag_goods_top"](spark, SF)
    assert not any(step in behind(top) for step in ("Join", "Aggregate", "Window"))


def test_scores_beside_similarities(spark, rows):
    frequency = spark.createDataFrame([("a", "p", 2), ("a", "q", 1), ("b", "q", 4), (None, "p", 1)], "user_id string, tag string, n bigint")
    pool = spark.createDataFrame([(1, ["p"]), (2, ["q", "r"]), (3, ["p", "q"])], "goods_id bigint, tags array<string>")
    depths = spark.createDataFrame([(1, 2), (3, 1)], "goods_id bigint, depth int")
    own = spark.createDataFrame([("a", 1, 7), ("b", 2, 4), ("b", 1, 2)], "user_id string, goods_id bigint, depth int")
    sims = similarity.tag_similarity(frequency, pool, similarity.user_depths(own))
    wanted = similarity.similarity_score(sims, similarity.category_distance(sims, own, depths))
    beside = similarity.similarity_score(sims, similarity.category_distance(sims, own, depths, keep=["sim"]))
    assert rows(beside) == rows(wanted) != []
    assert beside._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_goods_of_equal_tags_and_depth_are_cut_before_they_meet_users(spark, rows):
    users = spark.createDataFrame([("a",), ("b",)], "user_id string")
    frequency = spark.createDataFrame([("a", "p", 2), ("a", "q", 1), ("b", "q", 4)], "user_id string, tag string, n bigint")
    pool = spark.range(200).selectExpr("id AS goods_id", "if(id % 2 = 0, array('p', 'q', 'p'), array('r', 'q')) AS tags",
                                       "cast(id % 7 AS double) AS sale", "cast(id % 3 AS int) AS depth")
    extra = users.selectExpr("user_id", "cast(40 AS bigint) AS depth_sum", "cast(3 AS bigint) AS n_goods")
    near = similarity.best_matches(frequency, pool, extra, 5, max_pool_tags=2 * 2 * 3 * 5)  # tags, sets, depths, goods
    assert "MapInPandas" in near._jdf.queryExecution().optimizedPlan().toString()
    assert rows(near) == rows(similarity.best_matches(frequency, pool, extra, 5, max_pool_tags=0)) != []
