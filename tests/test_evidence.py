"""Evidence kept by users and by goods gives the rows of evidence brought together by pair, and exchanges no pair."""

import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import evidence, follow, rules

AS_OF = "2001-06-30"


@pytest.fixture(scope="module")
def tables(spark):
    random.seed(11)
    users = [*"abcdefgh", None, "newUser"]
    focus = [(u, kind, str(random.choice(values))) for u in users for kind, values in (
        ("goods", range(30)), ("shop", range(7)), ("category", "vwxyz"), ("tag", "pqrs!")) for _ in range(random.randrange(5))]
    focus += focus[:9] + [("a", "tag", None), ("b", "category", None), ("i", "category", "nowhere"), ("j", "other", "1")]
    static = [(g, random.choice([None, *range(6)]), f"2001-0{random.choice([1, 6])}-15") for g in [*range(30), 3, 4, None]]
    top = [(g, random.choice([*"vwxy", None])) for g in [*range(25), None] for _ in range(3)]
    own = [(u, random.choice([*"vwxyz", None])) for u in users for _ in range(2)] + [("k", None)]
    sale = [(g, random.choice([None, 5, 20, 30, 40, 50]), random.choice([None, 1.0, 2.0, 40.0])) for g in [*range(28), 7, None]]
    day = [(g, random.choice([["p", "q"], ["p", "r", "p"], ["s"], None])) for g in [*range(10), 2, None]]
    shown = [(random.choice(users), random.choice([*range(40), None])) for _ in range(25)]
    return {
        "focus": spark.createDataFrame(focus, "user_id string, type string, value string"),
        "static": spark.createDataFrame(static, "goods_id bigint, shop_id bigint, day string").withColumn("generate_time", F.to_date("day")),
        "top": spark.createDataFrame([(g, c, 1, 0) for g, c in top], "goods_id bigint, category string, rank_sale int, rank_prediction int"),
        "own": spark.createDataFrame(own, "user_id string, category string"),
        "sale": spark.createDataFrame(sale, "goods_id bigint, sale bigint, prediction double"),
        "day": spark.createDataFrame(day, "goods_id bigint, tags array<string>"),
        "shown": spark.createDataFrame(shown, "user_id string, goods_id bigint"),
        "potential": spark.createDataFrame([(g,) for g in range(0, 30, 2)] + [(2,)], "goods_id bigint"),
        "newuser": spark.createDataFrame([("newUser", g, 1) for g in (1, 2, 2, 9, 33)], "user_id string, goods_id bigint, total_support int"),
    }


def support(t, few):
    overlap = follow.followed_overlap(t["focus"], t["day"], 1)
    found = rules.support_counts(follow.by_goods(t["own"], t["top"]), follow.ShopGoods(t["focus"], t["static"]),
                                 follow.by_category(t["focus"], t["top"]), follow.TagTops(t["focus"], overlap, t["sale"], 2), t["shown"],
                                 max_rows=evidence.GOODS_ROWS if few else -1)
    assert isinstance(found, rules.Support) == few
    return found


def results(t, few):
    found = support(t, few)
    some = rules.candidates(found, t["newuser"])
    fresh = rules.fresh_candidates(some, t["static"], t["potential"], AS_OF)
    ranked = rules.priorities(fresh, t["sale"])
    both = rules.candidate_priorities(some, t["static"], t["potential"], t["sale"], AS_OF)
    ranked = ranked.stored() if few else ranked
    gone = rules.hot_to_delete(ranked, 2)
    return {"support": found, "candidates": some, "fresh": fresh, "priorities": ranked, "one pass": both, "hot": rules.hot_list(ranked, 2),
            "delete": gone, "minus": rules.minus_hot(ranked, gone, 40), "minus others": rules.minus_hot(ranked, t["shown"], 40),
            "potential": rules.potential_list(ranked, 2, 10, 40), "all": rules.potential_list(ranked, 9, 1, 1)}


@pytest.mark.parametrize("cells, first", [(1_000_000, 512), (7, 2)])
def test_by_sides_as_by_pairs(spark, rows, tables, monkeypatch, cells, first):
    monkeypatch.setattr(evidence, "CELLS", cells)
    monkeypatch.setattr(evidence, "FIRST_RANGE", first)
    many, few = results(tables, False), results(tables, True)
    for name, frame in many.items():
        got, wanted = rules.rows_of(few[name]), rules.rows_of(frame)
        assert sorted(got.columns) == sorted(wanted.columns), name
        assert dict(got.dtypes) == dict(wanted.dtypes), name
        assert rows(got.select(*wanted.columns)) == rows(wanted) != [], name


def test_no_pair_is_exchanged(tables):
    ranked = results(tables, True)
    for name in ("support", "candidates", "fresh", "priorities", "hot", "delete", "minus", "potential"):
        plan = rules.rows_of(ranked[name])._jdf.queryExecution().optimizedPlan().toString()
        behind = plan.split("MapInArrow")[0]
        assert "MapInArrow" in plan and not any(step in behind for step in ("Join", "Aggregate", "Repartition", "Window")), name
