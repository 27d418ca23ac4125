"""Small frames with answers worked out by hand."""

import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import arrays, dates
from shelfwise.operators import catalog, follow, groups, hierarchy, merge, profile, rules, sales, similarity
from shelfwise.session import staged
from shelfwise.sources import documents, partitions, tables

DYNAMIC = "goods_id bigint, sale bigint, amount double, tags array<string>, state string, pt string"
FOCUS = "user_id string, type string, value string"
NODES = "platform string, node string, parent string, text string, has_child boolean"


def test_focus_flatten(spark, rows):
    raw = spark.createDataFrame([
        ("u", "n", "category", [("A.12",), ("12",), ("A.12.9",)]),
        ("u", "n", "goods", None), ("u", "n", "goods", []), ("v", "n", "goods", [("A.1",)]),
    ], documents.FOCUS_SCHEMA)
    assert rows(documents.focus_flatten(raw, with_name=False)) == [
        ("u", "category", "12"), ("u", "category", "12"), ("u", "category", "12"), ("v", "goods", "A.1")]


def test_declared_schema_reads_an_empty_source(spark, tmp_path):
    (tmp_path / "empty.json").write_text("")
    raw = documents.read_documents(spark, str(tmp_path / "empty.json"), documents.FOCUS_SCHEMA)
    assert documents.focus_flatten(raw).count() == 0


def test_sale_window_leaves_out_unknown_off_and_old(spark, rows):
    dynamic = spark.createDataFrame([
        (1, 5, 0.0, [], "", "2001-06-30"), (1, 7, 0.0, [], "", "2001-06-24"),
        (1, 100, 0.0, [], "", "2001-06-23"), (1, None, 0.0, [], "", "2001-06-30"),
        (2, 2147483647, 0.0, [], "", "2001-06-30"), (3, 4, 0.0, [], "off", "2001-06-30"),
    ], DYNAMIC)
    assert rows(sales.sale_window(dynamic, "2001-06-30")) == [(1, 12)]
    assert rows(sales.sale_window(dynamic, "20010630", state=None)) == [(1, 12), (3, 4)]


def test_known_amount(spark, rows):
    dynamic = spark.createDataFrame([
        (1, 1, float("nan"), [], "", "x"), (2, 1, None, [], "", "x"), (3, 1, 2.0, [], "", "x")], DYNAMIC)
    assert rows(sales.known_amount(dynamic).select("goods_id")) == [(3,)]


def test_category_explode(spark, rows):
    static = spark.createDataFrame([
        (1, 9, None), (2, 9, {"WISH": []}), (3, 9, {"WISH": [None, "a"]}), (4, 9, {"OTHER": ["b"]}),
    ], "goods_id bigint, shop_id bigint, category map<string,array<string>>")
    assert rows(catalog.category_explode(static)) == [(3, 9, "a"), (3, 9, "aa"), (4, 9, "b")]
    assert rows(catalog.category_explode(static, "WISH")) == [(3, 9, "a"), (3, 9, None)]


def test_fresh_goods_accepts_a_future_start(spark, rows):
    static = spark.createDataFrame(
        [(1, date(2001, 7, 30)), (2, date(2001, 5, 2)), (3, date(2001, 5, 1))], "goods_id bigint, generate_time date")
    assert rows(sales.fresh_goods(static, "2001-06-30")) == [(1,), (2,)]


def test_dense_ranks_keep_ties_and_put_nulls_last(spark, rows):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 4), ("a", 4, None), ("a", 5, None),
                                (None, 6, 1)], "k string, id bigint, v bigint")
    assert rows(groups.dense_ranks(df, ["k"], "v", "r", 2).select("id", "r")) == [(1, 1), (2, 1), (3, 2), (6, 1)]
    assert rows(groups.dense_ranks(df, ["k"], "v", "r").select("id", "r")) == [
        (1, 1), (2, 1), (3, 2), (4, 3), (5, 3), (6, 1)]


def test_user_top_categories(spark, rows):
    focus = spark.createDataFrame([
        ("u", "goods", "1"), ("u", "goods", "2"), ("u", "goods", "3"), ("u", "tag", "x"), ("u", "tag", "y"),
        ("v", "shop", "1"), ("w", "goods", "01")], FOCUS)
    listed = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (1, "c")], "goods_id bigint, category string")
    assert rows(follow.user_top_categories(focus, listed, k=1)) == [
        ("u", "a", 1), ("v", None, 1), ("w", None, 1)]
    effective = rows(follow.user_top_categories(focus, listed, distinct_first=True))
    assert effective == [("u", "a", 1), ("u", "b", 1), ("u", "c", 1), ("u", None, 1), ("v", None, 1), ("w", None, 1)]


def test_newuser_fallback_by_position(spark, rows):
    lists = spark.createDataFrame([
        ("newUser", "hot", [1, 2, 3, 4, 5]), ("u", "hot", [9, 4]), ("u", "potential", [7]),
    ], "user_id string, type string, `values` array<bigint>")
    got = {(r.user_id, r.type): r["values"] for r in rules.newuser_fallback(lists).collect()}
    assert got[("u", "hot")] == [9, 4, 3, 4, 5]
    assert got[("u", "potential")] == [7, None, None, None, None]
    unique = {(r.user_id, r.type): r["values"] for r in rules.newuser_fallback(lists, dedupe_fallback=True).collect()}
    assert unique[("u", "hot")] == [9, 4, 1, 2, 3]
    assert unique[("u", "potential")] == [7, None, None, None, None]


def test_lists_cut_ties_by_goods(spark, rows):
    ranked = spark.createDataFrame([("u", g, float(p), 0.0, p, 0.0) for g, p in
                                    [(1, 50), (2, 40), (3, 30), (4, 20), (8, 15), (7, 15), (6, 15), (5, 11), (9, 10)]],
                                   "user_id string, goods_id bigint, priority_hot double, priority_potential double, "
                                   "sale bigint, prediction double")
    hot = rules.hot_list(ranked)
    assert rows(hot.filter("rank = 5").select("goods_id")) == [(6,), (7,), (8,)]
    lists = rules.result_lists(hot, rules.potential_list(ranked)).collect()
    assert [r["values"] for r in lists] == [[1, 2, 3, 4, 6]]


def test_history_window_and_type(spark, rows):
    recommend = spark.createDataFrame([
        ("u", "hot", [1], "20010628"), ("u", "potential", [2], "20010629"),
        ("u", "hot", [3], "20010630"), ("u", "hot", [4], "20010627"),
    ], "user_id string, type string, `values` array<bigint>, pt string")
    assert rows(rules.recent_pairs(recommend, "2001-06-30")) == [("u", 1), ("u", 2)]
    lists = spark.createDataFrame([("u", 1, 1), ("u", 2, 2), ("v", 1, 1)],
                                  "user_id string, goods_id bigint, position int")
    assert rows(similarity.suppress_history(lists, recommend, "potential", "2001-06-30")) == [
        ("u", "potential", [1]), ("v", "potential", [1])]
    only = lists.filter("goods_id = 2 and user_id = 'u'")
    assert rows(similarity.suppress_history(only, recommend, "potential", "2001-06-30")) == [("u", "potential", [])]


def test_category_tree(spark, rows):
    nodes = spark.createDataFrame([
        ("P", "r", "0", "root", True), ("P", "a", "r", "a", True), ("P", "x", "r", "x2", False),
        ("P", "x", "a", "x3", False), ("P", "orphan", "none", "o", False),
        ("P", "c1", "c2", "", True), ("P", "c2", "c1", "", True), ("Q", "q", "0", "q", False)], NODES)
    closure = hierarchy.category_closure(nodes)
    ids = spark.createDataFrame([("x",), ("q",), ("orphan",), ("zz",)], "id string")
    assert rows(hierarchy.category_min_level(hierarchy.node_levels(nodes), ids)) == [("orphan", -1), ("q", 1), ("x", 2), ("zz", -1)]
    assert rows(hierarchy.category_levels(closure, ids)) == [
        ("orphan", None, 0), ("q", 1, 1), ("x", 2, 1), ("x", 3, 1), ("zz", None, 0)]
    assert rows(hierarchy.unplaced_nodes(nodes, closure).select("node")) == [("c1",), ("c2",), ("orphan",)]
    assert hierarchy.category_count(closure).first()[0] == 5
    assert hierarchy.category_find(closure, ids).count() == 3


def test_depth_of_unknown_and_missing_categories(spark, rows):
    levels = spark.createDataFrame([("a", 2), ("b", 3)], "node string, level int")
    static = spark.createDataFrame([
        (1, {"WISH": ["a", "b"]}), (2, {"WISH": ["zz"]}), (3, {"WISH": []}), (4, {"OTHER": ["a"]}), (5, None),
    ], "goods_id bigint, category map<string,array<string>>")
    assert rows(hierarchy.goods_depth(static, static, levels)) == [(1, 3), (2, 0), (3, 0)]
    pairs = spark.createDataFrame([("u", g) for g in (1, 1, 4, 5, 99, None)], "user_id string, goods_id bigint")
    assert rows(hierarchy.focus_goods_depth(pairs, static, levels)) == [("u", 1, 3), ("u", 4, 0), ("u", 5, 0)]


def test_similarity_formula(spark, rows):
    frequency = spark.createDataFrame([("u", "a", 2), ("u", "b", 1)], "user_id string, tag string, n bigint")
    pool = spark.createDataFrame([(1, ["a"]), (2, ["a", "b", "a"]), (3, ["c"]), (4, None)],
                                 "goods_id bigint, tags array<string>")
    got = {r.goods_id: r.sim for r in similarity.tag_similarity(frequency, pool).collect()}
    norm = math.sqrt(5) * math.sqrt(2)
    assert got == {1: pytest.approx(2 / norm), 2: pytest.approx(3 / norm)}


def test_distance_formula(spark):
    pairs = spark.createDataFrame([("u", 1), ("u", 3), ("u", 7), ("v", 1)], "user_id string, goods_id bigint")
    own = spark.createDataFrame([("u", 10, 3), ("u", 11, 2)], "user_id string, goods_id bigint, depth int")
    depths = spark.createDataFrame([(1, 1), (3, 3)], "goods_id bigint, depth int")
    got = {(r.user_id, r.goods_id): r.distance for r in similarity.category_distance(pairs, own, depths).collect()}
    assert got == {("u", 1): pytest.approx(math.log2(3)), ("u", 3): 2.0, ("u", 7): 1.0, ("v", 1): 1.0}


def test_backfill(spark, rows):
    lists = spark.createDataFrame([("u", 2, 1), ("u", 9, 2)], "user_id string, goods_id bigint, position int")
    defaults = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "goods_id bigint, position int")
    assert rows(similarity.backfill(lists, defaults, 4)) == [("u", 1, 3), ("u", 2, 1), ("u", 3, 4), ("u", 9, 2)]


def test_merge_records(spark, rows):
    df = spark.createDataFrame([
        ("one", "k", "x", [1]), ("two", "b", "y", [1, 2]), ("two", "a", "", [2]), ("two", "c", "y", None),
        ("none", "z", "", None)], "key string, name string, word string, ids array<int>")
    assert rows(merge.merge_records(df, "key", ["name"], ["word", "ids"])) == [
        ("none", 0, "z", [], []), ("one", 0, "k", ["x"], [1]), ("two", 0, "a", ["y"], [1, 2])]
    assert rows(merge.merge_records(df, "key", ["name"], ["word", "ids"], keep_dup=True))[2] == (
        "two", 0, "a", ["y", "y"], [1, 2, 2])


def counted_stages(monkeypatch):
    """Names under which frames are stored, in order."""
    names = []
    monkeypatch.setattr(hierarchy, "staged", lambda df, name: names.append(name) or staged(df, name))
    return names


def test_rounds_grow_with_the_logarithm_of_the_depth(spark, monkeypatch):
    nodes = spark.createDataFrame([("P", str(i), str(i - 1), "", True) for i in range(1, 51)], NODES)
    names = counted_stages(monkeypatch)
    levels = hierarchy.node_levels(nodes)
    assert {int(r.node): r.level for r in levels.collect()} == {i: i for i in range(1, 51)}
    assert names.count("levels") - 1 <= 7
    assert sorted(r.path for r in hierarchy.category_closure(nodes).collect()) == sorted([str(k) for k in range(1, i + 1)] for i in range(1, 51))
    assert names.count("places") - 1 <= 7


def test_tree_of_nothing(spark):
    for nodes in (spark.createDataFrame([], NODES), spark.createDataFrame([("P", "a", "b", "", True)], NODES)):
        assert hierarchy.node_levels(nodes).count() == 0 and hierarchy.category_closure(nodes).count() == 0


def test_levels_need_no_paths(spark):
    """A chain of 40 diamonds has 2^40 places at its end."""
    rows = [("P", "n0", "0", "", True)]
    for i in range(40):
        rows += [("P", f"{side}{i}", f"n{i}", "", True) for side in "ab"] + [("P", f"n{i + 1}", f"{side}{i}", "", True) for side in "ab"]
    rows.append(("P", "n40", "x", "", False))
    got = {r.node: r.level for r in hierarchy.node_levels(spark.createDataFrame(rows, NODES)).collect()}
    assert got == {f"n{i}": 2 * i + 1 for i in range(41)} | {f"{side}{i}": 2 * i + 2 for side in "ab" for i in range(40)}


def test_closure_of_random_graphs(spark):
    """Several parents, repeated records, cycles behind a root, nodes of their own parent, null ids."""
    draw = random.Random(3)
    for _ in range(3):
        ids = [str(i) for i in range(1, 10)]
        records = [("P", draw.choice(ids), draw.choice(["0", *ids]), draw.choice("xy"), True) for _ in range(14)]
        records += [("P", "1", "0", "r", True), ("P", None, "0", "r", True), ("P", "3", None, "r", True), ("P", "5", "5", "r", True)]
        places = todo = [(n, p, t, (n,)) for _, n, p, t, _ in records if p == "0"]
        while todo:
            todo = [(n, p, t, (*path, n)) for end, _, _, path in todo if end is not None for _, n, p, t, _ in records
                    if p == end and p != "0" and n not in path]
            places = places + todo
        nodes = spark.createDataFrame(records, NODES)
        got = [(r.node, r.parent, r.text, tuple(r.path)) for r in hierarchy.category_closure(nodes).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, places))
        least = {n: min(len(path) for m, _, _, path in places if m == n) for n, *_ in places}
        assert {r.node: r.level for r in hierarchy.node_levels(nodes).collect()} == least


def test_deep_trees_have_no_limit(spark):
    nodes = spark.createDataFrame([("P", str(i), str(i - 1), "", True) for i in range(1, 28)], NODES)
    closure = hierarchy.category_closure(nodes)
    assert sorted(r.level for r in closure.collect()) == list(range(1, 28))
    assert hierarchy.unplaced_nodes(nodes, closure).count() == 0


def test_forecast_and_day_are_the_latest_ones(spark, rows):
    sale = spark.createDataFrame([(1, 5)], "goods_id bigint, sale bigint")
    forecast = spark.createDataFrame([(1, 2.0, "20010629"), (1, 3.0, "20010630")], "goods_id bigint, prediction double, pt string")
    assert rows(sales.sale_with_forecast(sale, forecast)) == [(1, 5, 3.0)]
    assert rows(sales.sale_with_forecast(sale, forecast, "20010629")) == [(1, 5, 2.0)]
    assert rows(sales.sale_with_forecast(sale, forecast.filter("false"))) == [(1, 5, None)]
    assert partitions.day_to_run(forecast) == "20010630"
    with pytest.raises(ValueError, match="no partition"):
        partitions.day_to_run(forecast, "20010701")


def test_lists_come_in_blocks(spark):
    """A third of all rows, as one value and as many, in blocks of seven places."""
    rows = ([("hot", f"t{i % 50:02}") for i in range(1000)] + [("hot", "same")] * 500 + [("cold", "t1"), ("cold", None), ("empty", None)]
            + [(None, "x")] * 9 + [(f"u{i}", "t") for i in range(20)])
    tags = spark.createDataFrame(rows, "user_id string, tag string").repartition(5)
    lists = {(r.user_id, r.block): r.tags for r in profile.user_tag_list(tags, 7).collect()}
    hot = sorted(t for u, t in rows if u == "hot")
    assert [lists["hot", k] for k in range(-(-len(hot) // 7))] == [hot[i:i + 7] for i in range(0, len(hot), 7)]
    assert lists["cold", 0] == ["t1"] and lists["empty", 0] == [] and lists[None, 0] == ["x"] * 7 and lists[None, 1] == ["x"] * 2
    assert len(lists) == -(-len(hot) // 7) + 2 + 2 + 20


def test_blocks_of_several_lists(spark):
    frequency = spark.createDataFrame([("u", f"t{i}", i) for i in range(5)] + [("v", "t", 1)], "user_id string, tag string, n bigint")
    pairs = spark.createDataFrame([("u", i) for i in range(3)] + [("w", 1), ("w", 1), ("w", None)], "user_id string, goods_id bigint")
    got = {(r.user_id, r.block): (r.tags, r.goods) for r in profile.user_profile(frequency, pairs, 2).collect()}
    assert got == {("u", 0): ({"t0": 0, "t1": 1}, [0, 1]), ("u", 1): ({"t2": 2, "t3": 3}, [2]), ("u", 2): ({"t4": 4}, None),
                   ("v", 0): ({"t": 1}, None), ("w", 0): (None, [1])}
    records = spark.createDataFrame([("k", "a", ["x", "y", "y"], 3), ("k", "b", ["z"], None), ("n", "c", None, None)],
                                    "key string, first string, list array<string>, number int")
    merged = merge.merge_records(records, "key", ["first"], ["list", "number"], keep_dup=True, block=2)
    assert {(r.key, r.block): (r["first"], r["list"], r.number) for r in merged.collect()} == {
        ("k", 0): ("a", ["x", "y"], [3]), ("k", 1): ("a", ["y", "z"], []), ("n", 0): ("c", [], [])}
    nodes = spark.createDataFrame([("P", str(i // 2), "0", None, True) for i in range(10)], NODES)
    blocks = {r.block: [n.node for n in r.nodes] for r in documents.nodes_by_platform(nodes, 4).collect()}
    assert blocks == {0: ["0", "0", "1", "1"], 1: ["2", "2", "3", "3"], 2: ["4", "4"]}


def test_expanded_user_tags_equals_the_composition(spark, rows):
    focus = spark.createDataFrame([("u", "goods", "1"), ("v", "goods", "3"), ("w", "tag", "x")], FOCUS)
    static = spark.createDataFrame([
        (1, 9, {"WISH": ["a", "b"]}), (2, 9, {"WISH": ["a"]}), (3, 9, {"WISH": ["c", None]}), (4, 9, {"WISH": ["b", "b"]}),
    ], "goods_id bigint, shop_id bigint, category map<string,array<string>>")
    dynamic = spark.createDataFrame([(g, 1, 1.0, [f"t{g}", "all"], "", "p") for g in (1, 2, 3)] +
                                    [(2, 1, 1.0, ["new"], "", "q")], DYNAMIC)
    pairs = merge.category_expand(focus, static)
    assert ("u", 4, 2) in rows(pairs) and ("w", None, 1) in rows(pairs)
    stepwise = merge.user_tag_merge(merge.expand_tags(pairs, dynamic))
    assert rows(merge.expanded_user_tags(focus, static, dynamic)) == rows(stepwise)


def test_array_functions(spark, rows):
    df = spark.createDataFrame([(["a", "a", "b"], ["a"]), ([""], ["a"]), (None, ["a"]), ([None, "a"], [None])],
                               "l array<string>, r array<string>")
    assert [r[0] for r in df.select(arrays.intersect_keep_dup("l", "r")).collect()] == [["a", "a"], None, None, [None]]
    one = spark.createDataFrame([(None,), (3,)], "x bigint").select(arrays.to_array("x"))
    assert [r[0] for r in one.collect()] == [[None], [3]]


def test_partition_dates(spark):
    df = spark.createDataFrame([("20010301", "2001-03-01")], "a string, b string")
    got = df.select(dates.shift_pt("a", -1), dates.shift_pt("b", 1, dates.DASHED), dates.pt_diff("a", F.lit("20010401")))
    assert tuple(got.first()) == ("20010228", "2001-03-02", 31.0)
    assert dates.pt_text("2001-03-01", -1) == "20010228"


def test_tables(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id bigint, s string")
    assert tables.save_partition_table(df, "shop.result", "20010629")
    assert tables.save_partition_table(df.withColumn("extra", F.lit(1)), "shop.result", "20010630")
    assert not tables.save_partition_table(df.drop("s"), "shop.result", "20010701")
    for _ in range(2):  # a second run gives the same content
        assert tables.save_partition_table(df.filter("id = 1"), "shop.result", "20010630")
    assert rows(spark.table("shop.result")) == [(1, "x", "20010629"), (1, "x", "20010630"), (2, "y", "20010629")]
    names = partitions.partition_list(spark, "shop.result")
    assert rows(names) == [("20010629",), ("20010630",)]
    assert partitions.as_value(partitions.latest_pt(names)) == "20010630"
    assert partitions.as_value(partitions.nearest_partition_before(names, "20010629")) is None
    assert partitions.as_value(partitions.has_partition_between(names, "20010629", "20010630"))
    assert not partitions.as_value(partitions.has_partition_between(names, "20010630", "20010701"))
    tables.overwrite_partition(df.filter("id > 5"), "shop.result", "20010629")
    assert rows(spark.table("shop.result")) == [(1, "x", "20010630")]
    tables.drop_table_if_exists(spark, "shop.result")
    assert not spark.catalog.tableExists("shop.result")


def test_merged_rows_do_not_grow(spark):
    df = spark.range(1000).selectExpr("id % 2 AS key", "'w' AS word", "array(id % 4, 7) AS ids")
    got = merge.merged_rows(df, "key", ["word", "ids"], keep_dup=True).collect()
    assert sorted((r.key, r.source, r.word, r.ids, r.copies) for r in got if r.source == "word") == [
        (k, "word", "w", None, 500) for k in (0, 1)]
    assert sorted((r.key, r.ids, r.copies) for r in got if r.source == "ids") == [
        (0, 0, 250), (0, 2, 250), (0, 7, 500), (1, 1, 250), (1, 3, 250), (1, 7, 500)]
    assert {r.copies for r in merge.merged_rows(df, "key", ["word", "ids"]).collect()} == {1}
