"""Mixing overlapping sources to target weights by min-cost flow.

Documents that belong to the same set of sources form one membership pattern. Flow runs from
patterns to the sources they belong to: a pattern offers its words once at no cost, and again
at rising (convex) cost for every repetition, a source asks for its quota. The cheapest largest
flow decides how many words of each pattern go to each source; documents are then taken in a
seeded order, each whole, so that every run takes the same ones. The driver sees one row for
each membership pattern, a number that follows the sources, not the documents.

Defined results: null text has no words; a null source is a source of its own, last in order;
repeated rows are documents of their own; an empty table gives no rows; an empty membership
belongs to no source and is never taken.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.session import staged

WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3
#: Cost of a word by copy: later copies cost more and more.
COPY_COSTS = (0, 1, 3)
SEED = 6
#: Seeded documents are ordered inside so many shares of each pattern, which no task needs to see as a whole.
SHARES = 4096
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: Mapping[str | None, int], weights: Sequence[float] = WEIGHTS,
            most: float = MOST_COPIES) -> dict[str | None, float]:
    """Words asked of each source: all words shared by weight, none above ``most`` times its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out: dict[str | None, float] = {}
    left, open_ = float(sum(sizes.values())), list(order)
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * share > most * sizes[s]]
        if not full:
            out.update({s: weight[s] * share for s in open_})
            break
        for s in full:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return {s: max(0.0, out[s]) for s in order}


def cheapest_flow(capacity: Sequence[int], members: Sequence[Sequence[int]], quotas: Sequence[int],
                  costs: Sequence[int] = COPY_COSTS) -> list[dict[int, int]]:
    """Words that each pattern sends to each source: largest flow of least cost, by shortest augmenting paths."""
    n, m = len(capacity), len(quotas)
    start, goal = n + m, n + m + 1
    heads: list[int] = []
    room: list[int] = []
    price: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + m + 2)]

    def arc(a: int, b: int, most: int, cost: int) -> int:
        for x, y, c, p in ((a, b, most, cost), (b, a, 0, -cost)):
            out[x].append(len(heads))
            heads.append(y)
            room.append(c)
            price.append(p)
        return len(heads) - 2

    routes = {}
    for p in range(n):
        for cost in costs:
            arc(start, p, capacity[p], cost)
        for s in members[p]:
            routes[p, s] = arc(p, n + s, len(costs) * capacity[p], 0)
    for s in range(m):
        arc(n + s, goal, quotas[s], 0)
    while True:
        far = [None] * (n + m + 2)
        far[start], via, queue, queued = 0, {}, deque([start]), {start}
        while queue:
            x = queue.popleft()
            queued.discard(x)
            for e in out[x]:
                y = heads[e]
                if room[e] > 0 and (far[y] is None or far[x] + price[e] < far[y]):
                    far[y], via[y] = far[x] + price[e], e
                    if y not in queued:
                        queue.append(y)
                        queued.add(y)
        if far[goal] is None:
            break
        path, x = [], goal
        while x != start:
            path.append(via[x])
            x = heads[via[x] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount
    flows: list[dict[int, int]] = [{} for _ in range(n)]
    for (p, s), e in routes.items():
        if room[e ^ 1]:
            flows[p][s] = room[e ^ 1]
    return flows


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(docs: DataFrame, members: Column, keep: Column, weights: Sequence[float] = WEIGHTS,
        seed: int = SEED) -> DataFrame:
    """Per document: row (the column ``keep``), size, members, routes and copies.

    ``routes`` has one (source, source_size, target, copies) for each source of the document;
    ``copies`` is their sum, at most ``MOST_COPIES``. Shuffles only a few numbers of each row.
    """
    spark = docs.sparkSession
    text_hash = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    light = staged(docs.select(
        keep.alias("_row"), word_count(F.col("text")).alias("_size"), F.array_sort(F.array_distinct(members)).alias("_members"),
        F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), text_hash).alias("_ticket")), "mixing")
    light = light.withColumn("_pattern", F.to_json("_members"))
    share = F.pmod(F.shiftright("_ticket", 20), F.lit(SHARES))
    sums = light.groupBy("_pattern", share.alias("_share")).agg(F.sum("_size").alias("_words"), F.first("_members").alias("_members"))
    sums = staged(sums, "mixing-sums")
    patterns = [(r._pattern, list(r._members), r.words) for r in
                sums.groupBy("_pattern").agg(F.first("_members").alias("_members"), F.sum("_words").alias("words"))
                .orderBy("_pattern").collect()]

    sizes: dict[str | None, int] = {}
    for _, inside, words in patterns:
        for s in inside:
            sizes[s] = sizes.get(s, 0) + words
    # Words that several sources share count once for the mix as a whole.
    asked = targets(sizes, weights) if sizes else {}
    total, claimed = sum(w for _, inside, w in patterns if inside), sum(asked.values())
    if claimed:
        asked = {s: t * min(1.0, total / claimed) for s, t in asked.items()}
    order = list(asked)
    flows = cheapest_flow([w for _, _, w in patterns], [[order.index(s) for s in inside] for _, inside, _ in patterns],
                          [round(asked[s]) for s in order])
    plan = []
    for (pattern, inside, words), flow in zip(patterns, flows, strict=True):
        begin, routes = 0, []
        for s in inside:
            end = begin + flow.get(order.index(s), 0)
            routes.append((s, sizes[s], asked[s], begin, end))
            begin = end
        plan.append((pattern, words, routes))
    planned = spark.createDataFrame(plan, "_pattern string, _all long, _plan array<struct<source: string, source_size: long, "
                                          "target: double, begin: long, end: long>>")
    before = Window.partitionBy("_pattern").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_pattern", "_share", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_base"))
    inner = (Window.partitionBy("_pattern", "_share").orderBy("_ticket", "_size")
             .rowsBetween(Window.unboundedPreceding, -1))
    placed = (light.withColumn("_share", share)
              .withColumn("_inner", F.coalesce(F.sum("_size").over(inner), F.lit(0)))
              .join(starts, ["_pattern", "_share"]).join(F.broadcast(planned), "_pattern"))
    # Copy r of a document stands in the pattern's stream of words at its middle.
    middle = [F.col("_base") + F.col("_inner") + F.col("_size") / 2 + r * F.col("_all") for r in range(MOST_COPIES)]
    routes = F.transform("_plan", lambda p: F.struct(
        p["source"].alias("source"), p["source_size"].alias("source_size"), p["target"].alias("target"),
        sum(((m >= p["begin"]) & (m < p["end"])).cast("int") for m in middle).alias("copies")))
    return placed.select(F.col("_row").alias("row"), F.col("_size").alias("size"),
                         F.col("_members").alias("members"), routes.alias("routes")).withColumn(
        "copies", F.aggregate("routes", F.lit(0), lambda a, r: a + r["copies"]))


def mix_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies for documents of one source each."""
    out = mix(docs, F.array("source"), F.struct(F.col("doc_id").cast("long").alias("doc_id")))
    route = F.col("routes")[0]
    return out.select("row.doc_id", "size", route["source_size"].alias("source_size"), route["target"].alias("target"),
                      (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed(docs: DataFrame) -> DataFrame:
    """The mixed corpus: the columns of ``docs``, each document as often as it is taken."""
    out = mix(docs, F.array("source"), F.struct(*[docs[c] for c in docs.columns])).filter(F.col("copies") > 0)
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select("row.*")
