"""Evidence of users for goods, brought together for whole batches of users among goods that were checked to be few.

Spark spreads and orders what users follow and were shown, as rows of user, kind and number; the goods behind
these numbers go to the tasks. There a batch of users meets ranges of the goods, and a task hands on lists. No
pair of user and goods is exchanged or stored; lists of best goods stop as soon as every user of a batch has them.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, ShortType, StructField, StructType

from shelfwise import settings as S
from shelfwise.operators import follow
from shelfwise.operators.classes import goods_classes
from shelfwise.operators.groups import null_safe_join
from shelfwise.operators.tag_batches import ranks_among, whole_users
from shelfwise.session import small_enough, staged

# Workers get these functions with the job, whether or not the package is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Goods, and rows of goods and shops or categories or tags, that may be sent to every task: some 30 bytes a goods there.
GOODS_ROWS = 10_000_000
#: Users times goods that a task holds at once.
CELLS = 1_000_000
#: Goods of a day that share a tag are counted for so many cells at once.
TAGGED = 4
#: Pairs whose marks are made at once, so that they stay in the caches.
MARKS = 32_768
#: Goods, best first, that users meet first where only the best are asked for.
FIRST_RANGE = 512

KINDS = ["goods", "shop", "category", "tag", "history"]
GOODS, SHOP, CATEGORY, TAG, HISTORY = range(5)


def expand(starts: np.ndarray, items: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items of lists stored one after the other, for every code, with the place of the code that asks for them."""
    first = starts[code]
    length = starts[code + 1] - first
    at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length - first, length)
    return np.repeat(np.arange(len(code)), length), items[at]


def as_lists(table: pa.Table, code: str, *values: str) -> tuple[np.ndarray, ...]:
    """Starts and values, list after list, of rows of a code (from 0) and values."""
    key = table[code].to_numpy()
    order = np.argsort(key, kind="stable")
    starts = np.searchsorted(key[order], np.arange(int(key.max(initial=-1)) + 2))
    return starts, *[table[v].to_numpy()[order] for v in values]


def numbered_keys(keys: DataFrame, code: str) -> DataFrame:
    """Distinct keys numbered from 0. They were counted before, so a window over all of them is bounded."""
    order = Window.orderBy(*[F.col(c).asc_nulls_first() for c in keys.columns])
    return staged(keys.distinct().withColumn(code, F.row_number().over(order) - 1), code)


@dataclass(frozen=True)
class PairMark:
    """A whole number of every pair, to be summed: ``each`` (arrays) and ``value`` (an expression) make it from a number of
    the goods and one of the user. A user whose number is null has null marks."""
    goods: Column
    user: Column
    value: Column
    each: Callable[[np.ndarray, np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Evidence:
    """What users follow and were shown (user_id, kind, code), the numbers of goods (goods_id, place; that of the null
    goods is 0) and what is sent to the tasks."""
    known: DataFrame
    places: DataFrame
    sent: Any

    def of_users(self, users: DataFrame, how: str) -> Evidence:
        """With ``how`` "left_semi" only those users, with "left_anti" all others; null is a user."""
        return Evidence(null_safe_join(self.known, users, ["user_id"], how), self.places, self.sent)

    def counts(self) -> DataFrame:
        """user_id, goods_id and the number of rows of evidence of each kind, for all pairs that have any."""
        totals = [StructField(f"total_support_{kind}", LongType()) for kind in KINDS]
        return self._run("counts", self.places.select("goods_id"), totals)

    def pairs(self, goods: DataFrame, without: tuple[DataFrame, str, int, bool] | None = None) -> DataFrame:
        """user_id and rows of goods (goods_id and more) that the user follows in any way and was not shown. Of
        ``without``, goods rows, one of their columns and k, goods within a user's k best values are left out; those of the
        null user only if the fourth part says so."""
        return self._run("listed", goods, without=without)

    def best(self, goods: DataFrame, by: str, k: int, without: tuple[DataFrame, str, int, bool] | None = None) -> DataFrame:
        """user_id, goods_id, rank of those within the k best values of ``by`` of a user; all ties stay."""
        return self._run("best", goods, [StructField("rank", IntegerType())], by, k, without)

    def count_sums(self, mark: PairMark) -> DataFrame:
        """``counts`` brought together by user and counts: the number of pairs (n_pairs) and the sum of their marks."""
        goods = self.places.select("goods_id")
        fields = [StructField(f"total_support_{kind}", LongType()) for kind in KINDS]
        return self._summed(goods, mark, fields, Batch.count_sums)

    def sums(self, goods: DataFrame, mark: PairMark, group: Sequence[str], totals: Sequence[str],
             without: tuple[DataFrame, str, int, bool] | None = None) -> DataFrame | None:
        """``pairs`` brought together by user and columns of the goods: the number of pairs (n_pairs), the sum of their
        marks and sums of other columns. Goods that are met as a class are summed as one, but for the marks. None where
        sums must be taken row by row, since a column is of another type or not finite."""
        types = [goods.schema[c].dataType for c in totals]
        if not all(isinstance(t, (ShortType, IntegerType, LongType, DoubleType)) for t in types):
            return None
        odd = [F.col(c).isin(float("inf"), float("-inf")) | F.isnan(c) for c, t in zip(totals, types) if isinstance(t, DoubleType)]
        if odd and not goods.filter(reduce(Column.__or__, odd)).isEmpty():
            return None
        fields = [*(goods.schema[c] for c in group),
                  *(StructField(c, t if isinstance(t, DoubleType) else LongType()) for c, t in zip(totals, types))]
        return self._summed(goods.select("goods_id", *group, *totals), mark, fields, Batch.sums, without, group, totals)

    def _summed(self, goods: DataFrame, mark: PairMark, fields: Sequence[StructField], fold: Callable,
                without: tuple[DataFrame, str, int, bool] | None = None, group: Sequence[str] = (), totals: Sequence[str] = ()) -> DataFrame:
        spark = self.known.sparkSession
        rows = null_safe_join(goods.withColumn("_part", mark.goods), self.places, ["goods_id"])
        table = rows.select("place", "_part", *group, *totals).toArrow()
        left_out = None if without is None else self._columns(without[0], without[1])
        n_left_out, null_safe = (0, False) if without is None else without[2:]
        sent, asked = self.sent, spark.sparkContext.broadcast({"table": table, "left_out": left_out})
        schema = StructType([self.known.schema["user_id"], *fields, StructField("n_pairs", LongType()), StructField("pair_marks", LongType())])
        each, names = mark.each, schema.fieldNames()

        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            facts, table, left_out = sent.value, asked.value["table"], asked.value["left_out"]
            order = Order(table["place"].to_numpy(), None, facts["n_places"])
            parts = Parts(facts, order, table, group, totals)
            gone = None if left_out is None else Order(left_out[0], left_out[2], facts["n_places"])
            for batch, heads, first in batches_of(batches, facts):
                if gone is not None:
                    batch.leave_out(gone, n_left_out, heads, null_safe)
                number = first["_user"].combine_chunks()
                known = number.is_valid().to_numpy(zero_copy_only=False)
                who, columns, n_pairs, sums = fold(batch, order, parts, pc.fill_null(number, 0).to_numpy(), each)
                if len(who):
                    marks = pa.array(sums.astype("int64"), mask=~known[who])
                    yield pa.RecordBatch.from_arrays([whole(heads.take(pa.array(who))), *columns, pa.array(n_pairs.astype("int64")), marks],
                                                     names=names)

        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spread = self.known.repartition(tasks, "user_id").sortWithinPartitions("user_id").withColumn("_user", mark.user.cast("bigint"))
        return spread.mapInArrow(match, schema)

    def _columns(self, goods: DataFrame, by: str | None) -> tuple[np.ndarray, pa.Table, np.ndarray | None]:
        """Places of the goods rows, what is listed of them, and the ranks if they are ordered by a column."""
        rows = null_safe_join(goods, self.places, ["goods_id"])
        if by is None:
            table = rows.toArrow()
            return table["place"].to_numpy(), table.drop_columns("place"), None
        # The goods are few, so a window over all of them is bounded.
        level = F.dense_rank().over(Window.orderBy(F.col(by).desc_nulls_last()))
        table = rows.select("place", "goods_id", level.alias("level")).orderBy("level").toArrow()
        return table["place"].to_numpy(), table.select(["goods_id"]), table["level"].to_numpy()

    def _run(self, what: str, goods: DataFrame, more: Sequence[StructField] = (), by: str | None = None, k: int = 0,
             without: tuple[DataFrame, str, int, bool] | None = None) -> DataFrame:
        spark = self.known.sparkSession
        columns = self._columns(goods, by)
        left_out = None if without is None else self._columns(without[0], without[1])
        sent, asked = self.sent, spark.sparkContext.broadcast({"columns": columns, "left_out": left_out})
        n_left_out, null_safe = (0, False) if without is None else without[2:]
        fields = StructType([*(goods.schema[c] for c in columns[1].column_names), *more])
        names = fields.fieldNames()

        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            facts, columns, left_out = sent.value, asked.value["columns"], asked.value["left_out"]
            order = Order(columns[0], columns[2], facts["n_places"])
            gone = None if left_out is None else Order(left_out[0], left_out[2], facts["n_places"])
            for batch, heads, _ in batches_of(batches, facts):
                if gone is not None:
                    batch.leave_out(gone, n_left_out, heads, null_safe)
                found = batch.best(order, k) if what == "best" else getattr(batch, what)(order)
                for who, at, extra in found:
                    if len(who):
                        yield as_rows(heads, who, columns[1].take(pa.array(at)), extra, names)

        schema = StructType([self.known.schema["user_id"], StructField("pairs", ArrayType(fields))])
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spread = self.known.repartition(tasks, "user_id").sortWithinPartitions("user_id")
        return spread.mapInArrow(match, schema).select("user_id", F.inline("pairs"))


def batches_of(batches: Iterator[pa.RecordBatch], facts: dict) -> Iterator[tuple[Batch, pa.ChunkedArray, pa.Table]]:
    """Users in batches that bound the memory, with their ids and the first row of each."""
    step = max(1, CELLS // max(facts["n_classes"] + 1, facts["n_tagged"] // TAGGED))
    for rows, number in whole_users(batches):
        for low in range(0, int(number[-1]) + 1, step):
            begin, end = np.searchsorted(number, [low, low + step])
            some, user = rows.slice(begin, end - begin), number[begin:end] - low
            first = some.take(pa.array(np.searchsorted(user, np.arange(int(user[-1]) + 1))))
            yield Batch(facts, user, some["kind"].to_numpy(), some["code"].to_numpy()), first["user_id"], first


def whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks)


def as_rows(heads: pa.ChunkedArray, who: np.ndarray, listed: pa.Table, extra: Sequence[np.ndarray], names: Sequence[str]) -> pa.RecordBatch:
    """One row for each user, with the list of what was found; ``who`` ascends."""
    users, first = np.unique(who, return_index=True)
    items = pa.StructArray.from_arrays([*map(whole, listed.columns), *map(pa.array, extra)], names=list(names))
    lists = pa.ListArray.from_arrays(pa.array([*first, len(who)], pa.int32()), items)
    return pa.RecordBatch.from_arrays([whole(heads.take(pa.array(users))), lists], names=["user_id", "pairs"])


class Order:
    """Goods rows in their order, with the rows of every place."""

    def __init__(self, places: np.ndarray, levels: np.ndarray | None, n_places: int):
        self.places, self.levels = places, levels
        self.at = np.argsort(self.places, kind="stable").astype("int32")
        self.starts = np.append(0, np.cumsum(np.bincount(self.places, minlength=n_places))).astype("int32")

    def cells(self, pairs: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Users and goods rows of users and places."""
        who, place = (np.concatenate([p[i] for p in pairs]).astype("int64") for i in (0, 1))
        asks, row = expand(self.starts, self.at, place)
        return who[asks], row


class Parts:
    """Goods rows of a class and of equal group columns, one after the other, with their numbers for the marks and sums."""

    def __init__(self, facts: dict, order: Order, table: pa.Table, group: Sequence[str], totals: Sequence[str]):
        self.n_classes = facts["n_classes"]
        self.part = table["_part"].to_numpy()
        self.class_of = facts["class_of"][order.places]
        groups = table.select(list(group)).group_by(list(group)).aggregate([]) if group else None
        self.groups = groups
        self.n_groups = groups.num_rows if group else 1
        self.group_of = np.zeros(len(self.part), "int64")
        if group and table.num_rows:
            for g, values in enumerate(groups.to_pylist()):
                same = np.ones(len(self.part), bool)
                for c, value in values.items():
                    same &= (pc.is_null(table[c]) if value is None else pc.fill_null(pc.equal(table[c], value), False)).to_numpy()
                self.group_of[same] = g
        self.values = [pc.fill_null(table[c], 0).to_numpy() for c in totals]
        self.values = [v if v.dtype == "float64" else v.astype("int64") for v in self.values]
        self.known = [table[c].is_valid().to_numpy().astype("int64") for c in totals]
        segment = self.class_of.astype("int64") * self.n_groups + self.group_of
        listed = np.flatnonzero(self.class_of < self.n_classes)
        self.rows = listed[np.argsort(segment[listed], kind="stable")]
        ids, self.starts = np.unique(segment[self.rows], return_index=True)
        self.starts = np.append(self.starts, len(self.rows))
        self.segment_class, self.segment_group = ids // self.n_groups, ids % self.n_groups

    def per_segment(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values[self.rows], self.starts[:-1]) if len(self.rows) else values[:0]

    def segments(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """Class, group and the goods' numbers."""
        for i, (c, g) in enumerate(zip(self.segment_class, self.segment_group)):
            yield c, g, self.part[self.rows[self.starts[i]:self.starts[i + 1]]]


def mark_sums(each: Callable, goods: np.ndarray, user: np.ndarray) -> np.ndarray:
    """Per user the sum of the marks with all of the goods."""
    sums = np.zeros(len(user), "int64")
    width = max(1, min(len(goods), MARKS // 8))
    step = max(1, MARKS // width)
    for low in range(0, len(goods), width):
        some = goods[None, low:low + width]
        for begin in range(0, len(user), step):
            sums[begin:begin + step] += each(some, user[begin:begin + step, None]).sum(axis=1).astype("int64")
    return sums


class Batch:
    """Users (numbered from 0) with their evidence: matrices of users and classes, and pairs of users and places."""

    def __init__(self, facts: dict, user: np.ndarray, kind: np.ndarray, code: np.ndarray):
        self.facts, self.n = facts, int(user[-1]) + 1
        own = {k: (user[kind == k], code[kind == k]) for k in range(5)}
        self.classes = {k: self._classes(*own[k]) for k in (GOODS, CATEGORY)}
        self.either = self.classes[GOODS] | self.classes[CATEGORY]
        lost = np.unique(own[GOODS][0][own[GOODS][1] < 0])  # a category without goods reaches the null goods, once
        null_class = facts["class_of"][0]
        lost = lost[~self.classes[GOODS][lost, null_class]]
        self.alone = {GOODS: (lost, np.zeros(len(lost), "int64")), SHOP: self._places(facts["shops"], *own[SHOP]),
                      TAG: self._tagged(*own[TAG])}
        self.shown = [own[HISTORY]]

    def _classes(self, user: np.ndarray, category: np.ndarray) -> np.ndarray:
        met = np.zeros((self.n, self.facts["n_classes"] + 1), bool)  # the last column is of goods without a class
        asks, found = expand(*self.facts["categories"], category[category >= 0])
        met[user[category >= 0][asks], found] = True
        return met

    @staticmethod
    def _places(lists: tuple, user: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        asks, place = expand(*lists, code)
        return user[asks], place

    def _tagged(self, user: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Goods of the day that share enough tags and rank within k by any of the ranks; other tags count for the last."""
        width = self.facts["n_tagged"]
        step = max(1, CELLS * TAGGED // max(1, width))
        found = [self._tagged_of(user[some] - low, tag[some], low, min(step, self.n - low))
                 for low in range(0, self.n, step) for some in [(user >= low) & (user < low + step)]]
        return tuple(np.concatenate([f[i] for f in found]) for i in (0, 1))

    def _tagged_of(self, user: np.ndarray, tag: np.ndarray, begin: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        facts, width = self.facts, self.facts["n_tagged"]
        hit = tag >= 0
        starts, at, weight = facts["tags"]
        asks, place = expand(starts, np.arange(len(at)), tag[hit])
        cell = np.concatenate([user[hit][asks].astype("int64") * width + at[place], user[~hit].astype("int64") * width + width - 1])
        weights = np.concatenate([weight[place], np.ones(int((~hit).sum()))])
        sums = np.bincount(cell, weights, n * width).reshape(n, width)
        met = (sums > 0) & (sums >= facts["min_tags"])
        who, found = np.nonzero(met)
        kept = np.any([ranks_among(met, level) <= facts["tag_k"] for level in facts["tag_levels"]], axis=0)
        return who[kept] + begin, facts["tag_places"][found[kept]]

    def leave_out(self, order: Order, k: int, heads: pa.ChunkedArray, null_safe: bool) -> None:
        """Count goods within the k best of a user as shown."""
        named = heads.is_valid().to_numpy() | null_safe  # by a join a null user equals none
        for who, at, _ in list(self.best(order, k)):
            self.shown.append((who[named[who]], order.places[at[named[who]]]))

    def sums(self, order: Order, parts: Parts, number: np.ndarray, each: Callable) -> tuple:
        """Users, group columns and sums of other columns, numbers of pairs, sums of marks."""
        shape = (self.n, parts.n_groups)
        n_pairs, marks = np.zeros(shape, "int64"), np.zeros(shape, "int64")
        totals = [np.zeros(shape, v.dtype) for v in parts.values]
        known = [np.zeros(shape, "int64") for _ in parts.values]
        met = self.either[:, parts.segment_class]
        for g in range(parts.n_groups):
            own = parts.segment_group == g
            n_pairs[:, g] = met[:, own] @ np.diff(parts.starts)[own]
            for sums, values in zip([*totals, *known], [*parts.values, *parts.known]):
                sums[:, g] = met[:, own].astype(values.dtype) @ parts.per_segment(values)[own]
        for i, (_, g, goods) in enumerate(parts.segments()):
            users = np.flatnonzero(met[:, i])
            marks[users, g] += mark_sums(each, goods, number[users])

        # Pairs beside the classes come in one by one, and those of classes that were shown go.
        width = max(1, len(parts.part))
        single, shown = (np.unique(who * width + row) for who, row in (order.cells(list(self.alone.values())), order.cells(self.shown)))
        in_class = [self.either[key // width, parts.class_of[key % width]] for key in (single, shown)]
        adds = np.setdiff1d(single[~in_class[0]], shown, assume_unique=True)
        for key, sign in ((adds, 1), (shown[in_class[1]], -1)):
            who, row = key // width, key % width
            at = (who, parts.group_of[row])
            np.add.at(n_pairs, at, sign)
            np.add.at(marks, at, sign * each(parts.part[row], number[who]).astype("int64"))
            for sums, values in zip([*totals, *known], [*parts.values, *parts.known]):
                np.add.at(sums, at, sign * values[row])
        who, g = np.nonzero(n_pairs)
        columns = [] if parts.groups is None else [whole(c) for c in parts.groups.take(pa.array(g)).columns]
        columns += [pa.array(t[who, g], mask=k[who, g] == 0) for t, k in zip(totals, known)]
        return who, columns, n_pairs[who, g], marks[who, g]

    def count_sums(self, order: Order, parts: Parts, number: np.ndarray, each: Callable) -> tuple:
        """Users, the five counts, numbers of pairs, sums of marks."""
        width = max(1, len(parts.part))
        bits = {k: self.classes[k] for k in (GOODS, CATEGORY)}
        keys, counts, n_pairs, marks = [], [], [], []

        def add(who: np.ndarray, by: Sequence[np.ndarray], n: np.ndarray, sums: np.ndarray) -> None:
            keys.append(who)
            counts.append(np.stack([np.broadcast_to(b, len(who)) for b in by], axis=1).astype("int64"))
            n_pairs.append(n)
            marks.append(sums)

        for i, (c, _, goods) in enumerate(parts.segments()):
            who = np.flatnonzero(self.either[:, c])
            add(who, [bits[GOODS][who, c], 0, bits[CATEGORY][who, c], 0, 0], np.full(len(who), len(goods)), mark_sums(each, goods, number[who]))
        cells = {k: order.cells([p]) for k, p in [*self.alone.items(), (HISTORY, self.shown[0])]}
        key = {k: who * width + row for k, (who, row) in cells.items()}
        pairs = np.unique(np.concatenate(list(key.values())))
        who, row = pairs // width, pairs % width
        of_class = [bits[k][who, parts.class_of[row]] if k in bits else np.zeros(len(pairs), bool) for k in range(5)]
        found = [of_class[k] + (np.bincount(np.searchsorted(pairs, key[k]), minlength=len(pairs)) if k in key else 0) for k in range(5)]
        own = each(parts.part[row], number[who]).astype("int64")
        add(who, found, np.ones(len(pairs), "int64"), own)
        met = of_class[GOODS] | of_class[CATEGORY]
        add(who[met], [b[met] for b in of_class], np.full(int(met.sum()), -1), -own[met])

        rows = np.column_stack([np.concatenate(keys), np.concatenate(counts)])
        order_of = np.lexsort(rows.T[::-1])
        rows = rows[order_of]
        if not len(rows):
            return rows[:, 0], [pa.array([], pa.int64())] * 5, rows[:, 0], rows[:, 0]
        starts = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1)))
        n_pairs, marks = (np.add.reduceat(np.concatenate(v)[order_of], starts) for v in (n_pairs, marks))
        kept = n_pairs > 0
        rows = rows[starts][kept]
        return rows[:, 0], [pa.array(rows[:, 1 + k]) for k in range(5)], n_pairs[kept], marks[kept]

    def _met(self, order: Order, adds: tuple, drops: tuple, low: int, high: int, users: np.ndarray) -> np.ndarray:
        """Which of the users have which of the goods rows from low to high."""
        column = self.facts["class_of"][order.places[low:high]]
        met = self.either[users].take(column, axis=1)
        number = np.full(self.n, -1)
        number[users] = np.arange(len(users))
        for (who, row), value in ((adds, True), (drops, False)):
            some = (row >= low) & (row < high) & (number[who] >= 0)
            met[number[who[some]], row[some] - low] = value
        return met

    @staticmethod
    def _ranges(users: np.ndarray, length: int) -> Iterator[np.ndarray]:
        step = max(1, CELLS // max(1, length))
        return (users[i:i + step] for i in range(0, len(users), step))

    def listed(self, order: Order) -> Iterator[tuple]:
        adds, drops = order.cells(list(self.alone.values())), order.cells(self.shown)
        width = max(1, min(len(order.places), CELLS))
        for users in self._ranges(np.arange(self.n), width):
            for low in range(0, len(order.places), width):
                who, at = np.nonzero(self._met(order, adds, drops, low, low + width, users))
                yield users[who], at + low, []

    def best(self, order: Order, k: int) -> Iterator[tuple]:
        adds, drops = order.cells(list(self.alone.values())), order.cells(self.shown)
        had, low, length = np.zeros(self.n, "int32"), 0, FIRST_RANGE
        while low < len(order.places) and (had < k).any():
            high = int(np.searchsorted(order.levels, order.levels[min(low + length, len(order.places)) - 1], "right"))
            level = order.levels[low:high] - order.levels[low]
            for users in self._ranges(np.nonzero(had < k)[0], high - low):
                met = self._met(order, adds, drops, low, high, users)
                who, at = np.nonzero(met)
                rank = ranks_among(met, level) + had[users[who]]
                # Ranks ascend by goods row, so the last one of a user tells how many there are.
                np.maximum.at(had, users[who], rank)
                kept = rank <= k
                yield users[who[kept]], at[kept] + low, [rank[kept].astype("int32")]
            low, length = high, length * 4

    def counts(self, order: Order) -> Iterator[tuple]:
        cells = {k: order.cells([p]) for k, p in [*self.alone.items(), (HISTORY, self.shown[0])]}
        width = max(1, min(len(order.places), CELLS // 8))
        for users in self._ranges(np.arange(self.n), width * 8):
            for low in range(0, len(order.places), width):
                high = min(low + width, len(order.places))
                column = self.facts["class_of"][order.places[low:high]]
                counts = []
                for k in range(5):
                    shape = (len(users), high - low)
                    sums = self.classes[k][users].take(column, axis=1).astype("int64") if k in self.classes else np.zeros(shape, "int64")
                    if k in cells:
                        who, row = cells[k]
                        some = (row >= low) & (row < high) & (who >= users[0]) & (who <= users[-1])
                        np.add.at(sums, (who[some] - users[0], row[some] - low), 1)
                    counts.append(sums)
                who, at = np.nonzero(np.add.reduce(counts))
                yield users[who], at + low, [c[who, at] for c in counts]


def gathered(by_goods: follow.ReachedGoods, by_shop: follow.ShopGoods, by_category: follow.ReachedGoods,
             by_tag: follow.TagTops, history: DataFrame, max_rows: int) -> Evidence | None:
    """The five sources by user; none if the goods, or what is known of them, are too many to be sent to every task."""
    if not by_tag.overlap.few or by_goods.category_top is not by_category.category_top:
        return None
    listed = staged(follow.listed_goods(by_goods.category_top), "listed")
    shop_rows = by_shop.goods_static.filter(F.col("shop_id").isNotNull()).select("shop_id", "goods_id")
    carried = by_tag.overlap.carried.filter(F.col("tag").isNotNull())
    ids = [f.select("goods_id") for f in (listed, shop_rows, carried, history)]
    null_goods = ids[0].sparkSession.range(1).select(F.lit(None).cast(listed.schema["goods_id"].dataType).alias("goods_id"))
    known_ids = staged(ids[0].union(ids[1]).union(ids[2]).union(ids[3]).union(null_goods).distinct(), "goods-ids")
    if not (small_enough(known_ids, max_rows) and small_enough(shop_rows, max_rows)):
        return None
    classes, members = goods_classes(listed)
    if not small_enough(classes, max_rows):
        return None
    places = numbered_keys(known_ids, "place")  # the null goods is the first
    categories, shops, tags = (numbered_keys(f, "code") for f in (
        classes.select("category"), shop_rows.select("shop_id"), carried.select("tag")))

    of_class = null_safe_join(members, places, ["goods_id"]).select("class", "place").toArrow()
    in_class = classes.join(categories, "category").select("code", "class").toArrow()
    # Classes are numbered from 0 without gaps.
    ids, _ = np.unique(in_class["class"].to_numpy(), return_inverse=True)
    n_places = places.count()
    class_of = np.full(n_places, len(ids), "int32")
    class_of[of_class["place"].to_numpy()] = np.searchsorted(ids, of_class["class"].to_numpy())
    in_class = in_class.set_column(1, "class", pa.array(np.searchsorted(ids, in_class["class"].to_numpy())))
    in_shop = null_safe_join(shop_rows.join(shops, "shop_id"), places, ["goods_id"]).select("code", "place").toArrow()

    tagged = by_tag.goods()
    ranked = null_safe_join(tagged, places, ["goods_id"]).orderBy("at").toArrow()
    entries = tagged.select("at", F.inline("entries")).join(tags, "tag").select("code", "at", F.col("weight").cast("double")).toArrow()
    facts = {"n_places": n_places, "n_classes": len(ids), "class_of": class_of, "categories": as_lists(in_class, "code", "class"),
             "shops": as_lists(in_shop, "code", "place"), "tags": as_lists(entries, "code", "at", "weight"),
             "tag_places": ranked["place"].to_numpy(), "n_tagged": ranked.num_rows, "min_tags": by_tag.overlap.min_tags, "tag_k": by_tag.k,
             "tag_levels": [ranked[name].to_numpy() for name in ("rank_sale", "rank_prediction")]}

    def coded(rows: DataFrame, keys: DataFrame, kind: int, how: str) -> DataFrame:
        key = keys.columns[0]
        return rows.select("user_id", key).join(keys, key, how).select(
            "user_id", F.lit(kind).alias("kind"), F.coalesce("code", F.lit(-1)).alias("code"))

    shown = null_safe_join(history.select("user_id", "goods_id"), places, ["goods_id"]).select(
        "user_id", F.lit(HISTORY).alias("kind"), F.col("place").alias("code"))
    known = (coded(by_goods.own, categories, GOODS, "left").unionByName(coded(by_shop.followed(), shops, SHOP, "inner"))
             .unionByName(coded(by_category.own, categories, CATEGORY, "inner"))
             .unionByName(coded(follow.followed(by_tag.focus, S.FOCUS_TAG, "tag"), tags, TAG, "left")).unionByName(shown))
    return Evidence(staged(known, "known"), places, known.sparkSession.sparkContext.broadcast(facts))
