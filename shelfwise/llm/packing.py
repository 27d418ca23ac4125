"""Packing token pieces into sequences by linear grouping and best fit.

All decisions are taken on the histogram of piece lengths, which has at most ``CAPACITY``
entries however many documents there are:

1. lengths above ``SMALL`` are sorted and cut into ``GROUPS`` groups of equal cardinality, and
   each is rounded up to its group's largest length;
2. a linear program over configurations of these few sizes is solved by column generation, its
   whole parts are used, and the rest of the large pieces is packed by best fit;
3. real pieces take the places of their group, so each configuration leaves at least the room
   that was planned;
4. small lengths, longest first, fill that room by best fit.

The result lists runs of equal sequences. Pieces of one length are then numbered in Spark, and
piece k of a length takes the k-th place for that length.

Defined results: null or empty text is a piece that holds the end id alone; repeated rows are
documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.llm import tokens
from shelfwise.session import staged

CAPACITY = 2048
SMALL = CAPACITY // 8
GROUPS = 64
END_ID = 0
#: Column generation ends here at the latest; what it has found until then is a valid packing.
ROUNDS = 1500
#: Pieces numbered together by one task, about.
NUMBERED = 1_000_000


def piece_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document: full ones, the first may be shorter."""
    first = n % capacity
    return ([first] if first else []) + [capacity] * (n // capacity)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, cut: str = "spaces") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; texts are tokenized whole."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = tokens.coder(tokenizer, cut), struct.pack("<I", end_id)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            for begin in range(0, len(batch), 256):
                some = batch.slice(begin, 256)
                rows: list[tuple] = []
                for doc_id, coded in zip(some.column(0).to_pylist(), coder.ids(some.column(1).to_pylist()), strict=True):
                    coded += end
                    at = 0
                    for i, n in enumerate(piece_lengths(len(coded) // 4, capacity)):
                        rows.append((doc_id, i, at, n, zlib.crc32(coded[4 * at:4 * (at + n)])))
                        at += n
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


@dataclass
class Run:
    """Equal sequences first .. first + count - 1 with so much room left."""
    first: int
    count: int
    room: int


@dataclass
class Packing:
    capacity: int
    sequences: int = 0
    #: By room left.
    open: dict[int, list[Run]] = field(default_factory=lambda: defaultdict(list))
    #: By length: (rank of the first piece, pieces, first sequence, offset).
    places: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=lambda: defaultdict(list))
    used: dict[int, int] = field(default_factory=lambda: defaultdict(int))

    def place(self, run: Run, length: int, times: int = 1) -> None:
        """Put ``times`` pieces of a length into each sequence of a run."""
        for _ in range(times):
            self.places[length].append((self.used[length], run.count, run.first, self.capacity - run.room))
            self.used[length] += run.count
            run.room -= length

    def new(self, count: int) -> Run:
        self.sequences += count
        return Run(self.sequences - count, count, self.capacity)

    def fill(self, run: Run, length: int, n: int) -> int:
        """Best fit of n equal pieces into a run; how many remain."""
        times = run.room // length
        full = min(run.count, n // times)
        parts = [(full, times), (int(full < run.count), min(n - full * times, times))]
        first = run.first
        for count, each in parts:
            if count and each:
                part = Run(first, count, run.room)
                self.place(part, length, each)
                self.open[part.room].append(part)
                first += count
                n -= count * each
        if first < run.first + run.count:
            self.open[run.room].append(Run(first, run.first + run.count - first, run.room))
        return n

    def best_fit(self, length: int, n: int) -> None:
        for room in sorted(r for r in self.open if r >= length):
            if not n:
                return
            for run in self.open.pop(room):
                if n:
                    n = self.fill(run, length, n)
                else:
                    self.open[room].append(run)
        if n:
            self.fill(self.new(-(-n // (self.capacity // length))), length, n)


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[np.ndarray, float]]:
    """Optimal fractional use of configurations (pieces of each size), by column generation."""
    k = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    use = demand / np.diag(basis)
    most = int(capacity // sizes.min())
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(k))
        # Best configuration at these prices: value[j, c] with at most j pieces in room c.
        value, choice = np.zeros(capacity + 1), []
        for _ in range(most):
            best, pick = value.copy(), np.full(capacity + 1, -1)
            for i in np.flatnonzero(prices > 0):
                s = sizes[i]
                offer = value[:capacity + 1 - s] + prices[i]
                better = offer > best[s:] + 1e-12
                best[s:][better], pick[s:][better] = offer[better], i
            choice.append(pick)
            if (pick < 0).all():
                break
            value = best
        if value[capacity] <= 1 + 1e-7:
            break
        column, room = np.zeros(k), capacity
        for pick in reversed(choice):
            if (i := pick[room]) >= 0:
                column[i] += 1
                room -= sizes[i]
        change = np.linalg.solve(basis, column)
        able = change > 1e-9
        if not able.any():
            break
        ratio = np.where(able, use / np.where(able, change, 1), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        use = np.maximum(use - step * change, 0)
        use[out] = step
        basis[:, out] = column
    return [(basis[:, j].astype(int), float(use[j])) for j in range(k)]


def plan(counts: dict[int, int], capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS) -> Packing:
    """Places for so many pieces of each length."""
    packing = Packing(capacity)
    left = {length: n for length, n in sorted(counts.items(), reverse=True) if n}
    if left.get(capacity):
        packing.place(packing.new(left[capacity]), capacity)
        del left[capacity]
    large = [(length, n) for length, n in left.items() if length > small]
    total = sum(n for _, n in large)
    if total:
        # Groups of equal cardinality, longest first; a group holds runs (length, pieces).
        size = -(-total // groups)
        grouped: list[list[list[int]]] = []
        room = 0
        for length, n in large:
            while n:
                if not room:
                    grouped.append([])
                    room = size
                some = min(n, room)
                grouped[-1].append([length, some])
                n, room = n - some, room - some
        # Groups of the same largest length are one size.
        merged: dict[int, list[list[int]]] = {}
        for g in grouped:
            merged.setdefault(g[0][0], []).extend(g)
        sizes, lists = np.array(list(merged)), list(merged.values())
        demand = np.array([sum(n for _, n in g) for g in lists], float)
        for column, use in configurations(sizes, demand, capacity):
            count = int(use + 1e-9)
            slots = [i for i in range(len(sizes)) for _ in range(column[i])]
            while count and slots and all(lists[i] for i in set(slots)):
                # As many equal sequences as the first run of each group's list allows.
                need = {i: slots.count(i) for i in set(slots)}
                same = min(count, *(lists[i][0][1] // need[i] for i in need))
                chosen = []
                if same:
                    for i in slots:
                        chosen.append(lists[i][0][0])
                    for i, times in need.items():
                        lists[i][0][1] -= same * times
                else:  # a run ends inside this sequence
                    same = 1
                    for i in slots:
                        if not lists[i]:
                            continue
                        chosen.append(lists[i][0][0])
                        lists[i][0][1] -= 1
                        if not lists[i][0][1]:
                            lists[i].pop(0)
                for i in need:
                    while lists[i] and not lists[i][0][1]:
                        lists[i].pop(0)
                run = packing.new(same)
                for length in chosen:
                    packing.place(run, length)
                packing.open[run.room].append(run)
                count -= same
        rest: dict[int, int] = defaultdict(int)
        for g in lists:
            for length, n in g:
                rest[length] += n
        for length in sorted(rest, reverse=True):
            packing.best_fit(length, rest[length])
    for length, n in left.items():
        if length <= small:
            packing.best_fit(length, n)
    return packing


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces with doc_id, piece, start and length (and more columns).

    ``pieces`` is read several times and should be stored. Pieces of one length are numbered in
    shares of about ``NUMBERED``, so a length that a third of all pieces have meets in no task.
    """
    spark = pieces.sparkSession
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    packing = plan(histogram, capacity)
    shares = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sum(histogram.values()) // NUMBERED))
    share = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shares))
    salted = pieces.withColumn("_share", share)
    sizes = salted.groupBy("length", "_share").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "_share", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("length", "_share").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (salted.withColumn("_rank", F.row_number().over(inner) - 1).join(starts, ["length", "_share"])
              .withColumn("_rank", F.col("_rank") + F.col("_base")).drop("_share", "_base"))
    places = {length: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for length, rows in packing.places.items()}
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    kept = pieces.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank, length = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_rank", "length"))
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for value in np.unique(length):
                mine = length == value
                first, _, at, place = places[int(value)]
                k = np.searchsorted(first, rank[mine], "right") - 1
                sequence[mine], offset[mine] = at[k] + rank[mine] - first[k], place[k]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)],
                                             [*kept, "sequence_id", "offset"])

    return ranked.mapInArrow(run, schema)


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenize, cut and pack all documents; stores the pieces, a few numbers each, once."""
    return pack(staged(pieces(docs, tokenizer, capacity), "pieces"), capacity)
