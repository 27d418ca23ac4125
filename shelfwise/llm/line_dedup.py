"""Line deduplication that can be taken back: sharded cuckoo filters over exact reference tables.

The key of a line is the line without white space at both ends and with A-Z in lower case. The
ledger holds one exact reference (key, document) for every document that has a key of at least
``LEAST_CHARS`` characters. A key with ``LEAST_DOCS`` references or more is heavy: its lines go,
but for those in the largest doc_id that holds it. Heavy keys are also in cuckoo filters, one a
shard. A line that its filter does not know is kept without any look at the tables; the others
are checked against the exact table, so a filter's errors change nothing. Inserting documents
adds references, deleting them removes them; keys that cross the bound enter or leave the
filters, which support deletion.

Keys are 128-bit hashes. Null text is one empty line. A null doc_id counts as the least id.
Repeated rows are documents of their own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.session import staged

LEAST_CHARS = 20
LEAST_DOCS = 3
#: White space of keys.
BLANK = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Filters go to the tasks while all together have at most so many bytes; beyond it lines meet the table in a join.
MOST_FILTER_BYTES = 64 << 20
#: Keys of a shard's filter, about.
SHARD_KEYS = 1 << 20
NO_ID = -(1 << 63)


class CuckooFilter:
    """Set of 64-bit hashes with deletion: buckets of four 16-bit fingerprints, each key in one of two buckets."""

    SLOTS = 4
    KICKS = 500

    def __init__(self, table: np.ndarray):
        self.table = table  # uint16 [buckets, SLOTS], 0 is free; the number of buckets is a power of two

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        """Filter of distinct keys, at most three quarters full."""
        buckets = 1
        while buckets * cls.SLOTS * 3 // 4 < max(len(keys), 1):
            buckets *= 2
        while True:
            made = cls(np.zeros((buckets, cls.SLOTS), np.uint16))
            if made.insert(keys):
                return made
            buckets *= 2

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.table) - 1)
        prints = (keys >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        one = keys & mask
        return prints, one, one ^ self._turn(prints)

    def _turn(self, prints: np.ndarray) -> np.ndarray:
        return (prints.astype(np.uint64) * np.uint64(0x5BD1E9955BD1E995) >> np.uint64(17)) & np.uint64(len(self.table) - 1)

    def _put(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Put prints into free slots of their bucket; which ones found none."""
        order = np.argsort(bucket, kind="stable")
        b = bucket[order]
        rank = np.arange(len(b)) - np.searchsorted(b, b)
        free = self.table == 0
        fits = rank < free.sum(axis=1)[b]
        slots = np.argsort(~free[b[fits]], axis=1, kind="stable")
        self.table[b[fits], slots[np.arange(int(fits.sum())), rank[fits]]] = prints[order][fits]
        out = np.zeros(len(b), bool)
        out[order[~fits]] = True
        return out

    def insert(self, keys: np.ndarray) -> bool:
        """False if it is too full; it must be built anew then."""
        prints, one, other = self._places(keys)
        left = self._put(prints, one)
        left[np.flatnonzero(left)[~self._put(prints[left], other[left])]] = False
        for p, bucket in zip(prints[left], other[left], strict=True):
            for kick in range(self.KICKS):
                at = self.table[bucket]
                if (free := np.flatnonzero(at == 0)).size:
                    at[free[0]] = p
                    break
                slot = kick % self.SLOTS
                p, at[slot] = at[slot], p
                bucket = bucket ^ self._turn(np.array([p]))[0]
            else:
                return False
        return True

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, one, other = self._places(keys)
        wanted = prints[:, None]
        return (self.table[one] == wanted).any(axis=1) | (self.table[other] == wanted).any(axis=1)

    def delete(self, keys: np.ndarray) -> None:
        """Remove keys that were inserted."""
        for p, *buckets in zip(*self._places(keys), strict=True):
            for bucket in buckets:
                if (at := np.flatnonzero(self.table[bucket] == p)).size:
                    self.table[bucket, at[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    @classmethod
    def from_bytes(cls, coded: bytes) -> CuckooFilter:
        return cls(np.frombuffer(coded, "<u2").reshape(-1, cls.SLOTS).copy())


def line_key(line: str) -> str:
    return line.strip(BLANK).translate(LOWER)


def key_hashes(lines: list[str]) -> list[bytes | None]:
    """Hash of each line's key, None for keys that are too short to count."""
    keys = map(line_key, lines)
    return [xxhash.xxh3_128_digest(k.encode("utf-8", "surrogatepass")) if len(k) >= LEAST_CHARS else None for k in keys]


def _row_key() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"),
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text_hash")]


def references(docs: DataFrame, screen: dict[int, bytes] | None = None, shards: int = 1) -> DataFrame:
    """key, _id, _text_hash for every row and each distinct counted key in it.

    With ``screen`` (filters by shard) only keys that a filter knows come out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(screen) if screen is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {s: CuckooFilter.from_bytes(f) for s, f in sent.value.items()} if sent else None
        for batch in batches:
            for begin in range(0, len(batch), 256):
                part = batch.slice(begin, 256)
                keys, owner = [], []
                for i, text in enumerate(part.column(2).to_pylist()):
                    own = {k for k in key_hashes((text or "").split("\n")) if k}
                    keys.extend(own)
                    owner.extend([i] * len(own))
                if filters is not None and keys:
                    low = np.frombuffer(b"".join(keys), ">u8").reshape(-1, 2).astype(np.uint64)
                    shard, known = (low[:, 0] % np.uint64(shards)).astype(int), np.zeros(len(keys), bool)
                    for s in np.unique(shard):
                        if (f := filters.get(int(s))) is not None:
                            known[shard == s] = f.contains(low[shard == s, 1])
                    keys, owner = [keys[i] for i in np.flatnonzero(known)], [owner[i] for i in np.flatnonzero(known)]
                at = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), part.column(0).take(at), part.column(1).take(at)],
                                                 ["key", "_id", "_text_hash"])

    return docs.select(*_row_key(), "text").mapInArrow(run, "key binary, _id long, _text_hash long")


def _shard(key: bytes, shards: int) -> int:
    return int.from_bytes(key[:8], "big") % shards


@dataclass
class LineIndex:
    """The stored state. ``filters`` has (shard, filter); ``heavy`` (key, refs, last); ``ledger`` (key, _id)."""

    ledger: DataFrame
    heavy: DataFrame
    filters: DataFrame
    shards: int


def _heavy(ledger: DataFrame) -> DataFrame:
    """Counted before the shuffle, so a line of a third of all documents is one row a task."""
    return (ledger.groupBy("key").agg(F.count(F.lit(1)).alias("refs"), F.max("_id").alias("last"))
            .filter(F.col("refs") >= LEAST_DOCS))


def _with_shard(keys: DataFrame, shards: int) -> DataFrame:
    """The shard of a key from its first 8 bytes, as unsigned number; -1 stands for none."""
    high = F.conv(F.substring(F.hex("key"), 1, 16), 16, 10).cast("decimal(20,0)")
    return keys.withColumn("shard", (high % F.lit(shards)).cast("int"))


def _low(keys: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(keys), ">u8").reshape(-1, 2)[:, 1].astype(np.uint64)


def build(docs: DataFrame) -> LineIndex:
    """Index of all documents."""
    ledger = staged(references(docs).select("key", "_id"), "line-ledger")
    heavy = staged(_heavy(ledger), "line-heavy")
    shards = max(1, -(-heavy.count() // SHARD_KEYS))

    def make(keys: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": keys["shard"][:1], "filter": [CuckooFilter.of(_low(keys["key"])).to_bytes()]})

    filters = staged(_with_shard(heavy.select("key"), shards).groupBy("shard").applyInPandas(make, "shard int, filter binary"),
                     "line-filters")
    return LineIndex(ledger, heavy, filters, shards)


def _changed(index: LineIndex, ledger: DataFrame, touched: DataFrame) -> LineIndex:
    """The index after the references of the ``touched`` keys changed: only their counts are taken anew."""
    ledger = staged(ledger, "line-ledger")
    recount = staged(_heavy(ledger.join(touched, "key", "left_semi")), "line-recount")
    heavy = staged(index.heavy.join(touched, "key", "left_anti").unionByName(recount), "line-heavy")
    was = index.heavy.select("key")
    moves = (heavy.select("key").join(was, "key", "left_anti").withColumn("come", F.lit(True))
             .unionByName(was.join(heavy, "key", "left_anti").withColumn("come", F.lit(False))))

    def move(keys: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        shard = keys["shard"].iloc[0] if len(keys) else filters["shard"].iloc[0]
        own = CuckooFilter.from_bytes(filters["filter"].iloc[0]) if len(filters) else CuckooFilter.of(np.zeros(0, np.uint64))
        come = keys["come"].astype(bool)
        own.delete(_low(keys["key"][~come]))
        # A filter that is too full is told apart by an empty value and built anew below.
        return pd.DataFrame({"shard": [shard], "filter": [own.to_bytes() if own.insert(_low(keys["key"][come])) else b""]})

    filters = staged(_with_shard(moves, index.shards).groupBy("shard").cogroup(index.filters.groupBy("shard"))
                     .applyInPandas(move, "shard int, filter binary"), "line-filters")
    full = filters.filter(F.length("filter") == 0).select("shard")

    def make(keys: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": keys["shard"][:1], "filter": [CuckooFilter.of(_low(keys["key"])).to_bytes()]})

    anew = (_with_shard(heavy.select("key"), index.shards).join(full, "shard", "left_semi").groupBy("shard")
            .applyInPandas(make, "shard int, filter binary"))
    return LineIndex(ledger, heavy, staged(filters.filter(F.length("filter") > 0).unionByName(anew), "line-filters"), index.shards)


def insert(index: LineIndex, docs: DataFrame) -> LineIndex:
    """The index with more documents."""
    new = staged(references(docs).select("key", "_id"), "line-new")
    return _changed(index, index.ledger.unionByName(new), new.select("key").distinct())


def delete(index: LineIndex, docs: DataFrame) -> LineIndex:
    """The index without documents that were inserted before; a repeated row is taken off once for each time given."""
    gone = staged(references(docs).select("key", "_id"), "line-gone")
    left = (index.ledger.withColumn("n", F.lit(1)).unionByName(gone.withColumn("n", F.lit(-1)))
            .groupBy("key", "_id").agg(F.sum("n").alias("n")).filter("n > 0")
            .select("key", "_id", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("key", "_id"))
    return _changed(index, left, gone.select("key").distinct())


def drops(docs: DataFrame, index: LineIndex) -> DataFrame:
    """_id, _text_hash, gone (key hashes to drop) of the documents that lose lines."""
    size = index.filters.agg(F.sum(F.length("filter"))).first()[0] or 0
    screen = {r.shard: bytes(r.filter) for r in index.filters.collect()} if size <= MOST_FILTER_BYTES else None
    met = references(docs, screen, index.shards)
    return (met.join(index.heavy.select("key", "last"), "key").filter(F.col("_id") != F.col("last"))
            .groupBy("_id", "_text_hash").agg(F.collect_set("key").alias("gone")))


def without_lines(text: str, gone: set[bytes]) -> tuple[str, int, int]:
    """The text without its lines of these keys; lines before, lines dropped."""
    lines = text.split("\n")
    if not gone:
        return text, len(lines), 0
    kept = [line for line, key in zip(lines, key_hashes(lines), strict=True) if key not in gone]
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def _deduplicated(docs: DataFrame, index: LineIndex) -> DataFrame:
    """Rows of docs as ``_row`` with ``_text``, ``_kept``, n_lines and n_dropped. The text is shuffled once."""
    whole = docs.select(*_row_key(), F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    joined = whole.join(drops(docs, index), ["_id", "_text_hash"], "left").select(
        "_row", F.col("_row.text").alias("_text"), "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [without_lines(t or "", set(g or ())) for t, g in
                   zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            kept, lines, dropped = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string()), pa.array(lines, pa.int64()),
                                              pa.array(dropped, pa.int64())], ["_row", "_kept", "n_lines", "n_dropped"])

    row = joined.schema["_row"].dataType.simpleString()
    return joined.mapInArrow(run, f"_row {row}, _kept string, n_lines long, n_dropped long")


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document, deduplicated against all of them."""
    out = _deduplicated(docs.select("doc_id", "text"), build(docs))
    return out.select(F.col("_row.doc_id").cast("long").alias("doc_id"), "n_lines", "n_dropped",
                      F.sha2(F.col("_kept").cast("binary"), 256).alias("kept_sha256"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The columns of ``docs``: texts without repeated lines, n_chars (if there) of the new text."""
    out = _deduplicated(docs, build(docs))
    changed = {"text": F.when(F.col("n_dropped") > 0, F.col("_kept")).otherwise(F.col("_row.text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("n_dropped") > 0, F.length("_kept").cast(kind)).otherwise(F.col("_row.n_chars"))
    return out.select(*[changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
