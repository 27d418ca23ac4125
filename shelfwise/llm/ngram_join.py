"""Similarity join of documents on their sets of five-word shingles, by MinHash banding.

Rows of one band are chosen so that a pair at the threshold meets in some band with at least
``RECALL`` probability. Documents with equal shingle sets are one set from the start, however
many there are. Sets that share a band hash are tied to the least set of the bucket only;
connected buckets form candidate groups, and inside a candidate group all pairs that sizes allow
are compared on their full shingle sets. Sets of a group are dealt by size to levels so that a
pair at the threshold is in one level or in two next to each other, and a level's sets to blocks
of about ``BLOCK`` sets and ``BLOCK_BYTES`` of shingles, of which a task holds two. So no
pair that shares any bucket, directly or through others, is lost, no bucket is cut, and no row
is made for a pair: a block returns for each set the number of its links and one tie. A set is
sent once for each block of its own and the two neighbouring levels.

Similarity is the Jaccard similarity of shingle sets. A text with fewer than five words has one
shingle of all its words. Texts without words (null, empty, blank) have equal (empty) sets and
are one class; they are like nothing else. Null doc_ids are allowed; a class of null ids only
has a null class_id. Repeated rows are documents of their own. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm import fingerprints, textvec
from shelfwise.llm.components import components
from shelfwise.session import staged

PERMUTATIONS = 256
THRESHOLD = (4, 5)  # as a fraction
RECALL = 0.99
#: Sets and bytes of shingles of a block, about; tiles of TILE sets are compared at a time.
BLOCK, BLOCK_BYTES, TILE = 2048, 4 << 20, 512
SEED = 2
#: Columns of a block's shingle table that are held at a time.
WIDTH = 4096


def band_rows(permutations: int = PERMUTATIONS, threshold: float = THRESHOLD[0] / THRESHOLD[1], recall: float = RECALL) -> int:
    """The most rows a band may have while a pair at the threshold is still met with the recall."""
    fit = [r for r in range(1, permutations + 1) if 1 - (1 - threshold ** r) ** (permutations // r) >= recall]
    return max(fit, default=1)


def shingle_sets(texts: list) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text; also all shingles and their counts."""
    found = textvec.words(*textvec.packed(texts))
    hashes, counts = textvec.shingles(found)
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    sizes = np.bincount(o[first], minlength=len(counts)) if len(o) else np.zeros(len(counts), int)
    return np.split(h[first], np.cumsum(sizes)[:-1]) if len(ends) else [], hashes, counts


def set_keys(sets: list[np.ndarray]) -> list[bytes]:
    """128 bits that stand for a set, from two sums of mixed members and its size."""
    if not sets:
        return []
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    out = np.zeros((len(sets), 2), np.uint64)
    some = np.flatnonzero(sizes)
    starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
    for k, salt in enumerate((0x51ED270B0B4C1D3B, 0xB492B66FBE98F273)):
        if len(some):
            out[some, k] = np.add.reduceat(textvec.mix(flat ^ np.uint64(salt)), starts)
    out[:, 0] = textvec.mix(out[:, 0] + sizes.astype(np.uint64))
    return [row.tobytes() for row in out.astype(">u8")]


def _row_key() -> list[Column]:
    """Tells rows apart but for repeated ones: the id (null: least number) and a hash of the text."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_id"),
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text_hash")]


def banded(docs: DataFrame, permutations: int = PERMUTATIONS, rows: int | None = None, seed: int = SEED) -> DataFrame:
    """_id, _text_hash, set (its key), n (its size), bands of every row."""
    rows = rows or band_rows(permutations)
    a, b = fingerprints.permutations(permutations, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for begin, end in textvec.pieces(texts):
                sets, hashes, counts = shingle_sets(texts[begin:end])
                values = fingerprints.signatures(hashes, counts, a, b)[:, :permutations // rows * rows]
                values = values.reshape(len(sets), -1, rows).astype(np.uint64)
                bands = np.arange(1, values.shape[1] + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
                bands = np.repeat(bands, len(sets), axis=0)
                for k in range(rows):
                    bands = textvec.mix(bands ^ values[:, :, k])
                shown = [x if n else [] for x, n in zip(bands.view(np.int64).tolist(), counts.tolist(), strict=True)]
                part = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(set_keys(sets), pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array(shown, pa.list_(pa.int64()))],
                    ["_id", "_text_hash", "set", "n", "bands"])

    return docs.select(*_row_key(), "text").mapInArrow(
        run, "_id long, _text_hash long, set binary, n long, bands array<long>")


def compare(one: list[np.ndarray], other: list[np.ndarray] | None, threshold: tuple[int, int] = THRESHOLD) -> np.ndarray:
    """Which sets of two lists (or of one list among themselves) are linked."""
    alone = other is None
    other = one if alone else other
    both = one if alone else one + other
    sizes = np.array([len(s) for s in both])
    flat, owner = np.concatenate(both), np.repeat(np.arange(len(both)), sizes)
    _, place, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[place] > 1
    owner, place = owner[shared], place[shared]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], np.cumsum(np.diff(place[order], prepend=-1) != 0) - 1
    n = len(one)
    common = np.zeros((n, len(other)), np.float32)
    for begin in range(0, int(place[-1]) + 1 if len(place) else 0, WIDTH):
        lo, hi = np.searchsorted(place, [begin, begin + WIDTH])
        table = np.zeros((len(both), WIDTH), np.float32)
        table[owner[lo:hi], place[lo:hi] - begin] = 1
        common += table[:n] @ (table if alone else table[n:]).T
    a, b = sizes[:n, None], (sizes if alone else sizes[n:])[None, :]
    common = common.astype(np.int64)
    up, down = threshold
    linked = common * down >= (a + b - common) * up
    if alone:
        np.fill_diagonal(linked, False)
    return linked


def local_roots(linked: np.ndarray, names: list[bytes]) -> list[int]:
    """For each node of a small graph, the least-named node that it is connected with."""
    root = [-1] * len(names)
    for start in sorted(range(len(names)), key=names.__getitem__):
        if root[start] < 0:
            root[start], todo = start, [start]
            while todo:
                for y in np.flatnonzero(linked[todo.pop()]).tolist():
                    if root[y] < 0:
                        root[y] = start
                        todo.append(y)
    return root


def tiles(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Cuts of a list of sets, at most ``TILE`` sets and about ``BLOCK_BYTES`` each."""
    out, begin, size = [], 0, 0
    for i, one in enumerate(sets):
        if i > begin and (i - begin == TILE or size + one.nbytes > BLOCK_BYTES):
            out.append((begin, i))
            begin, size = i, 0
        size += one.nbytes
    return [*out, (begin, len(sets))] if sets else out


def links_of(sets: list[np.ndarray], docs: np.ndarray, n_left: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of the sets are linked, the number of links of each, and of documents linked.

    All sets among themselves, or with ``n_left`` the first so many with the others only.
    """
    linked = np.zeros((len(sets), len(sets)), bool)
    alone = n_left is None
    left = tiles(sets if alone else sets[:n_left])
    right = left if alone else [(a + n_left, b + n_left) for a, b in tiles(sets[n_left:])]
    for a, b in left:
        for c, d in right:
            if alone and c < a:
                continue
            met = compare(sets[a:b], None if alone and a == c else sets[c:d])
            linked[a:b, c:d] = met
            linked[c:d, a:b] = met.T
    weighed = np.zeros(len(sets), np.int64)
    for a in range(0, len(sets), TILE):
        weighed[a:a + TILE] = np.where(linked[a:a + TILE], docs[None, :], 0).sum(axis=1)
    return linked, linked.sum(axis=1), weighed


def levels(size: Column, threshold: tuple[int, int] = THRESHOLD) -> Column:
    """Level of a set by its size; sizes of a linked pair differ by one level at most.

    The larger of two linked sets has at most 1 / threshold as many members. Levels are wider
    than that by a share that is far above the error of the logarithm.
    """
    return F.floor(F.log(size) / F.lit(np.log(threshold[1] / threshold[0] * 1.0001))).cast("int")


def dealt(groups: DataFrame, block: int, block_bytes: int) -> DataFrame:
    """The rows of ``groups`` once for every pair of blocks that they belong to (_low, _a, _high, _b: levels and blocks).

    A candidate group that fits one block is one level.
    """
    sized = groups.withColumn("_level", levels(F.length("shingles") / 8))
    parts = sized.groupBy("component", "_level").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("shingles").cast("long")).alias("bytes"))

    def blocks(n: Column, size: Column) -> Column:
        return F.greatest(F.ceil(n / block), F.ceil(size / block_bytes), F.lit(1)).cast("int")

    # A component has as many levels as there are powers up to its longest text: few.
    directory = parts.groupBy("component").agg(
        blocks(F.sum("n"), F.sum("bytes")).alias("_whole"),
        F.map_from_entries(F.collect_list(F.struct("_level", blocks(F.col("n"), F.col("bytes")).alias("k")))).alias("_ks"))
    known = (sized.join(directory, "component")
             .withColumn("_level", F.when(F.col("_whole") == 1, 0).otherwise(F.col("_level")))
             .withColumn("_ks", F.when(F.col("_whole") == 1, F.create_map(F.lit(0), F.lit(1))).otherwise(F.col("_ks"))))

    def count(level: Column) -> Column:
        return F.coalesce(F.try_element_at("_ks", level), F.lit(0))

    def each(n: Column, made) -> Column:
        return F.transform(F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda j: j < n), made)

    def pair(low, a, high, b) -> Column:
        return F.struct(low.alias("_low"), a.alias("_a"), high.alias("_high"), b.alias("_b"))

    level, own = F.col("_level"), F.col("_own")
    pairs = F.concat(
        each(count(level), lambda j: pair(level, F.least(own, j), level, F.greatest(own, j))),
        each(count(level + 1), lambda j: pair(level, own, level + 1, j)),
        each(count(level - 1), lambda j: pair(level - 1, j, level, own)))
    return (known.withColumn("_own", F.pmod(F.xxhash64("set"), count(level)).cast("int"))
            .withColumn("_pair", F.explode(pairs))
            .select("component", "_pair.*", ((F.col("_pair._low") == level) & (F.col("_pair._a") == own)).alias("_left"),
                    "set", "docs", "shingles"))


def verified(groups: DataFrame, block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """set, text_links, links, root: links of every set inside its candidate group, by block pairs.

    ``groups``: component, set, docs (rows that have it), shingles (their hashes as bytes).
    """
    schema = "set binary, text_links long, links long, root binary"
    key_columns = ["component", "_low", "_a", "_high", "_b"]

    def solve(rows: list[dict]) -> list[tuple]:
        alone = (rows[0]["_low"], rows[0]["_a"]) == (rows[0]["_high"], rows[0]["_b"])
        rows.sort(key=lambda r: not r["_left"])
        names = [r["set"] for r in rows]
        sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
        linked, n, weighed = links_of(sets, np.array([r["docs"] for r in rows]),
                                      None if alone else sum(r["_left"] for r in rows))
        roots = local_roots(linked, names)
        return list(zip(names, n.tolist(), weighed.tolist(), [names[r] for r in roots], strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, out = [], None, []

        def made() -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                              ["set", "text_links", "links", "root"])

        for batch in batches:
            for r in batch.to_pylist():
                if (now := tuple(r[c] for c in key_columns)) != key:
                    if held:
                        out.extend(solve(held))
                    held, key = [], now
                    if len(out) > 5000:
                        yield made()
                        out = []
                held.append(r)
        if held:
            out.extend(solve(held))
        if out:
            yield made()

    return (dealt(groups, block, block_bytes).repartition(*key_columns).sortWithinPartitions(*key_columns)
            .mapInArrow(run, schema))


NO_ID = -(1 << 63)


def linked_sets(docs: DataFrame, bands: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` (_id, _text_hash, set), and every set: class (its least set), text_links, links,
    copies, least_id (without null ids) and row, its first row.

    links counts all other documents at or above the threshold, equal sets included; text_links
    counts other shingle sets. ``bands`` is the frame of ``banded`` for other signatures than the default ones.
    """
    light = staged(banded(docs) if bands is None else bands, "banded")
    sets = staged(light.groupBy("set").agg(
        F.first("bands").alias("bands"), F.count(F.lit(1)).alias("docs"), F.min(F.struct("_id", "_text_hash")).alias("row"),
        F.min(F.when(F.col("_id") != NO_ID, F.col("_id"))).alias("least_id")), "sets")
    buckets = sets.select("set", F.explode("bands").alias("bucket"))
    hubs = (buckets.groupBy("bucket").agg(F.min("set").alias("v"), F.max("set").alias("_max"))
            .filter(F.col("v") != F.col("_max")).select("bucket", "v"))
    edges = buckets.join(hubs, "bucket").select(F.col("set").alias("u"), "v").filter("u <> v").distinct()
    candidates = components(edges)
    wanted = (candidates.select(F.col("node").alias("set"), "component").join(sets.select("set", "docs", "row"), "set")
              .select("component", "set", "docs", "row._id", "row._text_hash"))
    texts = docs.select(*_row_key(), "text").join(wanted, ["_id", "_text_hash"]).dropDuplicates(["_id", "_text_hash"])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3).to_pylist()
            for begin, end in textvec.pieces(texts):
                found, _, _ = shingle_sets(texts[begin:end])
                part = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2),
                                                  pa.array([s.tobytes() for s in found], pa.binary())],
                                                 ["component", "set", "docs", "shingles"])

    groups = staged(texts.select("component", "set", "docs", "text").mapInArrow(
        extract, "component binary, set binary, docs long, shingles binary"), "candidate-sets")
    found = staged(verified(groups), "verified")
    ties = components(found.select(F.col("set").alias("u"), F.col("root").alias("v")))
    links = (found.groupBy("set").agg(F.sum("text_links").alias("text_links"), F.sum("links").alias("links"))
             .join(ties.select(F.col("node").alias("set"), F.col("component").alias("class")), "set", "left"))
    per_set = sets.select("set", "docs", "row", "least_id").join(links, "set", "left").select(
        "set", F.coalesce("class", "set").alias("class"), F.coalesce("text_links", F.lit(0)).alias("text_links"),
        (F.coalesce("links", F.lit(0)) + F.col("docs") - 1).alias("links"), F.col("docs").alias("copies"), "least_id", "row")
    # Stored, so that the join with the rows is of two plain tables and a set of many copies can be split.
    return light.select("_id", "_text_hash", "set"), staged(per_set, "linked-sets")


def classes(docs: DataFrame, bands: DataFrame | None = None) -> DataFrame:
    """doc_id, class_id (least doc_id of the class), n_links, n_text_links, n_copies of every document."""
    rows, sets = linked_sets(docs, bands)
    least = sets.groupBy("class").agg(F.min("least_id").alias("class_id"))
    known = staged(sets.join(least, "class").select("set", "class_id", "links", "text_links", "copies"), "set-classes")
    return rows.join(known, "set").select(
        F.when(F.col("_id") != NO_ID, F.col("_id")).alias("doc_id"), "class_id", F.col("links").alias("n_links"),
        F.col("text_links").alias("n_text_links"), F.col("copies").alias("n_copies"))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The columns of ``docs``; of each class the row with the least doc_id (null first), ties by text hash, stays."""
    _, sets = linked_sets(docs)
    keep = sets.groupBy("class").agg(F.min("row").alias("row")).select("row._id", "row._text_hash")
    whole = docs.select(*_row_key(), F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    return whole.join(keep, ["_id", "_text_hash"]).dropDuplicates(["_id", "_text_hash"]).select("_row.*")
