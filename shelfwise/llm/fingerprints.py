"""Document fingerprints: MinHash signatures of word shingles.

Each of ``PERMUTATIONS`` universal hash functions ``a * x + b`` (a odd, modulo 2^32) permutes
the 32-bit shingle hashes; a signature keeps the smallest value under each. The fingerprint
shows the low 16 bits of every value as hexadecimal digits, and the likeness of two
fingerprints is the share of equal places, which estimates the Jaccard similarity of the
shingle sets. Texts are null-safe (null is empty); an empty text has the fingerprint of all
f, is like another empty text (1.0) and unlike any other (0.0 but for chance).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm import textvec

PERMUTATIONS = 128
SEED = 20_011
SHINGLE_WORDS = 5


def permutations(n: int = PERMUTATIONS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.Generator(np.random.PCG64(seed))
    a = draw.integers(0, 1 << 32, n, np.uint32) | np.uint32(1)
    return a, draw.integers(0, 1 << 32, n, np.uint32)


def signatures(hashes: np.ndarray, counts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One row for each text: the least permuted hash under each function, all ones without shingles."""
    out = np.full((len(counts), len(a)), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(counts)
    if len(some):
        x = (hashes >> np.uint64(32)).astype(np.uint32)
        starts = np.concatenate([[0], np.cumsum(counts[some])[:-1]])
        turned = np.empty_like(x)
        for k in range(len(a)):
            np.multiply(x, a[k], out=turned)
            turned += b[k]
            out[some, k] = np.minimum.reduceat(turned, starts)
    return out


def text_signatures(texts: list, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = []
    for begin, end in textvec.pieces(texts):
        found = textvec.words(*textvec.packed(texts[begin:end]))
        out.append(signatures(*textvec.shingles(found, SHINGLE_WORDS), a, b))
    return np.concatenate(out) if out else np.zeros((0, len(a)), np.uint32)


def shown(signature: np.ndarray) -> np.ndarray:
    """The 16 bits of each place that the fingerprint shows."""
    return signature.astype(">u2")


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return (one == other).mean(axis=1)


def fingerprints(docs: DataFrame, n: int = PERMUTATIONS, seed: int = SEED) -> DataFrame:
    """doc_id and fingerprint of every row; repeated rows are kept."""
    a, b = permutations(n, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = shown(text_signatures(batch.column(1).to_pylist(), a, b))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p.tobytes().hex() for p in prints], pa.string())],
                                             ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows dealt into ranges of doc_id, each range also holding the first row of the next.

    Order is descending doc_id, nulls last, ties by text. The last range is followed by the
    first. Columns: part (range), extra (a row that only serves as somebody's next), doc_id,
    text. Ranges are cut at quantiles of doc_id; only one bound and one id for each reach the
    driver. The texts are shuffled once.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.select("doc_id")
    cuts = sorted(set(ids.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 1 / (4 * parts)))) if parts > 1 else []
    # Nulls and ids below the first cut share range 0.
    part = F.coalesce(F.size(F.filter(F.array(*[F.lit(int(c)) for c in cuts]), lambda c: c <= F.col("doc_id"))), F.lit(0)) \
        if cuts else F.lit(0)
    firsts = sorted(((r.part, r.top) for r in ids.groupBy(part.alias("part")).agg(F.max("doc_id").alias("top")).collect()),
                    reverse=True)
    # The first row of a range goes, as an extra, to the range that comes before it.
    extra = [(top, firsts[i - 1][0]) for i, (_, top) in enumerate(firsts)]
    spread = spark.createDataFrame(extra or [(None, 0)], "top long, before int")
    return (rows.join(F.broadcast(spread), F.col("doc_id").eqNullSafe(F.col("top")), "left")
            .withColumn("to", F.array_compact(F.array(
                F.struct(part.alias("part"), F.lit(False).alias("extra")),
                F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("part"), F.lit(True).alias("extra"))))))
            .select(F.explode("to").alias("to"), "doc_id", "text").select("to.part", "to.extra", "doc_id", "text")
            .repartition(parts, "part")
            .sortWithinPartitions("part", "extra", F.col("doc_id").desc_nulls_last(), "text"))


def edited(text: str, following: str) -> str:
    """The text with its last third (rounded down) replaced by as much of the following text's begin."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def edit_report(docs: DataFrame, n: int = PERMUTATIONS, seed: int = SEED) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Rows with null doc_id come last in the order; repeated rows follow one another. An empty
    table gives no rows, a table of one row follows itself.
    """
    a, b = permutations(n, seed)
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    names = [c.split()[0] for c in schema.split(", ")]

    def report(rows: list[tuple]) -> pa.RecordBatch:
        """Of all rows but the last, which follows the one before it."""
        ids, texts = [i for i, _ in rows[:-1]], [t for _, t in rows]
        changed = [edited(t, s) for t, s in zip(texts, texts[1:])]  # noqa: B905
        coded = [c.encode("utf-8", "surrogatepass") for c in changed]
        own = shown(text_signatures(texts, a, b))
        other = shown(text_signatures(changed, a, b))
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(c).hexdigest() for c in coded], pa.string()),
            pa.array([p.tobytes().hex() for p in own[:-1]], pa.string()), pa.array([p.tobytes().hex() for p in other], pa.string()),
            pa.array(likeness(own[:-1], other), pa.float64()), pa.array(likeness(own[:-1], own[1:]), pa.float64())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, part, ended = 0, None, False
        for batch in batches:
            for p, extra, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if p != part:
                    if len(held) > 1:
                        yield report(held)
                    held, size, part, ended = [], 0, p, False
                if ended:  # ties of the extra row
                    continue
                held.append((doc_id, text))
                size += len(text)
                ended = extra
                if extra or size > 1 << 21:
                    if len(held) > 1:
                        yield report(held)
                    held, size = held[-1:], len(text)
        if len(held) > 1:
            yield report(held)

    return with_next(docs).mapInArrow(run, schema)
