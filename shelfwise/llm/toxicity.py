"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Features are hashed: each word (A-Z in lower case, cut at marks) and the first ``STEM`` bytes of
each longer word, present or not. Grades are 0 (clean), 1 (toxic) and 2 (toxic with many
markers). P(grade >= k) = sigmoid(w x - threshold_k) with one w for all thresholds; the severity
is the expected grade, the sum of these probabilities. A document is rejected if P(grade >= 1)
is at least ``REJECT`` (low, since most clean texts have no marker at all).

The model is fitted on at most ``SAMPLE`` labelled documents, drawn by a hash of their ids; the
sample alone reaches the driver, as sorted feature numbers. Only features whose share differs
clearly between the labels are used. Labels say toxic or not; a toxic document gets grade 2 if
it has more different markers than the middle one of all toxic documents of the sample.

Null and empty texts have no features and are clean. Labels with null id or value are left out; an id
that has several counts as toxic if one says so. Of several texts of one id one is drawn. Without toxic labels all documents are clean. Repeated rows are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from shelfwise.llm import textvec, tokens
from shelfwise.llm.quality import _FOLD

SAMPLE = 10_000
BUCKETS = 1 << 24
STEM = 5
GRADES = 3
REJECT = 0.3
#: A feature is used if that many of the documents that have it would be toxic by chance with at most this probability ...
CHANCE = 1e-3
#: ... and its share among toxic documents is so many times that among clean ones.
RATIO = 3.0
ROUNDS = 400
PENALTY = 2e-5


def features(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, distinct and sorted, as two arrays."""
    data, bounds = textvec.packed(texts)
    plain = _FOLD[data]
    found = textvec.words(plain, bounds)
    owner = np.repeat(np.arange(len(texts)), found.counts)
    long = found.ends - found.starts > STEM
    stem = np.full(int(long.sum()), 0x2545F4914F6CDD1D, np.uint64)
    starts = found.starts[long]
    for k in range(STEM):
        stem = (stem ^ plain[starts + k].astype(np.uint64)) * np.uint64(0x100000001B3)
    codes = np.concatenate([found.hashes, textvec.mix(stem)]) % np.uint64(BUCKETS)
    pairs = np.unique((np.concatenate([owner, owner[long]]).astype(np.uint64) << np.uint64(32)) | codes)
    return (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)


@dataclass
class Model:
    used: np.ndarray  # sorted feature numbers
    weights: np.ndarray
    thresholds: np.ndarray  # one below each grade from 1 on

    def probabilities(self, texts: list) -> np.ndarray:
        """P(grade >= k) for k from 1, a row for each text."""
        score = np.zeros(len(texts))
        if len(self.used):
            owner, feature = features(texts)
            at = np.minimum(np.searchsorted(self.used, feature), len(self.used) - 1)
            hit = self.used[at] == feature
            score += np.bincount(owner[hit], self.weights[at[hit]], len(texts))
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))


def without_copies(counts: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Which rows are no near copies of earlier ones, whose rare words would look like markers.

    Row i has the next ``counts[i]`` of the features ``flat``. A copy shares half or more of
    eight MinHash values over its features that few rows have.
    """
    owner = np.repeat(np.arange(len(counts)), counts)
    _, place, times = np.unique(flat, return_inverse=True, return_counts=True)
    rare = times[place] <= max(20, len(counts) // 100)
    owner, flat = owner[rare], flat[rare].astype(np.uint64)
    some, starts = np.unique(owner, return_index=True)
    least: dict[int, list[tuple[int, int]]] = {}
    for k in range(8):
        values = np.minimum.reduceat(textvec.mix(flat + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)), starts) if len(some) else []
        for i, v in zip(some.tolist(), values, strict=True):
            least.setdefault(i, []).append((k, int(v)))
    seen: dict[tuple[int, int], list[int]] = {}
    kept = np.ones(len(counts), bool)
    for i in range(len(counts)):
        marks = least.get(i, [])
        met: dict[int, int] = {}
        for m in marks:
            for j in seen.get(m, ()):
                met[j] = met.get(j, 0) + 1
        kept[i] = max(met.values(), default=0) < 4
        if kept[i]:
            for m in marks:
                seen.setdefault(m, []).append(i)
    return kept


def fit_ordinal(x: np.ndarray, grade: np.ndarray, start_at: np.ndarray, grades: int = GRADES, rounds: int = ROUNDS,
                penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of most likelihood, by full-batch gradient steps (Adam)."""
    n, d = x.shape
    share = [np.clip((grade >= k).mean(), 1e-4, 1 - 1e-4) for k in range(1, grades)]
    # Thresholds are a first one and positive steps, kept as logarithms.
    start = np.log([(1 - s) / s for s in share])
    steps = np.log(np.maximum(np.diff(start), 0.1))
    at = np.concatenate([start_at, start[:1], steps])
    mean, square = np.zeros_like(at), np.zeros_like(at)

    def sigmoid(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))

    rows = np.arange(n)
    for t in range(1, rounds + 1):
        w, gaps = at[:d], np.exp(at[d + 1:])
        cuts = at[d] + np.concatenate([[0], np.cumsum(gaps)])
        above = np.concatenate([np.ones((n, 1)), sigmoid((x @ w)[:, None] - cuts), np.zeros((n, 1))], axis=1)
        slope = above * (1 - above)
        p = np.maximum(above[rows, grade] - above[rows, grade + 1], 1e-9)
        # Of the log likelihood, to the score that each bound sees.
        low, high = slope[rows, grade] / p, slope[rows, grade + 1] / p
        to_cuts = np.zeros(grades - 1)
        for k in range(grades - 1):
            to_cuts[k] = -(low[grade == k + 1].sum() - high[grade == k].sum())
        change = np.concatenate([x.T @ (low - high) / n - penalty * w, [to_cuts.sum() / n],
                                 [to_cuts[k + 1:].sum() / n * gaps[k] for k in range(grades - 2)]])
        mean, square = 0.9 * mean + 0.1 * change, 0.99 * square + 0.01 * change ** 2
        at = at + 0.1 * (mean / (1 - 0.9 ** t)) / (np.sqrt(square / (1 - 0.99 ** t)) + 1e-8)
    return at[:d], at[d] + np.concatenate([[0], np.cumsum(np.exp(at[d + 1:]))])


def train(toxic: np.ndarray, counts: np.ndarray, flat: np.ndarray) -> Model:
    """Model of rows with a label and the next ``counts[i]`` of the features ``flat`` each."""
    kept = without_copies(counts, flat)
    flat = flat[np.repeat(kept, counts)]
    toxic, counts = toxic[kept], counts[kept]
    none = Model(np.zeros(0, np.int64), np.zeros(0), np.full(GRADES - 1, 30.0))
    if not toxic.any() or toxic.all():
        return none
    owner = np.repeat(np.arange(len(toxic)), counts)
    feature, place = np.unique(flat, return_inverse=True)
    a, b = int(toxic.sum()), int((~toxic).sum())
    bad = np.bincount(place[toxic[owner]], minlength=len(feature))
    good = np.bincount(place[~toxic[owner]], minlength=len(feature))
    # Chernoff's bound on the chance that so many of a feature's documents are toxic.
    n, base = bad + good, a / (a + b)
    share = bad / n
    with np.errstate(divide="ignore", invalid="ignore"):
        away = np.where(good > 0, (1 - share) * np.log((1 - share) / (1 - base)), 0) + np.where(bad > 0, share * np.log(share / base), 0)
    clear = (n * away >= -np.log(CHANCE)) & (bad / a >= RATIO * good / b)
    if not clear.any():
        return none
    used = np.flatnonzero(clear)
    column = np.full(len(feature), -1)
    column[used] = np.arange(len(used))
    x = np.zeros((len(toxic), len(used)), np.float32)
    hit = column[place] >= 0
    x[owner[hit], column[place[hit]]] = 1
    # Markers are features that clean documents hardly have.
    marker = (bad[used] / a > 5 * good[used] / b)
    markers = x[:, marker].sum(axis=1)
    grade = np.where(toxic, np.where(markers > np.median(markers[toxic]), 2, 1), 0)
    # From the log odds of each feature alone, so that one marker can be enough.
    alone = np.log((bad[used] + 0.5) / (a + 1)) - np.log((good[used] + 0.5) / (b + 1))
    weights, thresholds = fit_ordinal(x, grade, alone)
    return Model(feature[used].astype(np.int64), weights, thresholds)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Model fitted on at most ``sample`` labelled documents (a documented bound)."""
    drawn = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("_id")).agg((F.max("toxic") > 0).cast("int").alias("_toxic"))
             .orderBy(F.xxhash64("_id"), "_id").limit(sample))
    # One row an id, taken before the texts meet, so the driver gets ``sample`` rows at most.
    texts = (docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
             .join(F.broadcast(drawn), "_id").groupBy("_id", "_toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for begin, end in textvec.pieces(texts):
                owner, feature = features(texts[begin:end])
                ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=end - begin))])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(feature, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin), batch.column(1).slice(begin, end - begin), lists],
                                                 ["id", "toxic", "features"])

    rows = texts.mapInArrow(run, "id long, toxic int, features array<int>").toArrow().sort_by("id")
    lists = rows.column(2).combine_chunks()
    return train(rows.column(1).to_numpy().astype(bool), np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy())


def graded(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs as ``_row`` with severity, p_toxic and rejected; one pass, no shuffle."""
    whole = docs.select(F.struct("*").alias("_row"))
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.release()
        for batch in batches:
            texts = batch.column(0).field(text).to_pylist()
            for begin, end in textvec.pieces(texts):
                p = model.probabilities(texts[begin:end])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin), pa.array(p.sum(axis=1)), pa.array(p[:, 0]),
                     pa.array(p[:, 0] >= REJECT)], ["_row", "severity", "p_toxic", "rejected"])

    return whole.mapInArrow(run, T.StructType([
        whole.schema["_row"], T.StructField("severity", T.DoubleType()), T.StructField("p_toxic", T.DoubleType()),
        T.StructField("rejected", T.BooleanType())]))


def severity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, severity (expected grade, 0 to 2), p_toxic, toxic (rejected) of every document."""
    out = graded(docs.select("doc_id", "text"), fit(docs, labels))
    return out.select(F.col("_row.doc_id").cast("long").alias("doc_id"), "severity", "p_toxic", F.col("rejected").alias("toxic"),
                      (~F.col("rejected")).alias("kept"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected."""
    return graded(docs, fit(docs, labels)).filter(~F.col("rejected")).select("_row.*")
