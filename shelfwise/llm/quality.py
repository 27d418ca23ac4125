"""Quality rules: fixed base rules, then distance from the language's usual distributions.

A document's histograms of character classes and of common words are compared with those of all
documents of its language by Jensen-Shannon distance (base 2, between 0 and 1). The references
are counted over all documents that pass the base rules and have at most one symbol in
``REFERENCE_SYMBOLS`` characters, so junk does not shift them; a language's common words are the ``COMMON`` most frequent of
its words of at most ``SHORT`` bytes (A-Z in lower case, cut at anything but letters, digits and
non-ASCII bytes). A test applies only to texts of a least length, since short texts are far from
any reference by chance alone.

Null text has no words. A null language is a language of its own. Repeated rows are documents of
their own. An empty table gives no rows. The driver sees some hundred numbers for each language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.llm import textvec

COMMON = 64
SHORT = 6
LEAST_WORDS = 50
#: The tests of distributions need so many words and characters. A text without any common word is about
#: 0.46 away from its language, which WORD_BOUND reaches at 78 words; the test could reject nothing shorter.
GUARD_WORDS = 78
GUARD_CHARS = 200
#: Largest distances: a part that holds at any length, and one that falls with the root of the count, as chance does.
CHAR_BOUND = (0.14, 1.5)
WORD_BOUND = (0.12, 3.0)

REFERENCE_SYMBOLS = 100

CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "other", "beyond ASCII", "inner")
_CLASS = np.full(256, 6, np.uint8)
_CLASS[ord("a"):ord("z") + 1] = 0
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[textvec.SPACE] = 3
_CLASS[list(b".,;:!?'\"()-")] = 4
_CLASS[list(b"#*$%&|<>")] = 5
_CLASS[0xC0:] = 7
_CLASS[0x80:0xC0] = 8  # inner bytes of a character, never counted
_SYMBOL = 5
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32
_FOLD[np.isin(_CLASS, [3, 4, 5, 6])] = 0x20


@dataclass
class Measures:
    n_words: np.ndarray
    word_chars: np.ndarray
    n_repeat_words: np.ndarray
    classes: np.ndarray  # a row of character counts for each text
    short: np.ndarray  # codes of the short folded words
    owner: np.ndarray  # their texts
    folded: np.ndarray  # folded words of each text, long ones included

    @property
    def n_symbols(self) -> np.ndarray:
        return self.classes[:, _SYMBOL]


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[bounds])


def repeated_words(found: textvec.Words) -> np.ndarray:
    """Words of each text inside a three-word window that the text has twice or more."""
    n = len(found.counts)
    if len(found.hashes) < 3:
        return np.zeros(n, np.int64)
    owner = np.repeat(np.arange(n), found.counts)
    h = found.hashes
    window = textvec.mix(h[:-2] + textvec.mix(h[1:-1] + textvec.mix(h[2:] + owner[2:].astype(np.uint64))))
    inside = np.flatnonzero(owner[:-2] == owner[2:])
    _, place, times = np.unique(window[inside], return_inverse=True, return_counts=True)
    at = inside[times[place] > 1]
    covered = np.zeros(len(h), bool)
    for k in range(3):
        covered[at + k] = True
    return _sums(covered, found.first)


def measure(texts: list) -> Measures:
    data, bounds = textvec.packed(texts)
    found = textvec.words(data, bounds)
    kind = _CLASS[data]
    classes = np.stack([_sums(kind == k, bounds) for k in range(len(CLASSES) - 1)], axis=1)
    word_chars = _sums((kind != 3) & (kind != 8), bounds)
    plain = _FOLD[data]
    folded = textvec.words(plain, bounds, hashed=False)
    length = folded.ends - folded.starts
    few = length <= SHORT
    starts, length = folded.starts[few], length[few]
    code = length.astype(np.uint64) << np.uint64(56)
    for k in range(SHORT):
        has = length > k
        code[has] |= plain[starts[has] + k].astype(np.uint64) << np.uint64(8 * k)
    owner = np.repeat(np.arange(len(texts)), folded.counts)[few]
    return Measures(found.counts, word_chars, repeated_words(found), classes, code.view(np.int64), owner, folded.counts)


def repeated_lines(text: str | None) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [line for line in (text or "").split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def base_failed(m: Measures) -> np.ndarray:
    return (m.n_words < LEAST_WORDS) | (100 * m.n_repeat_words > 50 * m.n_words)


def references(docs: DataFrame, common: int = COMMON) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By language: share of each character class, codes of the common words (sorted), their shares and that of the rest.

    Counted over all documents; each batch sends one row for each language and word.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                mine = [t for t, own in zip(texts, langs, strict=True) if own == lang]
                classes, words, codes, times = np.zeros(len(CLASSES) - 1, np.int64), 0, [], []
                for begin, end in textvec.pieces(mine):
                    m = measure(mine[begin:end])
                    good = ~base_failed(m) & (REFERENCE_SYMBOLS * m.n_symbols <= m.classes.sum(axis=1))
                    m.classes, m.folded, m.short = m.classes[good], m.folded[good], m.short[good[m.owner]]
                    classes += m.classes.sum(axis=0)
                    words += int(m.folded.sum())
                    c, n = np.unique(m.short, return_counts=True)
                    codes.append(c)
                    times.append(n)
                code = np.concatenate([np.arange(len(classes)), [0], *codes])
                n = np.concatenate([classes, [words], *times])
                kind = np.concatenate([np.zeros(len(classes), int), [1], np.full(len(code) - len(classes) - 1, 2)])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(kind, pa.int32()),
                                                  pa.array(code, pa.int64()), pa.array(n, pa.int64())], ["lang", "kind", "code", "n"])

    counts = (docs.select(language().alias("lang"), "text")
              .mapInArrow(run, "lang string, kind int, code long, n long").groupBy("lang", "kind", "code").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "code")
    kept = counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= common).collect()
    out = {}
    for lang in {r.lang for r in kept}:
        rows = [r for r in kept if r.lang == lang]
        classes = np.zeros(len(CLASSES) - 1)
        for r in rows:
            if r.kind == 0:
                classes[r.code] = r.n
        words = sorted((r.code, r.n) for r in rows if r.kind == 2)
        total = max(1, sum(r.n for r in rows if r.kind == 1))
        shares = np.array([n for _, n in words], float) / total
        out[lang] = (classes / max(1.0, classes.sum()), np.array([c for c, _ in words], np.int64),
                     np.append(shares, max(0.0, 1 - shares.sum())))
    return out


def language() -> Column:
    """The language as a key that is never null; null is a language of its own, other than the empty one."""
    return F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))


def js_distance(counts: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Distance of each row of counts from one distribution; 0 for rows without counts."""
    total = counts.sum(axis=1, keepdims=True)
    p = counts / np.maximum(total, 1)
    m = (p + share) / 2

    def part(x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / m), 0).sum(axis=1)

    distance = np.sqrt(np.clip((part(p) + part(np.broadcast_to(share, p.shape))) / 2, 0, 1))
    return np.where(total[:, 0] > 0, distance, 0.0)


def distances(m: Measures, langs: list[str], known: dict) -> tuple[np.ndarray, np.ndarray]:
    """Distances of each text's character classes and common words from its language."""
    chars, words = np.zeros(len(langs)), np.zeros(len(langs))
    named = np.array(langs, object)
    for lang in set(langs):
        classes, codes, shares = known[lang]
        mine = np.flatnonzero(named == lang)
        chars[mine] = js_distance(m.classes[mine], classes)
        counts = np.zeros((len(langs), len(codes) + 1))
        if len(codes):
            at = np.minimum(np.searchsorted(codes, m.short), len(codes) - 1)
            hit = codes[at] == m.short
            np.add.at(counts, (m.owner[hit], at[hit]), 1)
        counts[:, -1] = m.folded - counts.sum(axis=1)
        words[mine] = js_distance(counts[mine], shares)
    return chars, words


def too_far(distance: np.ndarray, n: np.ndarray, least: int, bound: tuple[float, float]) -> np.ndarray:
    """Whether texts of n characters or words, least or more, are beyond the bound for their length."""
    return (n >= least) & (distance > bound[0] + bound[1] / np.sqrt(np.maximum(n, 1)))


def quality(docs: DataFrame, char_bound: tuple = CHAR_BOUND, word_bound: tuple = WORD_BOUND) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, char_distance, word_distance."""
    known = references(docs)
    schema = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
              "base_failed boolean, kept boolean, char_distance double, word_distance double")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for begin, end in textvec.pieces(texts):
                some = texts[begin:end]
                m = measure(some)
                chars, words = distances(m, langs[begin:end], known)
                failed = base_failed(m)
                far = too_far(chars, m.classes.sum(axis=1), GUARD_CHARS, char_bound)
                far |= too_far(words, m.folded, GUARD_WORDS, word_bound)
                lines = np.array([repeated_lines(t) for t in some], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin), *(pa.array(x) for x in (
                        m.n_words.astype(np.int64), m.word_chars, m.n_symbols, lines, m.n_repeat_words, failed, ~failed & ~far,
                        chars, words))], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), language().alias("lang"),
                       "text").mapInArrow(run, schema)
