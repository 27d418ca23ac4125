"""Words, shingles and their 64-bit hashes for whole batches of texts, in vectorised numpy.

A word is a maximal run of bytes outside space, tab, newline, vertical tab, form feed and
carriage return. Texts are handled as UTF-8; those six bytes occur in no longer character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes are hashed this many at a time, cut at white space, so that long texts stay cheap in memory.
CHUNK = 1 << 20
# Fixed odd multipliers.
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEPS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                   0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9FB21C651E98DF25], np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    kept = _POWERS.get(base)
    if kept is None or len(kept) < n:
        kept = _powers(base, max(n, CHUNK + 4096))
        if n <= 4 * CHUNK:
            _POWERS[base] = kept
    return kept[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each 64-bit value over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def packed(texts: pa.Array | list) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the n + 1 bounds of the texts; null is empty."""
    if isinstance(texts, list):
        coded = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        bounds = np.zeros(len(coded) + 1, np.int64)
        np.cumsum([len(c) for c in coded], out=bounds[1:])
        return np.frombuffer(b"".join(coded), np.uint8), bounds
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if offsets else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[bounds[0]:bounds[-1]], bounds - bounds[0]


def _cuts(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of about CHUNK bytes that end before white space."""
    begin = 0
    while begin < len(data):
        end = min(begin + CHUNK, len(data))
        while end < len(data):
            window = SPACE[data[end:end + CHUNK]]
            if (at := int(window.argmax())) or window[0]:
                end += at
                break
            end = min(end + CHUNK, len(data))
        yield begin, end
        begin = end


@dataclass
class Words:
    starts: np.ndarray  # of each word in the bytes
    ends: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray  # words of each text

    @property
    def first(self) -> np.ndarray:
        """Index of each text's first word, with the total at the end."""
        return np.concatenate([[0], np.cumsum(self.counts)])


def words(data: np.ndarray, bounds: np.ndarray, hashed: bool = True) -> Words:
    """All words of the texts, which never run over the end of a text."""
    inner = bounds[1:-1]
    starts, ends, hashes = [], [], []
    for begin, end in _cuts(data):
        part = data[begin:end]
        blank = SPACE[part]
        opens = ~blank
        opens[1:] &= blank[:-1]
        closes = ~blank
        closes[:-1] &= blank[1:]
        cut = inner[(inner >= begin) & (inner < end)] - begin
        if begin and not blank[0] and not SPACE[data[begin - 1]]:
            cut = np.append(cut, 0)
        opens[cut] |= ~blank[cut]
        before = cut[cut > 0] - 1
        closes[before] |= ~blank[before]
        s, e = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        starts.append(s + begin)
        ends.append(e + begin)
        if hashed and len(s):
            value = (part.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(part))
            value[blank] = 0
            summed = np.add.reduceat(value, s) * powers(_BASE_INVERSE, len(part))[s]
            hashes.append(mix(summed + (e - s).astype(np.uint64) * _STEPS[0]))
    none = np.zeros(0, np.int64)
    starts, ends = (np.concatenate(x) if x else none for x in (starts, ends))
    counts = np.diff(np.searchsorted(starts, bounds))
    return Words(starts, ends, np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), counts)


def shingles(found: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and how many each text has.

    A text with fewer words has one shingle of all its words, one without words has none.
    """
    counts = found.counts
    room = np.where(counts > 0, counts + size - 1, 0)
    at = np.concatenate([[0], np.cumsum(room)])
    padded = np.zeros(int(at[-1]), np.uint64)
    inside = np.arange(len(found.hashes)) + np.repeat(at[:-1] - found.first[:-1], counts)
    padded[inside] = found.hashes
    n = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    total = int(n.sum())
    begin = np.arange(total) + np.repeat(at[:-1] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    out = np.zeros(total, np.uint64)
    for k in range(size):
        out += padded[begin + k] * _STEPS[k]
    return mix(out), n


def pieces(texts: list, most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters, so that one step's arrays stay small."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)
