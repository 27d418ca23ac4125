"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs them, a classifier decides.

Base spans follow four fixed patterns and always stay. Looser patterns give further candidates.
On every candidate, base ones included, ``LABELERS`` vote yes, no or nothing: its form, its
checksum or ranges, lists of names and numbers, words before it, and what it is glued to. The
whole corpus is reduced to counts of (kind, votes, features), whose number is bounded by the
code, not by the data. On these counts expectation-maximisation estimates how often each labeler
is right, for each kind; the probabilities train a logistic classifier on the candidate's
features, and candidates that it finds likely, and that overlap no base span, are added.

Null text is empty. Repeated rows are documents of their own. An empty table gives no rows.
Places are code points, ends exclusive. Texts are searched whole.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

KINDS = ("email", "ip", "card", "phone")
# Fixed patterns of the base spans. Emails and addresses begin with a whole run of characters, which is passed over
# at once where the rest does not follow: no later start in the run could match, so long runs cost linear time.
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]++(?P<rest>@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)?"),
    "ip": re.compile(r"[0-9]++(?P<rest>\.[0-9]++\.[0-9]++\.[0-9]++)?"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: A text without this has no match of the kind.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
LOOSE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63})+"),
    "ip": re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])"),
    "card": re.compile(r"[0-9]{4}(?:[.\x20-][0-9]{4}){2}[.\x20-][0-9]{1,7}"),
    "phone": re.compile(r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9])"),
}
#: A text without any of these has no match.
LOOSE_NEEDS = {"email": ("(at)", "[at]"), "ip": (":",), "card": ("",), "phone": ("-", ".")}
#: Characters before a candidate in which its context is looked for.
CONTEXT = 32
CUES = {
    "email": re.compile(r"e-?mail|contact|write|courriel|correo", re.I),
    "ip": re.compile(r"\bip\b|address|host|server|login", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|pay|karte|carte|tarjeta", re.I),
    "phone": re.compile(r"phone|tel\b|tel\.|call|mobile|fax|cell|handy|tél", re.I),
}
AGAINST = re.compile(r"version|order|token|isbn|issn|\bid\b|serial|hash|\bv\.?$", re.I)
TOP_DOMAINS = frozenset("com org net edu gov io info co uk de fr es it nl eu us ca example".split())
LABELERS = ("form", "check", "gazetteer", "context", "edges")
FEATURES = ("base form", "loose form", "check holds", "check fails", "listed", "cue", "counter cue", "glued left", "glued right")
LIKELY = 0.5
ROUNDS = 50


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def holds(kind: str, found: str) -> bool:
    """Whether a match of the base pattern is valid."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in found.split("."))
    if kind == "card":
        digits = _digits(found)
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(_digits(found)) <= 15
    return True


@dataclass(frozen=True)
class Candidate:
    kind: str
    start: int
    end: int
    base: bool
    votes: tuple[int, ...]  # -1 no, 0 nothing, 1 yes, by labeler
    features: int  # bits, by FEATURES


def _judge(kind: str, text: str, start: int, end: int, loose: bool, valid: bool) -> tuple[tuple[int, ...], int]:
    """Votes and features of a candidate."""
    found, before = text[start:end], text[max(0, start - CONTEXT):start]
    digits = _digits(found)
    if kind == "email":
        check, listed = 0, re.split(r"[.\s)\]]+", found.lower())[-1] in TOP_DOMAINS
    elif kind == "ip":
        check, listed = (0 if loose else 1 if valid else -1), found.split(".")[0] in ("10", "127", "172", "192")
    elif kind == "card":
        check, listed = (1 if 12 <= len(digits) <= 19 and luhn(digits) else -1), digits[:1] in ("3", "4", "5", "6")
    else:
        # No area code or exchange of ten-digit numbers begins with 0 or 1.
        check = (1 if digits[0] not in "01" and digits[3] not in "01" else -1) if loose else 1 if valid else -1
        listed = found[:2] in ("+1", "+3", "+4")
    cue, against = bool(CUES[kind].search(before)), bool(AGAINST.search(before))
    left = start > 0 and (text[start - 1].isalnum() or text[start - 1] in "_-./")
    right = end < len(text) and (text[end].isalnum() or text[end] in "_-/")
    votes = (0 if loose else 1 if valid else -1, check, 1 if listed else 0, -1 if against else 1 if cue else 0, -1 if left or right else 1)
    bits = (not loose and valid, loose, check > 0, check < 0, listed, cue, against, left, right)
    return votes, sum(1 << i for i, b in enumerate(bits) if b)


def base_matches(kind: str, text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the base pattern of a kind that do not overlap, valid or not."""
    if NEEDS.get(kind, "") in text:
        for m in BASE[kind].finditer(text):
            if "rest" not in m.re.groupindex or m["rest"]:
                yield m.span()


class Covered:
    """Whether a stretch meets one of the given spans, found by bisection."""

    def __init__(self, spans: list[tuple[int, int]]):
        ordered = sorted(spans)
        self.starts = [s for s, _ in ordered]
        self.reach = list(accumulate((e for _, e in ordered), max))

    def meets(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)
        return k > 0 and self.reach[k - 1] > start


def candidates(text: str) -> list[Candidate]:
    """Base spans, failed matches and loose matches of a text, by start, then kind."""
    out, spans = [], []
    for kind in KINDS:
        for start, end in base_matches(kind, text):
            found = text[start:end]
            valid = holds(kind, found)
            # Of failed matches only those that are nearly valid are worth a vote.
            near = kind == "card" and 13 <= len(_digits(found)) <= 19 or kind == "phone" and len(_digits(found)) >= 7
            if valid or near:
                out.append(Candidate(kind, start, end, valid, *_judge(kind, text, start, end, False, valid)))
            if valid:
                spans.append((start, end))
    covered = Covered(spans)
    for kind in KINDS:
        if any(c in text for c in LOOSE_NEEDS[kind]):
            for m in LOOSE[kind].finditer(text):
                if not covered.meets(*m.span()):
                    out.append(Candidate(kind, *m.span(), False, *_judge(kind, text, *m.span(), True, False)))
    return sorted(out, key=lambda c: (c.start, KINDS.index(c.kind), c.end))


def reliabilities(votes: np.ndarray, n: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each vote pattern is personal data, and each labeler's (yes | yes, no | no) rates.

    Expectation-maximisation for one hidden yes or no; a vote of nothing says nothing. Rates
    start at 0.8 and have a weak prior there, so that rare patterns cannot turn a labeler round.
    """
    right = np.full((votes.shape[1], 2), 0.8)
    share = 0.5
    for _ in range(rounds):
        yes = np.log(share) + ((votes > 0) @ np.log(right[:, 0]) + (votes < 0) @ np.log(1 - right[:, 0]))
        no = np.log(1 - share) + ((votes < 0) @ np.log(right[:, 1]) + (votes > 0) @ np.log(1 - right[:, 1]))
        p = 1 / (1 + np.exp(np.clip(no - yes, -50, 50)))
        share = float(np.clip((n * p).sum() / n.sum(), 0.02, 0.98))
        for k in range(votes.shape[1]):
            up, down = votes[:, k] > 0, votes[:, k] < 0
            right[k, 0] = ((n * p)[up].sum() + 8) / ((n * p)[up | down].sum() + 10)
            right[k, 1] = ((n * (1 - p))[down].sum() + 8) / ((n * (1 - p))[up | down].sum() + 10)
        right = np.clip(right, 0.05, 0.95)
    return p, right


def fit_classifier(x: np.ndarray, p: np.ndarray, n: np.ndarray, rounds: int = ROUNDS, penalty: float = 1.0) -> np.ndarray:
    """Logistic weights (with a constant last) for soft labels p of n rows each, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - q)) - penalty * w
        curve = (x * (n * q * (1 - q))[:, None]).T @ x + penalty * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-9:
            break
    return w


def _bits(features: np.ndarray) -> np.ndarray:
    return (features[:, None] >> np.arange(len(FEATURES)) & 1).astype(float)


def train(docs: DataFrame) -> dict[str, np.ndarray]:
    """Classifier weights by kind, learned from all documents without any label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update((c.kind, c.votes, c.features) for c in candidates(text or ""))
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _, _ in seen], pa.string()), pa.array([list(v) for _, v, _ in seen], pa.list_(pa.int32())),
                 pa.array([f for _, _, f in seen], pa.int32()), pa.array(list(seen.values()), pa.int64())],
                ["kind", "votes", "features", "n"])

    rows = (docs.select("text").mapInArrow(run, "kind string, votes array<int>, features int, n long")
            .groupBy("kind", "votes", "features").agg(F.sum("n").alias("n")).orderBy("kind", "votes", "features").collect())
    out = {}
    for kind in KINDS:
        mine = [r for r in rows if r.kind == kind]
        if mine:
            n = np.array([r.n for r in mine], float)
            p, _ = reliabilities(np.array([r.votes for r in mine]), n)
            out[kind] = fit_classifier(_bits(np.array([r.features for r in mine])), p, n)
    return out


def spans(text: str, weights: dict[str, np.ndarray]) -> tuple[list[tuple], list[tuple]]:
    """Base spans and added ones, as (kind, start, end)."""
    found = candidates(text)
    base = [(c.kind, c.start, c.end) for c in found if c.base]
    rest = [c for c in found if not c.base and c.kind in weights]
    added: list[tuple] = []
    if rest:
        covered, reach = Covered([(s, e) for _, s, e in base]), 0  # the rest comes by start
        x = _bits(np.array([c.features for c in rest]))
        for c, row in zip(rest, x, strict=True):
            w = weights[c.kind]
            if c.start >= reach and not covered.meets(c.start, c.end) and 1 / (1 + np.exp(-np.clip(row @ w[:-1] + w[-1], -30, 30))) >= LIKELY:
                added.append((c.kind, c.start, c.end))
                reach = c.end
    return base, added


def shown(found: list[tuple]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (base and added), n_added."""
    weights = train(docs)
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [spans(t or "", weights) for t in batch.column(1).to_pylist()]
            counts = [pa.array([sum(x[0] == k for x in b) for b, _ in rows], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array([hashlib.sha256(shown(b).encode()).hexdigest() for b, _ in rows], pa.string()),
                 pa.array([shown(b + a) for b, a in rows], pa.string()), pa.array([len(a) for _, a in rows], pa.int64())],
                [c.split()[0] for c in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def masked(docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, every span of the text replaced by its kind in angle brackets."""
    weights = train(docs)
    whole = docs.select("text", F.struct("*").alias("_row"))

    def hide(text: str) -> str:
        base, added = spans(text, weights)
        out, at = [], 0
        for kind, start, end in sorted(base + added, key=lambda x: x[1:]):
            if start >= at:
                out += [text[at:start], f"<{kind}>"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else hide(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(texts, pa.string())], ["_row", "_hidden"])

    out = whole.mapInArrow(run, T.StructType([whole.schema["_row"], T.StructField("_hidden", T.StringType())]))
    return out.select(*[F.col("_hidden").alias(c) if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
