"""Personal data in long runs and against the plain patterns; languages that are null; odd column names."""

import random
import re
import time

import numpy as np
from pyspark.sql import functions as F

from shelfwise.llm import personal_data, quality

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def test_base_spans_equal_the_plain_patterns():
    draw = random.Random(5)
    met = dict.fromkeys(PLAIN, 0)
    mixed, dotted = [4, 1, 1, 5, 3, 1, 2, 4, 4, 4, 4, 2, 1, 1, 1], [0, 0, 0, 9, 0, 0, 0, 4, 4, 4, 4, 1, 0, 0, 0]
    for i in range(6000):
        text = "".join(draw.choices("a_%.@-+1250 (é\n", dotted if i % 6 == 0 else mixed, k=draw.randint(0, 60)))
        for kind, pattern in PLAIN.items():
            wanted = [m.span() for m in re.finditer(pattern, text)]
            assert list(personal_data.base_matches(kind, text)) == wanted, (kind, text)
            met[kind] += len(wanted)
    assert min(met.values()) > 100


def test_a_span_that_begins_where_another_ended():
    assert list(personal_data.base_matches("email", "a@b.c_d@e.f")) == [(0, 5), (5, 11)]


def test_long_runs_take_linear_time():
    million = 1_000_000
    for text in ("1" * million, "a" * million + " @", "1." * (million // 2), "a@" * (million // 2), "+1" + "(" * million, "a" * million + "@b.c"):
        begin = time.process_time()
        found = personal_data.candidates(text)
        assert time.process_time() - begin < 20, text[:10]
    assert [(c.kind, c.start) for c in found] == [("email", 0)]


def test_many_spans_take_little_more_than_their_number():
    text = "mail a@b.org or 415-555-2671, " * 20_000
    begin = time.process_time()
    base, _ = personal_data.spans(text, {"phone": np.append(np.zeros(len(personal_data.FEATURES)), 5.0)})
    assert time.process_time() - begin < 30 and len(base) == 20_000
    assert len(_) == 20_000


def test_covered_equals_comparing_all():
    draw = random.Random(8)
    for _ in range(300):
        spans = [(s, s + draw.randint(1, 9)) for s in draw.choices(range(60), k=draw.randint(0, 8))]
        covered = personal_data.Covered(spans)
        for start in range(0, 60, 3):
            end = start + draw.randint(1, 6)
            assert covered.meets(start, end) == any(start < e and s < end for s, e in spans)


def test_masked_keeps_odd_column_names(make_docs):
    docs = make_docs([(1, "write to a@b.org"), (2, None)]).withColumn("my col", F.lit(1)).withColumn("a:b", F.lit("x"))
    hidden = personal_data.masked(docs)
    assert hidden.columns == docs.columns
    assert {r.doc_id: (r.text, r["my col"], r["a:b"]) for r in hidden.collect()} == {1: ("write to <email>", 1, "x"), 2: (None, 1, "x")}


def test_a_null_language_is_not_the_empty_one(spark):
    draw = np.random.default_rng(2)
    # So far apart that texts of one would fail against the other's words.
    def some(words, lang, first):
        return [(first + i, " ".join(draw.choice([*words, *[f"{words[0]}{'x' * k}" for k in range(40)]], 200)), lang) for i in range(40)]
    rows = some(["the", "of", "and"], None, 0) + some(["der", "und", "ist"], "", 100)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(quality.references(docs)) == {"", "="}
    assert all(r.kept for r in quality.quality(docs).collect())


def test_the_word_test_can_decide_at_its_guard():
    share = np.array([0.2, 0.17, 0.63])
    distance = quality.js_distance(np.array([[0, 0, 1]]), share)
    assert quality.too_far(distance, np.array([quality.GUARD_WORDS]), quality.GUARD_WORDS, quality.WORD_BOUND)[0]
