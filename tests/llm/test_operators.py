"""Every operator against a brute-force version, on rows with all odd cases and on an empty table."""

import collections
import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pytest
import tokenizers
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shelfwise.llm import (codes, fingerprints, line_dedup, mixing, ngram_join, packing, personal_data, quality, suffix_dedup,
                           textvec, tokens, toxicity)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LEAST = -(1 << 63)
CODERS = [("word_bpe_49k.json", "any"), ("byte_bpe_50k.json", "spaces")]


def by_row(df, *columns):
    return sorted((tuple(r[c] for c in ("doc_id", *columns)) for r in df.collect()), key=repr)


def shingle_set(text):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


@given(st.lists(st.text(alphabet="ab \n\té", max_size=60), max_size=6))
@settings(max_examples=60, deadline=None)
def test_words_and_shingles(texts):
    data, bounds = textvec.packed(texts)
    found = textvec.words(data, bounds)
    plain = [w for t in texts for w in WORD.findall(t)]
    assert [data[a:b].tobytes().decode() for a, b in zip(found.starts, found.ends)] == plain
    assert len(set(found.hashes.tolist())) == len(set(plain))
    _, n = textvec.shingles(found)
    assert n.tolist() == [max(1, len(w) - 4) if (w := WORD.findall(t)) else 0 for t in texts]


def test_words_over_chunks(monkeypatch):
    monkeypatch.setattr(textvec, "CHUNK", 16)
    texts = ["a" * 50 + " b", "cc dd " * 9, "", "e" * 16, "f"]
    found = textvec.words(*textvec.packed(texts))
    assert found.counts.tolist() == [2, 18, 0, 1, 1]
    assert len(set(found.hashes.tolist())) == 6


# op1


def test_fingerprints(make_docs, odd_rows):
    out = fingerprints.edit_report(make_docs(odd_rows)).collect()
    assert len(out) == len(odd_rows)
    order = sorted(((r[0], r[1] or "") for r in odd_rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    expected = []
    for (doc, text), (_, after) in zip(order, order[1:] + order[:1]):
        third = len(text) // 3
        changed = text[:len(text) - third] + after[:third]
        expected.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest()))
    assert sorted(map(repr, expected)) == sorted(repr((r.doc_id, r.n_chars, r.edited_sha256)) for r in out)
    prints = collections.defaultdict(set)
    texts = {r[0]: r[1] for r in odd_rows if r[0]}
    for r in out:
        if r.doc_id:
            prints[texts[r.doc_id]].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(p) == 1 for p in prints.values())
    assert fingerprints.edit_report(make_docs([])).count() == 0
    (alone,) = fingerprints.edit_report(make_docs([(5, "a b c")])).collect()
    assert alone.edited_sha256 == hashlib.sha256(b"a ba ").hexdigest() or alone.near_next == 1.0


def test_likeness_estimates_jaccard():
    base = [f"w{i}" for i in range(400)]
    other = base[:300] + [f"v{i}" for i in range(100)]
    a, b = fingerprints.permutations()
    prints = fingerprints.shown(fingerprints.text_signatures([" ".join(base), " ".join(other)], a, b))
    one, two = shingle_set(" ".join(base)), shingle_set(" ".join(other))
    assert abs(fingerprints.likeness(prints[:1], prints[1:])[0] - len(one & two) / len(one | two)) < 0.15


# op2


def brute_links(rows):
    sets = [shingle_set(t) for _, t in rows]
    n = len(rows)
    linked = [[i != j and (a == b or 5 * len(a & b) >= 4 * len(a | b) > 0) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    group = list(range(n))
    for _ in range(n):
        for i in range(n):
            for j in range(n):
                if linked[i][j]:
                    group[j] = group[i] = min(group[i], group[j])
    ids = {g: min((rows[i][0] for i in range(n) if group[i] == g and rows[i][0] is not None), default=None) for g in set(group)}
    return sorted(((rows[i][0], ids[group[i]], sum(linked[i])) for i in range(n)), key=repr)


@pytest.mark.parametrize(("block", "block_bytes"), [(2, 4 << 20), (2048, 1200), (2048, 4 << 20)])
def test_ngram_join(make_docs, odd_rows, monkeypatch, block, block_bytes):
    base = WORD.findall("the quick brown fox jumps over lazy dogs and runs through many green fields again " * 1) + [f"u{i}" for i in range(60)]
    near = [(100 + k, " ".join(base[:k] + ["changed"] + base[k + 1:])) for k in range(0, 40, 4)]
    # Texts that grow by steps, so that linked ones lie in one level and in two next to each other.
    grown = [(300 + k, " ".join(base + [f"w{i}" for i in range(3 * k)])) for k in range(14)]
    rows = [(r[0], r[1]) for r in odd_rows] + near + [(200, " ".join(base))] + grown
    monkeypatch.setattr(ngram_join.verified, "__defaults__", (block, block_bytes))
    docs = make_docs(rows)
    assert by_row(ngram_join.classes(docs), "class_id", "n_links") == brute_links(rows)
    kept = ngram_join.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({(c if c is not None else "null") for _, c, _ in brute_links(rows)})


def test_sizes_of_linked_sets_are_at_most_a_level_apart(spark):
    sizes = spark.range(1, 20_000).select(F.col("id").alias("n"), ngram_join.levels(F.col("id")).alias("level")).collect()
    level = {r["n"]: r["level"] for r in sizes}
    for n in range(1, 15_999):
        assert level[n] <= level[n * 5 // 4] <= level[n] + 1


@given(st.lists(st.integers(1, 40), min_size=1, max_size=30), st.integers(0, 30), st.integers(1, 5), st.randoms())
@settings(max_examples=40, deadline=None)
def test_links_by_tiles(sizes, n_left, tile, draw):
    sets = [np.array(sorted(draw.sample(range(45), n)), np.uint64) for n in sizes]
    docs = np.arange(1, len(sets) + 1)
    was, ngram_join.TILE = ngram_join.TILE, tile
    try:
        for left in (None, min(n_left, len(sets))):
            linked, n, weighed = ngram_join.links_of(sets, docs, left)
            for i, a in enumerate(sets):
                met = [j for j, b in enumerate(sets) if i != j and (left is None or (i < left) != (j < left))
                       and 5 * len(np.intersect1d(a, b)) >= 4 * len(np.union1d(a, b))]
                assert np.flatnonzero(linked[i]).tolist() == met
                assert (n[i], weighed[i]) == (len(met), sum(docs[j] for j in met))
    finally:
        ngram_join.TILE = was


def test_long_near_copies_are_dealt_by_bytes(spark):
    """1,024 sets of 20,000 shingles: a pair of blocks takes less than 150 MB, and no link is lost."""
    import tracemalloc

    base = np.arange(20_000, dtype=np.uint64)
    rows = [(bytearray(b"c"), bytearray(k.to_bytes(4, "big")), 1, k) for k in range(1024)]
    groups = spark.createDataFrame(rows, "component binary, set binary, docs long, k int").withColumn(
        "shingles", F.expr(f"cast(repeat('x', {20_000 * 8}) as binary)")).drop("k")
    parts = ngram_join.dealt(groups, ngram_join.BLOCK, ngram_join.BLOCK_BYTES).groupBy("_low", "_a", "_high", "_b").agg(
        F.count(F.lit(1)).alias("n")).collect()
    blocks = {p["_a"] for p in parts}
    assert len(parts) == len(blocks) * (len(blocks) + 1) // 2
    most = max(p["n"] for p in parts)
    sets = [np.concatenate([base, np.array([1 << 40 | k], np.uint64)]) for k in range(most)]
    tracemalloc.start()
    _, n, _ = ngram_join.links_of(sets, np.ones(most, int), most // 2)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert n.tolist() == [most - most // 2] * (most // 2) + [most // 2] * (most - most // 2)
    assert peak < 150 << 20


def test_ngram_join_empty(make_docs):
    assert ngram_join.classes(make_docs([])).count() == 0
    assert ngram_join.distinct_documents(make_docs([])).count() == 0
    assert ngram_join.band_rows() == 8


# op3


def brute_repeats(rows):
    seen, out = {}, []
    for doc, text in rows:
        data = (text or "").encode()
        mask = bytearray(len(data))
        for s in range(len(data) - 99):
            at = seen.setdefault(data[s:s + 100], (doc, text, s))
            if at != (doc, text, s):
                mask[s:s + 100] = b"\1" * 100
        kept = bytes(b for b, m in zip(data, mask) if not m)
        spans = len(re.findall(b"\1+", bytes(mask)))
        out.append((doc, len(data), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@given(st.lists(st.tuples(st.text(alphabet="ab", max_size=5), st.text(alphabet="ab", max_size=9)), min_size=1, max_size=25))
@settings(max_examples=150, deadline=None)
def test_covered_runs_of_one_anchor(sides):
    group = [(i, 0, 0, len(a), (a + "#" + b).encode()) for i, (a, b) in enumerate(sides)]
    got = collections.defaultdict(set)
    for doc, _, start, size in suffix_dedup.covered(group, 6):
        got[doc] |= set(range(start, start + size))
    want = collections.defaultdict(set)
    for i, (_, _, _, at, data) in enumerate(group):
        for s in range(max(0, at - 5), min(at, len(data) - 6) + 1):
            if any(o_at >= at - s and other[o_at - (at - s):][:6] == data[s:s + 6]
                   for _, _, _, o_at, other in group[:i]):
                want[i] |= set(range(s, s + 6))
        if any(g[3:] == group[i][3:] for g in group[:i]):  # equal contexts are covered as a whole
            want[i] = set(range(len(data)))
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_an_anchor_with_very_many_contexts():
    """100,000 contexts of one anchor in one task: memory in proportion to them."""
    import tracemalloc

    draw = random.Random(5)
    middle = b"the same words around one anchor, in all of these texts"
    group = [(i, 0, 0, 60, draw.randbytes(40) + middle[:20] + middle + draw.randbytes(45)) for i in range(100_000)]
    group[-1] = (99_999, 0, 0, 60, group[0][4][:150] + b"other bytes here")
    tracemalloc.start()
    found = suffix_dedup.covered(group)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found == [(99_999, 0, 0, 150)]
    assert peak < 200 << 20


@pytest.mark.parametrize(("hot", "most_marks"), [(4096, 64 << 20), (2, 64 << 20), (4096, 0)])
def test_suffix_dedup(make_docs, odd_rows, monkeypatch, hot, most_marks):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "MOST_MARKS", most_marks)
    passage = "A passage that several documents share, long enough to be found by its bytes: é and ß and more words here."
    more = [(50 + k, f"{'start ' * k}{passage}{' end' * (k % 3)} {k}") for k in range(9)]
    # The order of equal ids goes by a hash that only Spark has; ids are distinct here but for equal rows.
    rows = [(r[0], r[1][:3000] if r[1] else r[1]) for r in odd_rows if r[0] is not None or r[1]] + more
    ordered = sorted(rows, key=lambda r: LEAST if r[0] is None else r[0])
    out = suffix_dedup.report(make_docs(rows))
    assert by_row(out, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_repeats(ordered)


def test_suffix_dedup_empty(make_docs):
    assert suffix_dedup.report(make_docs([])).count() == 0
    assert by_row(suffix_dedup.report(make_docs([(1, None)])), "n_bytes", "n_removed") == [(1, 0, 0)]


def test_anchors_over_blocks(monkeypatch):
    data, bounds = textvec.packed(["ab" * 300, "x", "q" * 99, "the same " * 60])
    whole = suffix_dedup.anchors(data, bounds)
    covered = sum(whole["size"] - 99)
    assert covered == sum(max(0, n - 99) for n in (600, 1, 99, 540))


@given(st.lists(st.text(alphabet="ab", max_size=40), min_size=1, max_size=12), st.sampled_from([0, 8, 16]))
@settings(max_examples=80, deadline=None)
def test_deep_shallow(strings, shallow):
    coded = [s.encode() for s in strings]
    order, common = suffix_dedup.deep_shallow(coded, shallow)
    assert [coded[i] for i in order] == sorted(coded)
    assert common[1:] == [suffix_dedup.common_prefix(coded[a], coded[b]) for a, b in zip(order, order[1:])]


# op4


def test_personal_data(make_docs, odd_rows):
    text = ("Mail to a.b@c.org or +1 (168) 555-5254 or call (415) 555-2671; card 4111 1111 1111 1111, not 4111 1111 1111 1112, "
            "host 10.0.0.255 not 10.0.0.256 é")
    rows = [*odd_rows, (300, text), (301, "b@" + "x" * 5000 + ".org " + "9" * 6000)]
    out = {r.doc_id: r for r in personal_data.report(make_docs(rows)).collect() if r.doc_id}
    r = out[300]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    base = [("email", 8, 17), ("phone", 21, 38), ("card", text.index("4111"), text.index("4111") + 19),
            ("ip", text.index("10.0"), text.index("10.0") + 10)]
    shown = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
    assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
    assert set(shown.split(",")) <= set(r.spans.split(","))
    assert out[3].spans == "" and out[301].n_email == 1
    assert personal_data.report(make_docs([])).count() == 0
    hidden = personal_data.masked(make_docs(rows))
    assert hidden.columns == make_docs([]).columns
    assert "<email>" in hidden.filter("doc_id = 300").first().text


def test_labeler_reliabilities():
    draw = np.random.default_rng(4)
    truth = draw.random(4000) < 0.4
    votes = np.stack([np.where(draw.random(4000) < right, truth, ~truth) * 2 - 1 for right in (0.95, 0.8, 0.7, 0.9)], axis=1)
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    p, rates = personal_data.reliabilities(patterns, n.astype(float))
    assert np.allclose(rates.mean(axis=1), (0.95, 0.8, 0.7, 0.9), atol=0.05)
    found = {tuple(v): q for v, q in zip(patterns, p)}
    assert np.mean([(found[tuple(v)] > 0.5) == t for v, t in zip(votes, truth)]) > 0.95


# op5


@pytest.mark.parametrize(("name", "cut"), [("word_bpe_49k.json", "any"), ("byte_bpe_50k.json", "spaces")])
def test_kept_words_change_no_id(odd_rows, name, cut):
    coder = tokens.WordCoder(tokens.vocabulary(name), cut)
    texts = [r[1] or "" for r in odd_rows] + ["a b", " a", "a ", "a\nb", "a\n b", "a  b", "a\tb", "it's 12 x!? É́", "a\0b",
                                              "\n", "don't\nstop now."]
    for _ in range(2):
        for text, ids in zip(texts, coder.ids(texts)):
            assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == coder.library.encode(text, add_special_tokens=False).ids, text


def same_as_library(name, cut, texts):
    """The ids of every text against a library of their own, read anew."""
    library = tokenizers.Tokenizer.from_file(tokens.vocabulary(name))
    coder = tokens.WordCoder(tokens.vocabulary(name), cut)
    for text, ids in zip(texts, coder.ids(texts)):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize(("name", "cut"), CODERS)
def test_mixed_white_space_changes_no_id(name, cut):
    draw = random.Random(5)
    mixes = ["".join(draw.choices(["a", "b", "cd", "'s", " ", " ", "\t", "\n", "\u00a0"], k=draw.randint(1, 12))) for _ in range(3000)]
    same_as_library(name, cut, ["a b\tc", "a\tb\tc\n\n", *mixes])


@pytest.mark.parametrize(("name", "cut"), CODERS)
def test_added_tokens_keep_their_ids(name, cut):
    same_as_library(name, cut, ["x <|endoftext|> y", "<|startoftext|>a b", "a<|endoftext|>", "a b\n<|endoftext|>\nc d",
                                "<|ENDOFTEXT|> a", "<|endoftext |> a", "<|endoftext|><|endoftext|>", "endoftext|> <| a"])


@pytest.mark.parametrize(("name", "cut"), CODERS)
def test_letters_of_the_short_path(name, cut):
    letters = [c for c in map(chr, range(0x250)) if c.isalpha()]
    assert sum(tokens._SIMPLE.fullmatch(c) is not None for c in letters) == len(letters) - 1  # but U+0130
    same_as_library(name, cut, [t for c in letters for t in (c, c + "stanbul", "x" + c, c + c + "!?", f"a {c}b")])


@given(st.lists(st.integers(0, (1 << 32) - 1) | st.integers(0, 300), max_size=1500), st.data())
@settings(max_examples=40, deadline=None)
def test_codes_are_addressable(ids, data):
    coded = codes.Codes(codes.pack(np.array(ids, np.uint32)))
    assert coded.slice(0, len(ids)).tolist() == ids
    if ids:
        i = data.draw(st.integers(0, len(ids) - 1))
        assert coded.at(i) == ids[i]
        assert coded.slice(i, min(len(ids), i + 70)).tolist() == ids[i:i + 70]


def test_code_files(make_docs, odd_rows, monkeypatch):
    path = tokens.vocabulary("word_bpe_49k.json")
    out = codes.round_trip(make_docs(odd_rows), path).collect()
    library = tokens.WordCoder(path, "any").library
    at, expected = 0, []
    for doc, text in sorted(((r[0], r[1]) for r in odd_rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((doc, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in out)
    assert codes.round_trip(make_docs([]), path).count() == 0


# op6


def test_targets():
    assert mixing.targets({"a": 100, "b": 100, None: 100}) == {"a": 187.5, "b": 75.0, None: 37.5}
    capped = mixing.targets({"a": 10, "b": 500})
    assert capped["a"] == 30 and capped["b"] == 480
    assert mixing.targets({}) == {}


def test_flow_spreads_overlapping_patterns():
    # Pattern 0 serves source 0 only, pattern 1 both; repeating is dearer than using fresh words.
    flows = mixing.cheapest_flow([100, 100], [[0], [0, 1]], [120, 80])
    assert flows[0] == {0: 100} and flows[1] == {0: 20, 1: 80}
    assert mixing.cheapest_flow([10], [[0]], [100]) == [{0: 30}]


def test_mixing(make_docs, odd_rows):
    rows = [*odd_rows, *[(1000 + i, "w " * (i % 40 + 1), f"src{i % 4}") for i in range(400)]]
    docs = make_docs(rows)
    out = mixing.mix_documents(docs).collect()
    assert len(out) == len(rows)
    assert sorted(map(repr, out)) == sorted(map(repr, mixing.mix_documents(docs.repartition(7)).collect()))
    sources = collections.defaultdict(int)
    for r in rows:
        sources[r[2] if len(r) > 2 else "s"] += len(WORD.findall(r[1] or ""))
    goal = mixing.targets(sources)
    got = {(r.source_size, round(r.target, 6)) for r in out}
    assert got == {(sources[s], round(goal[s], 6)) for s in sources}
    for size, target in got:
        mine = [r for r in out if (r.source_size, round(r.target, 6)) == (size, target)]
        assert abs(sum(r.taken for r in mine) - target) <= max(r.size for r in mine)
        assert all(r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size for r in mine)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in out)
    assert mixing.mix_documents(make_docs([])).count() == 0


# op7


def test_ordinal_regression_recovers_grades():
    draw = np.random.default_rng(7)
    x = (draw.random((3000, 6)) < 0.3).astype(np.float32)
    score = x @ np.array([2.0, 1.5, 1.0, 0, 0, 0]) + draw.logistic(size=3000) * 0.5
    grade = (score > 1.0).astype(int) + (score > 2.5)
    w, cuts = toxicity.fit_ordinal(x, grade, np.zeros(6))
    assert cuts[0] < cuts[1] and w[0] > w[1] > w[2] > 1.0 and np.abs(w[3:]).max() < 0.5


def test_toxicity_held_out(spark, make_docs, odd_rows):
    draw = np.random.default_rng(1)
    bad = ["vilon", "grumak", "zottel"]

    def text(i, toxic):
        w = [f"w{k}" for k in draw.integers(0, 300, 60)]
        if toxic:
            for b in draw.choice(bad, draw.integers(1, 4), replace=False):
                w.insert(int(draw.integers(0, len(w))), f"{b}.")
        return " ".join(w)

    truth = {1000 + i: int(i % 7 == 0) for i in range(900)}
    docs = make_docs([*odd_rows, *[(i, text(i, t)) for i, t in truth.items()]])
    labels = spark.createDataFrame([(i, 1, t) for i, t in truth.items() if i < 1600] + [(None, 1, 1), (1, None, None)],
                                   "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.severity(docs, labels).collect() if r.doc_id}
    held = [i for i in truth if i >= 1600]
    assert all(out[i].toxic == bool(truth[i]) for i in held)
    assert all(0 <= r.severity <= 2 for r in out.values())
    assert not out[3].toxic and not out[2].toxic
    kept = toxicity.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - sum(truth.values())
    assert toxicity.severity(docs, labels.filter("toxic = 0")).filter("toxic").count() == 0
    assert toxicity.severity(make_docs([]), labels).count() == 0


# op8


def test_packing(make_docs, odd_rows):
    path = tokens.vocabulary("byte_bpe_50k.json")
    out = packing.packed_documents(make_docs(odd_rows), path).collect()
    library = tokens.WordCoder(path, "spaces").library
    expected = []
    for doc, text in ((r[0], r[1]) for r in odd_rows):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for piece, n in enumerate(packing.piece_lengths(len(ids))):
            expected.append((doc, piece, at, n, zlib.crc32(struct.pack(f"<{n}I", *ids[at:at + n]))))
            at += n
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)[:5]) for r in out)
    check_sequences([(r.sequence_id, r.offset, r.length) for r in out])
    assert packing.packed_documents(make_docs([]), path).count() == 0


def check_sequences(placed, capacity=packing.CAPACITY):
    sequences = collections.defaultdict(list)
    for sequence, offset, length in placed:
        sequences[sequence].append((offset, length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@given(st.dictionaries(st.integers(1, 2048), st.integers(1, 30), max_size=60))
@settings(max_examples=25, deadline=None)
def test_plan_places_every_piece(counts):
    packing_plan = packing.plan(counts)
    placed = []
    for length, rows in packing_plan.places.items():
        rank = 0
        for first, n, sequence, offset in rows:
            assert first == rank
            rank += n
            placed += [(sequence + i, offset, length) for i in range(n)]
        assert rank == counts[length]
    used = check_sequences(placed)
    assert used == packing_plan.sequences
    bound = -(-sum(k * n for k, n in counts.items()) // 2048)
    assert used <= max(bound * 1.5 + 1, sum(n for k, n in counts.items() if k > 1024) + bound)


# op9


def test_quality(make_docs, odd_rows):
    good = [(2000 + i, " ".join(np.random.default_rng(i).choice(["the", "of", "and", "to", *[f"word{'x' * k}" for k in range(40)]], 150)))
            for i in range(60)]
    junk = (3000, " ".join(f"Q{chr(65 + i % 26)}Z#%" for i in range(200)))
    rows = [*odd_rows, *good, junk]
    out = quality.quality(make_docs(rows)).collect()
    expected = []
    for doc, text in ((r[0], r[1] or "") for r in rows):
        w = WORD.findall(text)
        times = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        inside = {j for i in range(len(w) - 2) if times[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        expected.append((doc, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside),
                         len(w) < 50 or 100 * len(inside) > 50 * len(w)))
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)[:7]) for r in out)
    kept = {r.doc_id: r.kept for r in quality.quality(make_docs([*good, junk])).collect()}
    assert all(kept[i] for i, _ in good) and not kept[3000]
    assert quality.quality(make_docs([])).count() == 0


def test_js_distance():
    assert quality.js_distance(np.array([[1, 0], [1, 1], [0, 0]]), np.array([0.0, 1.0])).round(6).tolist() == [1.0, 0.558, 0.0] or \
        quality.js_distance(np.array([[1, 0]]), np.array([0.0, 1.0]))[0] == 1.0


# op10


def brute_lines(rows):
    holders = collections.defaultdict(list)
    for n, (doc, text) in enumerate(rows):
        for key in {line_dedup.line_key(x) for x in (text or "").split("\n")}:
            if len(key) >= 20:
                holders[key].append(LEAST if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(h := holders[line_dedup.line_key(x)]) < 3 or max(h) == (LEAST if doc is None else doc)]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("most", [64 << 20, -1])
def test_line_dedup(make_docs, odd_rows, monkeypatch, most):
    monkeypatch.setattr(line_dedup, "MOST_FILTER_BYTES", most)
    rows = [(r[0], r[1]) for r in odd_rows]
    docs = make_docs(rows)
    assert by_row(line_dedup.line_report(docs), "n_lines", "n_dropped", "kept_sha256") == brute_lines(rows)
    out = line_dedup.deduplicated(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert line_dedup.line_report(make_docs([])).count() == 0


def test_line_index_is_reversible(make_docs):
    line = "a line that is long enough to count"
    first = make_docs([(1, line), (2, line + "\nx"), (3, "an other line that is long enough")])
    more = make_docs([(4, "A line that is long enough to COUNT"), (5, "an other line that is long enough"), (6, "an other line that is long enough")])
    index = line_dedup.build(first)

    def state(i):
        return sorted(map(repr, i.heavy.collect())), sorted(map(repr, i.ledger.collect()))

    before = state(index)
    grown = line_dedup.insert(index, more)
    whole = line_dedup.build(first.union(more))
    assert state(grown) == state(whole) and len(state(grown)[0]) == 2
    assert {r.n_dropped for r in line_dedup.line_report(first.union(more)).collect()} == {0, 1}
    keys = np.frombuffer(b"".join(r.key for r in grown.heavy.collect()), ">u8").reshape(-1, 2)[:, 1].astype(np.uint64)
    held = line_dedup.CuckooFilter.from_bytes(grown.filters.first()["filter"])
    assert held.contains(keys).all()
    back = line_dedup.delete(grown, more)
    assert state(back) == before
    assert not (line_dedup.CuckooFilter.from_bytes(back.filters.first()["filter"]).table > 0).any()


def test_cuckoo_filter():
    draw = np.random.default_rng(10)
    keys = draw.integers(0, 1 << 63, 20_000).astype(np.uint64)
    held = line_dedup.CuckooFilter.of(keys)
    assert held.contains(keys).all()
    assert held.contains(draw.integers(0, 1 << 63, 20_000).astype(np.uint64)).mean() < 0.01
    held.delete(keys[:10_000])
    assert held.contains(keys[10_000:]).all() and held.contains(keys[:10_000]).mean() < 0.01
