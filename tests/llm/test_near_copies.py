"""Signatures, likeness and near copies of fingerprints against brute force."""

import collections
import random

import numpy as np

from shelfwise.llm import fingerprints, near_copies, textvec
from tests.llm.test_operators import WORD, shingle_set


def plain_signature(text, a, b):
    """The least value of every function over the shingles, one by one."""
    words = WORD.findall(text or "")
    if not words:
        return [0xFFFF] * len(a)
    hashes, _ = textvec.shingles(textvec.words(*textvec.packed([" ".join(words)])))
    return [min((int(x >> np.uint64(32)) * int(p) + int(q)) & 0xFFFFFFFF for x in hashes) & 0xFFFF for p, q in zip(a, b, strict=True)]


def test_fingerprints_and_likeness_recomputed(make_docs):
    draw = random.Random(8)
    texts = [" ".join(draw.choices(["a", "bé", "c", "dd"], k=draw.randint(0, 30))) for _ in range(25)] + [None, "", "x"]
    a, b = fingerprints.permutations(32, 5)
    out = fingerprints.edit_report(make_docs(list(enumerate(texts))), 32, 5).collect()
    shown = {r.doc_id: r for r in out}
    own = {i: plain_signature(t, a, b) for i, t in enumerate(texts)}
    for i, text in enumerate(texts):
        after = (i - 1) % len(texts)
        text, following = text or "", texts[after] or ""
        third = len(text) // 3
        edited = plain_signature(text[:len(text) - third] + following[:third], a, b)
        assert shown[i].fingerprint == "".join(f"{v:04x}" for v in own[i])
        assert shown[i].edited_fingerprint == "".join(f"{v:04x}" for v in edited)
        like = lambda x, y: sum(p == q for p, q in zip(x, y, strict=True)) / 32
        assert shown[i].near_edited == like(own[i], edited) and shown[i].near_next == like(own[i], own[after])


def test_near_copies(make_docs, odd_rows):
    draw = random.Random(9)
    rows = list(odd_rows)
    for base in range(30):
        words = [f"w{draw.randint(0, 5000)}" for _ in range(draw.randint(40, 200))]
        rows.append((100 + 10 * base, " ".join(words)))
        for k in range(1, 4):
            changed = list(words)
            for at in draw.sample(range(len(words)), k):
                changed[at] = f"new{draw.randint(0, 9)}"
            rows.append((100 + 10 * base + k, " ".join(changed)))
        rows.append((100 + 10 * base + 5, " ".join(words)))
    sets = [shingle_set(r[1]) for r in rows]
    near = lambda x, y: x == y or (x and y and 5 * len(x & y) >= 4 * len(x | y))
    pairs = {(i, j) for i in range(len(rows)) for j in range(len(rows)) if i != j and near(sets[i], sets[j])}
    links = collections.Counter(i for i, _ in pairs)
    out = collections.defaultdict(list)
    for r in near_copies.near_copies(make_docs(rows)).collect():
        out[r.doc_id].append(r)
    got, want = 0, 0
    for i, row in enumerate(rows):
        if row[0] is None or len(out[row[0]]) > 1:
            continue
        r = out[row[0]][0]
        assert r.n_links <= links[i], row[0]
        got, want = got + r.n_links, want + links[i]
    assert want > 100 and got >= 0.9 * want
    # Copies are always found, and a class never joins texts that no chain of links joins.
    same = {rows[i][0]: rows[j][0] for i, j in pairs if sets[i] == sets[j] and rows[i][0] and rows[j][0]}
    assert all(out[x][0].class_id == out[y][0].class_id for x, y in same.items())
    reach = {i: i for i in range(len(rows))}
    for _ in range(len(rows)):
        for i, j in pairs:
            reach[i] = reach[j] = min(reach[i], reach[j])
    classes = collections.defaultdict(set)
    for i, row in enumerate(rows):
        if row[0] is not None:
            classes[out[row[0]][0].class_id].add(reach[i])
    assert all(len(c) == 1 for c in classes.values())
    assert near_copies.near_copies(make_docs([])).count() == 0
