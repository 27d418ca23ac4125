"""URL filters, fill-in-the-middle samples and collocations against brute force."""

import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from shelfwise.llm import collocations, fill_middle, queries, textvec, url_filter

# op11

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("host", T.StringType()), T.StructField("entry", T.StringType()), T.StructField("my col", T.StringType())])


def urls(n, seed):
    draw = random.Random(seed)
    out = [None, "", "no scheme.net/en/", "://", "http://", "http://net", "HTTP://A.NET/", "http://xnet/", "http://a.example.NET/en/x",
           "http://a.example.net/EN/x", "http://example.com/de/?q=://x", "http://example.com?de/", "http://a.org#/fr/", "http://a.org/fr",
           "http://.net/", "http://a.net./", "http://é.org/fr/ß", "x\ny://b.net/\nz?q\nw", "http://" + "a." * 5000 + "net/" + "y" * 5000, "a://b://c.net/"]
    for _ in range(n):
        host = ".".join(draw.choices(["a", "example", "WWW", "b"], k=draw.randint(0, 3)) + [draw.choice(["net", "com", "org", "de"])])
        out.append(f"{draw.choice(['http', 'https'])}://{host}{draw.choice(['', '/', '/en/', '/de/', '/fr/', '/en', '/fr/1'])}{draw.choice(['', '?q', '#f', '?q#f'])}")
    return out


def judged(rows, rules):
    """(page_id, host, path, rule, verdict, repeated) of every (page_id, url)."""
    lower = {c: c + 32 for c in range(65, 91)}
    parts, seen = [], collections.defaultdict(list)
    for page, url in rows:
        host = path = rest = ""
        if url is not None and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0].translate(lower)
            tail = rest[len(host):].split("#")[0]
            path = tail.split("?")[0]
        resource = host and host + tail
        if host:
            seen[resource].append(page)
        parts.append((page, host, path, resource))
    out = []
    for page, host, path, resource in parts:
        fit = []
        for verdict, rule in rules:
            h, slash, p = rule.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
                fit.append((len(rule), len(h), rule, verdict))
        rule, verdict = max(fit)[2:] if fit else (None, None)
        pages = seen.get(resource, [])
        first = min((p for p in pages if p is not None), default=None)
        again = len(pages) > 1 and first is not None and page != first
        out.append((page, host, path, rule, verdict or ("block" if again else "allow"), again))
    return sorted(map(repr, out))


@pytest.mark.parametrize("most", [url_filter.MOST_BYTES, 0])
def test_url_filter(spark, most):
    listed = urls(400, 1)
    draw = random.Random(2)
    rows = [(draw.choice([i, i, i, None, 7]), u) for i, u in enumerate(listed)] + [(500, listed[30]), (500, listed[30])]
    given = url_filter.RULES + [("allow", "a.net/"), ("block", "b.net/e"), ("allow", "com"), ("block", "a.org/fr"), ("allow", "rg/")]
    pages = spark.createDataFrame([(*r, "x", "=y", None) for r in rows], PAGES).repartition(5)
    got = url_filter.filtered(pages, given, most)
    assert sorted(repr(tuple(r[c] for c in ("page_id", "host", "path", "rule", "verdict", "repeated"))) for r in got.collect()) == judged(rows, given)
    assert url_filter.filtered(pages.limit(0), given, most).count() == 0
    none = url_filter.build(url_filter.rules(spark, url_filter.RULES).limit(0), most)
    out = url_filter.judged(pages, none)
    assert out.filter("rule is not null or listed").count() == 0 and out.select("_row.*").collect() == pages.collect()


def test_rule_with_two_verdicts_blocks(spark):
    index = url_filter.build(url_filter.rules(spark, [("allow", "A.net/x"), ("block", "a.net/x"), ("allow", "a.net/x")]))
    assert [(r.entry, r.verdict) for r in index.entries.collect()] == [("a.net/x", "block")]


def test_equal_digests(spark, tmp_path, monkeypatch):
    """Strings tell entries of one digest apart, and from keys that are not listed."""
    strings = [f"e{i}".encode() for i in range(40)]
    monkeypatch.setattr(url_filter, "digest", lambda key: int(key[1:]) % 3)
    order = sorted(range(40), key=lambda i: i % 3)
    ends = np.cumsum([0, *(len(strings[i]) for i in order)])
    file = tmp_path / "digests"
    file.write_bytes(b"".join([np.array([40], "<u8").tobytes(), np.array([i % 3 for i in order], "<u8").tobytes(), ends.astype("<u8").tobytes(),
                               np.zeros(40, "<i8").tobytes(), np.zeros(40, "u1").tobytes(), b"".join(strings[i] for i in order)]))
    array = url_filter.DigestArray(str(file))
    assert isinstance(array.strings.base, np.memmap) or isinstance(array.strings, np.memmap)
    assert array.find([*strings, b"e40", b"e41"]).tolist() == [order.index(i) for i in range(40)] + [-1, -1]


# op12


def sample(doc, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    hashed = lambda x: hashlib.sha256(x.encode()).hexdigest()
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")):
        return doc, len(units), "plain", None, None, hashed(text), hashed(text)
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 50 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return doc, len(units), form, len(p), len(m), hashed(out), hashed(text)


def test_fill_middle(make_docs, odd_rows):
    draw = random.Random(1)
    rows = [r[:2] for r in odd_rows] + [(-4, "a\rb\x0bc\n d"), (20, "x<"), (21, "<M\n<S\n<P"), (22, "a<P>b\nc"), (23, "\n\n"), (24, "é\n" * 60_000)]
    rows += [(100 + i, "".join(draw.choices("ab<PMS>\né", k=draw.randint(0, 40)))) for i in range(400)]
    got = fill_middle.report(make_docs(rows).repartition(3))
    assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(repr(sample(*r)) for r in rows)
    assert fill_middle.report(make_docs([])).count() == 0


def test_fill_middle_rows_and_rates(make_docs):
    rows = [(i, f"a{i}\nb\nc") for i in range(300)]
    docs = make_docs(rows)
    out = fill_middle.filled(docs, seed=9, rate=40, spm_rate=25).collect()
    forms = collections.Counter(r.form for r in out)
    assert 0.5 < forms["plain"] / 300 < 0.7 and 0.1 < forms["spm"] / (300 - forms["plain"]) < 0.4
    for r in out:
        assert r._row.lang == "en" and r._row["size"] == 1 and "text" not in r._row
        if r.form != "plain":
            assert r.prefix + r.middle + r.suffix == dict(rows)[r._row.doc_id]
    back = fill_middle.restored(fill_middle.filled(docs, seed=9, rate=40)).collect()
    assert {(r._row.doc_id, r.text) for r in back} == set(rows)


def test_parts_of_a_batch(monkeypatch):
    import pyarrow as pa
    texts = pa.array(["a\n" * n for n in (0, 5, 1, 300, 2)] + [None])
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    assert [x for part in fill_middle.slices(batch, 0, 16) for x in part.column(0).to_pylist()] == texts.to_pylist()


# op13


def mined(rows, least, longest=5, top=2000):
    total, f = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        plain = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", plain):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    phrases = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    inside = {(lang, p[i:j]) for (lang, p), b in phrases.items() for i in range(len(p)) for j in range(i + 1, len(p) + 1)
              if j - i < len(p) and 100 * b >= 100 * f[lang, p[i:j]]}
    best = collections.defaultdict(list)
    for (lang, p), a in phrases.items():
        if (lang, p) not in inside:
            score, k = min((1000 * a * total[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            best[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, total[lang], -score) for lang, some in best.items()
                  for rank, (score, a, p, left, right) in enumerate(sorted(some)[:top], 1))


def corpus(seed=5):
    draw = random.Random(seed)
    words = ["the", "The", "of", "a", "bé", "ß", "x" * 40, "new", "york", "\x1c", "İ"]
    text = lambda: "".join(draw.choice(words) + draw.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "\x0b"]) for _ in range(draw.randint(0, 60)))
    rows = [(draw.choice(["en", "en", None, "und", "", "de"]), text()) for _ in range(150)]
    return rows + [("en", None), (None, ""), ("de", "a a a a a a a a a a"), ("de", "a a a a a a a a a a"), ("en", "no"), ("fr", " . ")]


@pytest.mark.parametrize(("least", "top", "bits"), [(5, 2000, 1 << 20), (3, 40, 1 << 8)])
def test_collocations(spark, least, top, bits):
    rows = corpus()
    docs = spark.createDataFrame([(1, text, lang, "x") for lang, text in rows], "doc_id int, text string, lang string, phrase string")
    got = collocations.collocations(docs.repartition(5), least, 5, top, bits)
    assert sorted(tuple(r) for r in got.collect()) == mined(rows, least, 5, top)


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id int, text string, lang string")
    assert collocations.collocations(docs).count() == 0


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 50)
    text = "one two three. " * 40 + "z" * 300 + " end"
    parts = list(collocations.portions([text, "", "a b", text]))
    assert "".join(t for part in parts for t in part) == text + "a b" + text
    assert len(parts) > 20 and all(t.endswith((".", "end", "a b")) for part in parts for t in part)


def test_words_of_one_hash(monkeypatch):
    data, bounds = textvec.packed(["a b ab c a"])
    found = textvec.words(data, bounds)
    found.hashes[:] = 7
    number, first = collocations.word_numbers(data, found)
    assert number.tolist() == [0, 1, 2, 3, 0] and first.tolist() == [0, 1, 2, 3]


def test_score_beyond_64_bits(spark, monkeypatch):
    big = 4_000_000_000_000
    levels = [spark.createDataFrame([("en", "a", big), ("en", "b", 100)], "lang string, phrase string, f long"),
              spark.createDataFrame([("en", "a b", 100)], "lang string, phrase string, f long")]
    total = spark.createDataFrame([("en", 9 * 10 ** 15)], "lang string, n long")
    monkeypatch.setattr(collocations, "levels", lambda *a: (total, levels))
    (row,) = collocations.collocations(None).collect()
    assert row.score == 1000 * 100 * 9 * 10 ** 15 // (big * 100) and row.l == big


@pytest.mark.parametrize("name", ["op11_url_filter", "op12_fill_middle", "op13_collocations"])
def test_query_equals_sql_on_odd_tables(spark, tmp_path, name):
    """Nulls, repeats, empty and marked texts, where the given tables have none."""
    rows = corpus() * 20
    docs = [(i if i % 9 else None, text, lang) for i, (lang, text) in enumerate(rows)] + [(3, "a<S>b\nc", "en"), (4, "\n\nx", None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    pages = [(i if i % 7 else None, u) for i, u in enumerate(urls(300, 3))]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    sql = duckdb.connect()
    for table in ("documents", "pages"):
        sql.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    result = sql.execute(queries.ORACLES[name])
    columns = [c[0] for c in result.description]
    out = queries.QUERIES[name](spark, str(tmp_path))
    want = sorted(map(repr, result.fetchall()))
    assert len(want) > 10 and sorted(repr(tuple(r[c] for c in columns)) for r in out.collect()) == want
