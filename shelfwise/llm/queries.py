"""Registered queries of this subpackage, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import (codes, collocations, fill_middle, fingerprints, line_dedup, mixing, ngram_join, packing, personal_data,
                           quality, suffix_dedup, tokens, toxicity, url_filter)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_report(documents(spark, sf_dir))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(documents(spark, sf_dir))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(documents(spark, sf_dir))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.report(documents(spark, sf_dir))


def op5_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.round_trip(documents(spark, sf_dir), tokens.vocabulary("word_bpe_49k.json"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(documents(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.severity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(documents(spark, sf_dir), tokens.vocabulary("byte_bpe_50k.json"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(documents(spark, sf_dir))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filtered(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.report(documents(spark, sf_dir))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


OP10_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
h AS (SELECT key AS heavy, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT r) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (heavy IS NOT NULL AND doc_id <> last) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (heavy IS NULL OR doc_id = last), '')) AS kept_sha256
FROM k LEFT JOIN h ON key = heavy GROUP BY r, doc_id
"""

OP11_SQL = """
WITH p AS (SELECT row_number() OVER () AS r, page_id,
                  CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT r, page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path,
             regexp_extract(coalesce(rest, ''), '^[^/?#]*([^#]*)', 1) AS tail FROM p),
rules(verdict, rule, h, b) AS (VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
                                      ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
best AS (SELECT r, max(struct_pack(n := length(rule), rule := rule, verdict := verdict)) AS m
         FROM q JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, b) GROUP BY r),
seen AS (SELECT host, tail, min(page_id) AS first FROM q WHERE host <> '' GROUP BY host, tail HAVING count(*) > 1)
SELECT page_id, host, path, m.rule AS rule, coalesce(first <> coalesce(page_id, -9223372036854775808), false) AS repeated,
       coalesce(m.verdict, CASE WHEN first <> coalesce(page_id, -9223372036854775808) THEN 'block' ELSE 'allow' END) AS verdict
FROM q LEFT JOIN best USING (r) LEFT JOIN seen USING (host, tail)
"""

OP12_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS units,
             list_transform(range(4), lambda k: CAST('0x' || substr(x, 8 * k + 1, 8) AS BIGINT)) AS h FROM d),
c AS (SELECT *, least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS a, greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS b FROM u),
f AS (SELECT *, CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR h[3] % 100 >= 100 THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
             coalesce(array_to_string(units[1:a], ''), '') AS p, coalesce(array_to_string(units[a + 1:b], ''), '') AS m,
             coalesce(array_to_string(units[b + 1:], ''), '') AS s FROM c)
SELECT doc_id, len(units) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM f
"""

OP13_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT r, lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM worded GROUP BY lang),
spans AS (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM worded, (SELECT unnest(range(1, 6)) AS size) WHERE len(w) >= size),
f AS (SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, CAST(count(*) AS HUGEINT) AS a FROM spans GROUP BY ALL HAVING count(*) >= 100),
longer AS (SELECT lang, size, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE size > 2),
inner_ones AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(a) AS b
               FROM (SELECT lang, size, a, w, k, unnest(range(1, size - k + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS k FROM longer)) GROUP BY ALL),
kept AS (SELECT f.lang, f.size, f.phrase, f.a FROM f LEFT JOIN inner_ones USING (lang, phrase) WHERE f.size > 1 AND (b IS NULL OR 100 * b < 100 * a)),
cuts AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS one, array_to_string(w[k + 1:], ' ') AS other
         FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM kept)),
scored AS (SELECT cuts.lang, cuts.phrase, cuts.a, k, x.a AS l, y.a AS r, n, (1000 * cuts.a * n) // (x.a * y.a) AS score
           FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = one JOIN f y ON y.lang = cuts.lang AND y.phrase = other JOIN total ON total.lang = cuts.lang),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS c FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE c = 1)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_ngram_join": op2_ngram_join,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_personal_data": op4_personal_data,
    "op5_codes": op5_codes,
    "op6_mixing": op6_mixing,
    "op7_toxicity": op7_toxicity,
    "op8_packing": op8_packing,
    "op9_quality": op9_quality,
    "op10_line_dedup": op10_line_dedup,
    "op11_url_filter": op11_url_filter,
    "op12_fill_middle": op12_fill_middle,
    "op13_collocations": op13_collocations,
    "pipeline": pipeline,
}
ORACLES: dict[str, str] = {"op10_line_dedup": OP10_SQL, "op11_url_filter": OP11_SQL, "op12_fill_middle": OP12_SQL, "op13_collocations": OP13_SQL}
