"""The corpus pipeline: from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir), works on all that the one before it kept, and returns a
DataFrame. ``run`` writes each as Parquet to the shared folder and reads it again, so a lost
executor costs a stage at most. All but the last return the columns of documents.

* toxicity: documents that the operator rejects go.
* line_dedup: lines that many documents repeat go; n_chars follows the new text.
* near_duplicates: of each class of near copies the document with the least doc_id stays.
* mixing: a document comes as often as the mix takes it (a row for each copy), or not at all.
* packing: a row for each piece of a document and its place in a sequence.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import line_dedup, mixing, ngram_join, packing, tokens, toxicity
from shelfwise.session import staged


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.distinct_documents(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs, tokens.vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", without_near_duplicates),
    ("mixing", mixed),
    ("packing", packed),
]
#: Models, token vocabularies and seeded choices have no SQL form; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
