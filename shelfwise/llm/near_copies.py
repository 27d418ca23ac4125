"""Near copies by document fingerprints: bands of the fingerprint's own signatures, joined in Spark.

The ``PERMUTATIONS`` values of a signature make bands of ``BAND_ROWS``; a pair of similarity s meets in
some band with probability 1 - (1 - s^rows)^bands, at 0.8 about 0.95. Equal shingle sets are merged
before the join, a bucket is tied to one of its sets, and all sets that hang together are compared on
their full shingle sets, so what comes out has a Jaccard similarity of 0.8 or more. The join and the
comparison are those of ``ngram_join``, which also defines nulls, empty texts, ties and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfwise.llm import fingerprints, ngram_join

BAND_ROWS = 8


def near_copies(docs: DataFrame, rows: int = BAND_ROWS, n: int = fingerprints.PERMUTATIONS, seed: int = fingerprints.SEED) -> DataFrame:
    """doc_id, class_id, n_links, n_text_links and n_copies of every document, by bands of its fingerprint's signature."""
    return ngram_join.classes(docs, ngram_join.banded(docs, n, rows, seed))
