import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Extra columns whose names clash with inner ones.
    T.StructField("_id", T.StringType()), T.StructField("size", T.IntegerType()), T.StructField("key", T.StringType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source]) rows."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), "x", 1, None) for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdeéß", k=draw.randint(1, 7))) for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in all places, empty and very long texts, ties and repeated rows."""
    long = prose(1, 40_000)
    return [(1, "one two three four five six"), (2, None), (3, ""), (4, long), (5, long), (6, long[:-40] + " changed"),
            (7, "Same line that is long enough\nother\nsame line that is long enough "), (8, "same line that is long enough"),
            (9, "\tSAME line that is long enough\n"), (9, "\tSAME line that is long enough\n"), (None, "same line that is long enough"),
            (None, None), (12, " \n\n "), (13, "ab " * 400), (14, "é" * 300 + "x" * 120 + "é" * 300),
            (15, prose(2, 60), None), (16, prose(2, 60) + " more", "t"), (17, "<|endoftext|> \x1c a b ́c  d\n\n e ")]
