"""What workers keep and what reaches the driver stays bounded."""

import random
import struct

import pytest
import tokenizers
from pyspark.sql import functions as F

from shelfwise.llm import packing, tokens, toxicity


@pytest.mark.parametrize(("name", "cut"), [("word_bpe_49k.json", "any"), ("byte_bpe_50k.json", "spaces")])
def test_store_of_words_is_bounded_and_released(monkeypatch, name, cut):
    monkeypatch.setattr(tokens, "KEPT_BYTES", 20_000)
    coder = tokens.WordCoder(tokens.vocabulary(name), cut)
    plain = tokenizers.Tokenizer.from_file(tokens.vocabulary(name))
    draw = random.Random(4)
    texts = [" ".join("".join(draw.choices("abcdé!?", k=draw.randint(1, 9))) for _ in range(50)) for _ in range(40)] + ["x" * 5000 + " y", "!" * 900]
    for text, ids in zip(texts, coder.ids(texts), strict=True):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == plain.encode(text, add_special_tokens=False).ids
        assert sum(len(w) + len(c) for w, c in coder.known.items()) < 20_000
        assert all(len(w) <= tokens.WORD_CHARS for w in coder.known) and all(len(t) <= 4 for t in coder.tails)
    coder.release()
    assert not coder.known and not coder.tails


def test_store_is_empty_after_a_stage_of_another_operator(spark, make_docs):
    path = tokens.vocabulary("byte_bpe_50k.json")
    docs = make_docs([(i, f"some words {i}") for i in range(50)]).coalesce(1)
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")

    def left(batches):
        import pyarrow as pa
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(tokens.coder(path, "spaces").known)] * len(batch), pa.int64())], ["left"])

    assert packing.pieces(docs, path).count() == 50
    assert toxicity.accepted(docs, labels).count() == 50
    assert {r.left for r in docs.mapInArrow(left, "left long").collect()} == {0}


def test_one_row_a_label(spark, make_docs, monkeypatch):
    seen = {}
    monkeypatch.setattr(toxicity, "train", lambda toxic, counts, flat: seen.update(toxic=toxic.tolist(), counts=counts.tolist()))
    docs = make_docs([(1, f"text {i} of one id") for i in range(500)] + [(2, "one"), (2, "one"), (3, None), (None, "x")])
    labels = spark.createDataFrame([(1, 0), (1, 1), (1, 1), (2, 0), (3, 0), (9, 1), (None, 1), (4, None)], "doc_id long, toxic int")
    toxicity.fit(docs, labels)
    assert seen["toxic"] == [True, False, False] and seen["counts"][2] == 0


def test_odd_column_names(spark, make_docs):
    docs = make_docs([(1, "a b"), (2, None)]).withColumn("my col", F.lit(1)).withColumn("a.b", F.lit("x"))
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    out = toxicity.accepted(docs, labels)
    assert out.columns == docs.columns and sorted(map(repr, out.collect())) == sorted(map(repr, docs.collect()))
