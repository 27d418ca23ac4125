"""Fill-in-the-middle samples, by pyarrow.compute on whole batches.

A text is cut into units (lines with their line end). Seeded hashes of the document's id choose two
cuts between units and the order of the output: ``psm`` is prefix, suffix, middle, ``spm`` suffix,
prefix, middle, each behind its mark; ``plain`` is the text itself. Units of all texts of a batch
are one flat array with the index of their text; their ordinals give them a role, the units of a
role are filtered out, made lists by text again and joined to one string.

Texts that are empty or hold a mark are plain. Null text is empty; a null id has an empty decimal
form in its hash. Equal ids get equal draws; repeated rows are documents of their own. An empty
table gives no rows. Texts are never shuffled. The result has the input's columns other than the text
as ``_row``, so their names clash with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

SEED = 7
#: Of 100 texts so many are transformed, and of those so many as ``spm``.
RATE = 100
SPM_RATE = 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of text that go through the pipeline at a time.
PART = 1 << 23
_ANY_MARK = "|".join((PREFIX, SUFFIX, MIDDLE))


def draws(seed: int = SEED) -> list:
    """h1 to h4: the first four groups of 8 hexadecimal digits of sha256("seed:id")."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def slices(batch: pa.RecordBatch, text: int, most: int = PART) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``most`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]
    for begin, end in zip(cuts, cuts[1:]):  # noqa: B905
        if end > begin:
            yield batch.slice(begin, end - begin)


def units(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Flat units of all texts and the number of each text: lines with their end, no empty one."""
    lines = pc.split_pattern(texts, "\n")
    flat, owner = pc.list_flatten(lines), pc.list_parent_indices(lines).to_numpy()
    last = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, bool)
    ended = pc.binary_join_element_wise(flat, pc.if_else(pa.array(last), "", "\n"), "")
    real = pc.or_(pa.array(~last), pc.not_equal(flat, ""))
    kept = pc.filter(pa.array(owner), real).to_numpy()
    return pc.filter(ended, real), np.bincount(kept, minlength=len(texts))


def joined(flat: pa.Array, owner: np.ndarray, role: np.ndarray, n: int) -> pa.Array:
    """One string for each of n texts: its units of a role."""
    bounds = np.concatenate([[0], np.cumsum(np.bincount(owner[role], minlength=n))])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pc.filter(flat, pa.array(role))), "")


def transform(texts: pa.Array, h: list[np.ndarray], rate: int = RATE, spm_rate: int = SPM_RATE) -> list[pa.Array]:
    """n, form, prefix, middle, suffix and output of every text; the pieces of plain texts are null."""
    texts = pc.fill_null(texts, "")
    flat, counts = units(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    ordinal = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    one, other = h[0] % (counts + 1), h[1] % (counts + 1)
    low, high = np.minimum(one, other)[owner], np.maximum(one, other)[owner]
    prefix, middle, suffix = (joined(flat, owner, role, len(texts)) for role in
                              (ordinal < low, (low <= ordinal) & (ordinal < high), high <= ordinal))
    plain = pc.or_(pc.or_(pc.equal(texts, ""), pc.match_substring_regex(texts, _ANY_MARK)), pa.array(h[2] % 100 >= rate))
    spm = pa.array(h[3] % 100 < spm_rate)
    turned = pc.if_else(spm, pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, ""),
                        pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, ""))
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    none = pa.scalar(None, pa.string())
    return [pa.array(counts, pa.int64()), form, *(pc.if_else(plain, none, p) for p in (prefix, middle, suffix)),
            pc.if_else(plain, texts, turned)]


def rebuild(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    """The texts from outputs and forms alone. A text with a mark is plain, so the marks found are those put there."""
    pieces = pc.split_pattern_regex(outputs, _ANY_MARK)
    plain = pc.equal(forms, "plain")
    # Four pieces each: nothing, then as the form says, and the middle last.
    some = pc.filter(pieces, pc.invert(plain))
    spm = pc.equal(pc.filter(forms, pc.invert(plain)), "spm")
    one, other, middle = (pc.list_element(some, k) for k in (1, 2, 3))
    made = pc.binary_join_element_wise(pc.if_else(spm, other, one), middle, pc.if_else(spm, one, other), "")
    return pc.replace_with_mask(outputs, pc.invert(plain), made)


def _columns(*fields: tuple[str, T.DataType]) -> list[T.StructField]:
    return [T.StructField(*f) for f in fields]


def filled(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """The rows of ``docs`` as ``_row`` with n, form, prefix, middle, suffix (null if plain) and output."""
    rest = docs.drop("text").select(F.struct("*").alias("_row")).schema["_row"]
    rows = docs.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in rest.dataType.names]).alias("_row"), "text", *draws(seed))
    schema = T.StructType([T.StructField("_row", rows.schema["_row"].dataType), *_columns(
        ("n", T.LongType()), ("form", T.StringType()), ("prefix", T.StringType()), ("middle", T.StringType()),
        ("suffix", T.StringType()), ("output", T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                h = [part.column(k).to_numpy() for k in (2, 3, 4, 5)]
                yield pa.RecordBatch.from_arrays([part.column(0), *transform(part.column(1), h, rate, spm_rate)],
                                                 ["_row", "n", "form", "prefix", "middle", "suffix", "output"])

    return rows.mapInArrow(run, schema)


def restored(samples: DataFrame) -> DataFrame:
    """All columns of ``samples`` and ``text``, rebuilt from ``output`` and ``form``."""
    names = samples.columns
    schema = T.StructType([*samples.schema.fields, T.StructField("text", T.StringType())])
    output, form = names.index("output"), names.index("form")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, output):
                yield pa.RecordBatch.from_arrays([*part.columns, rebuild(part.column(output), part.column(form))], [*names, "text"])

    return samples.mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, the length of the pieces, and digests of the output and of the text rebuilt from it."""
    samples = filled(docs.select("doc_id", "text")).select(
        F.col("_row.doc_id").cast("long").alias("doc_id"), "n", "form", F.length("prefix").cast("long").alias("prefix_chars"),
        F.length("middle").cast("long").alias("middle_chars"), "output")

    def digest(column: str):
        return F.sha2(F.col(column).cast("binary"), 256).alias(f"{'restored' if column == 'text' else column}_sha256")

    return restored(samples).select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("text"))
