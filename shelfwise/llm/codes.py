"""Token ids as directly addressable codes, in files that Spark writes and reads.

An id is split into 8-bit chunks, lowest first. Level k holds chunk k of all ids that have one,
with a bitmap that says for each whether another follows, and a directory of the ones before
every ``RANK_BITS`` bits. The place of an id's next chunk is the rank of its bit, so any id is
read from a few bytes without decoding its block.

A block row has shard and block (its place in the order), n_docs, n_ids, doc_ids and ends (for
each document its id, null as the least number, and where its ids end in the block) and codes.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfwise.llm import tokens
from shelfwise.session import shared_folder

MAGIC = b"DAC8"
RANK_BITS = 512
#: Ids of a block; a document is not divided between blocks.
BLOCK_IDS = 1 << 20
NULL_ID = -(1 << 63)
END_ID = 2
SCHEMA = "shard int, block int, n_docs long, n_ids long, doc_ids binary, ends binary, codes binary"


def pack(ids: np.ndarray) -> bytes:
    """Codes of unsigned 32-bit ids."""
    rest, levels = ids.astype(np.uint32), []
    while len(rest):
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (RANK_BITS // 8), np.uint8)])
        ones = np.bitwise_count(bits).reshape(-1, RANK_BITS // 8).sum(axis=1, dtype=np.uint32)
        ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4")
        levels.append((len(rest), (rest & np.uint32(0xFF)).astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes()))
        rest = rest[more] >> np.uint32(8)
    return b"".join([MAGIC, struct.pack("<QB", len(ids), len(levels)),
                     *(struct.pack("<Q", n) + chunks + bits + ranks for n, chunks, bits, ranks in levels)])


class Codes:
    """Reads packed codes; slices and single ids touch only their own part of each level."""

    def __init__(self, coded: bytes):
        if coded[:4] != MAGIC:
            raise ValueError("not a block of codes")
        self.n, depth = struct.unpack_from("<QB", coded, 4)
        self.levels, at = [], 13
        for _ in range(depth):
            n, = struct.unpack_from("<Q", coded, at)
            blocks = -(-n // RANK_BITS)
            chunks = np.frombuffer(coded, np.uint8, n, at + 8)
            bits = np.frombuffer(coded, np.uint8, blocks * RANK_BITS // 8, at + 8 + n)
            at += 8 + n + len(bits)
            self.levels.append((chunks, bits, np.frombuffer(coded, "<u4", blocks, at)))
            at += 4 * blocks

    def __len__(self) -> int:
        return self.n

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Ones before bit i."""
        block = i // RANK_BITS
        if block == len(ranks):
            block -= 1
        first = block * RANK_BITS // 8
        ones = int(ranks[block]) + int(np.bitwise_count(bits[first:i // 8]).sum())
        return ones + (int(bits[i // 8] & ((1 << i % 8) - 1)).bit_count() if i % 8 else 0)

    def at(self, i: int) -> int:
        value = shift = 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i // 8] >> (i % 8) & 1:
                break
            i, shift = self._rank(bits, ranks, i), shift + 8
        return value

    def slice(self, begin: int, end: int) -> np.ndarray:
        out = np.zeros(max(0, end - begin), np.uint32)
        where = np.arange(len(out))
        shift = 0
        for chunks, bits, ranks in self.levels:
            if begin >= end:
                break
            out[where] |= chunks[begin:end].astype(np.uint32) << np.uint32(shift)
            more = np.unpackbits(bits[begin // 8:-(-end // 8)], bitorder="little")[begin % 8:begin % 8 + end - begin].view(bool)
            where, shift = where[more], shift + 8
            begin, end = self._rank(bits, ranks, begin), self._rank(bits, ranks, end)
        return out


def write(docs: DataFrame, path: str, tokenizer: str, cut: str = "any", end_id: int = END_ID, parts: int | None = None) -> None:
    """Encode every whole text (null: empty), add ``end_id``, write blocks in ascending doc_id order.

    Null ids come first, ties are ordered by text. Ranges of ids become shards, so the text is
    shuffled once; one task holds one block of ids.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = tokens.coder(tokenizer, cut), struct.pack("<I", end_id)
        shard = TaskContext.get().partitionId()
        block, ids, coded, size = 0, [], [], 0

        def row() -> pa.RecordBatch:
            ends = np.cumsum([len(c) // 4 for c in coded]).astype("<u8")
            values = [shard, block, len(ids), size, np.array(ids, "<i8").tobytes(), ends.tobytes(),
                      pack(np.frombuffer(b"".join(coded), "<u4"))]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

        for batch in batches:
            for begin in range(0, len(batch), 256):
                some = batch.slice(begin, 256)
                for doc_id, c in zip(some.column(0).to_pylist(), coder.ids(some.column(1).to_pylist()), strict=True):
                    ids.append(NULL_ID if doc_id is None else doc_id)
                    coded.append(c + end)
                    size += len(c) // 4 + 1
                    if size >= BLOCK_IDS:
                        yield row()
                        block, ids, coded, size = block + 1, [], [], 0
        if ids:
            yield row()

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
     .repartitionByRange(parts, F.col("doc_id").asc_nulls_first())
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
     .mapInArrow(run, SCHEMA).write.option("compression", "uncompressed").parquet(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def bases(blocks: DataFrame) -> DataFrame:
    """shard, block, base: ids before each block. Only one number a block moves, one a shard meets in one task."""
    sizes = blocks.select("shard", "block", "n_ids")
    inner = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("_shard_base"))
    return (sizes.withColumn("_inner", F.coalesce(F.sum("n_ids").over(inner), F.lit(0))).join(shards, "shard")
            .select("shard", "block", (F.col("_shard_base") + F.col("_inner")).alias("base")))


def digest(blocks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                codes, ids = Codes(r["codes"]), np.frombuffer(r["doc_ids"], "<i8")
                ends = np.frombuffer(r["ends"], "<u8").astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                whole = codes.slice(0, len(codes)).astype("<u4").tobytes()
                crc = [zlib.crc32(whole[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64(), mask=ids == NULL_ID), pa.array(np.full(len(ids), r["shard"]), pa.int32()),
                     pa.array(np.full(len(ids), r["block"]), pa.int32()), pa.array(starts, pa.int64()),
                     pa.array(ends - starts, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "shard", "block", "inner", "n_tokens", "ids_crc32"])

    found = blocks.select("shard", "block", "doc_ids", "ends", "codes").mapInArrow(
        run, "doc_id long, shard int, block int, inner long, n_tokens long, ids_crc32 long")
    return found.join(bases(blocks), ["shard", "block"]).select(
        "doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the codes of ``docs`` to the shared folder and report what the files hold."""
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/shelfwise/codes-{uuid.uuid4().hex}"
    write(docs, path, tokenizer)
    return digest(read(spark, path))
