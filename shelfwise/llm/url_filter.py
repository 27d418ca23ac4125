"""URL filters by a sorted digest array.

Entries are rules (host and the begin of a path, such as ``example.net/en/``, which fit the host and
all its subdomains) or single resources (``=`` before host, path and query). The array has the
64-bit xxhash of every entry in order, and beside it the full strings, verdicts and ids. It is one
file that Spark hands to every executor, where tasks memory-map it. A batch of urls becomes a batch
of digests, one for each host suffix and path length that the entries have; binary search finds them
all at once, and a digest counts only if the stored string is equal.

The file is made while its bytes, counted before, are at most ``MOST_BYTES``; a longer list meets
the same candidates in a join by digest and string, which Spark splits where one entry is hot. Both
ways give the same rows.

A null url, or one without ``://``, has empty host and path and fits nothing. The longest rule wins
(ties: the longest host); equal rules with two verdicts block. Repeated rows are pages of their own.
An empty table gives no rows, an empty list of entries lets every page pass.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfwise.session import shared_folder, staged

ALLOW, BLOCK = "allow", "block"
#: Bytes of the array with its strings that go to every executor.
MOST_BYTES = 64 << 20
#: Of Spark's xxhash64 function, so that entries are hashed by Spark and urls in numpy's workers alike.
SEED = 42
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_ID = -(1 << 63)


def url_parts(url: str = "url") -> tuple[Column, Column, Column]:
    """Host (A-Z in lower case), path, and the resource (host, path and query); empty without ``://``."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    empty = F.lit("")
    return (F.coalesce(host, empty), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), empty),
            F.coalesce(F.concat(host, F.regexp_extract(rest, "^[^/?#]*([^#]*)", 1)), empty))


def rules(spark: SparkSession, given: Sequence[tuple[str, str]]) -> DataFrame:
    """Entries from (verdict, rule) pairs; A-Z of the host in lower case."""
    rows = []
    for verdict, rule in given:
        host, slash, path = rule.partition("/")
        rows.append((host.translate({c: c + 32 for c in range(65, 91)}) + slash + path, verdict, None))
    return spark.createDataFrame(rows, "entry string, verdict string, first long")


def repeated_resources(pages: DataFrame) -> DataFrame:
    """Entries that block a resource met on several pages, but for the least page_id of it."""
    host, _, resource = url_parts()
    return (pages.select(resource.alias("resource"), host.alias("host"), F.col("page_id").cast("long").alias("page_id"))
            .filter("host <> ''").groupBy("resource").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
            .filter("n > 1").select(F.concat(F.lit("="), "resource").alias("entry"), F.lit(BLOCK).alias("verdict"), "first"))


@dataclass
class Filter:
    """The stored entries, the shapes of rules (labels of the host, characters of the path), and the file, if there is one."""

    entries: DataFrame
    shapes: list[tuple[int, int]]
    file: str | None


def _write(spark: SparkSession, path: str, parts: list[bytes]) -> None:
    """One file in the shared folder, whatever file system that is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    for part in parts:
        for begin in range(0, len(part), 1 << 22):
            out.write(part[begin:begin + (1 << 22)])
    out.close()


def build(entries: DataFrame, most_bytes: int = MOST_BYTES) -> Filter:
    """Filter of entries (entry, verdict, first); ``first`` is the id of a page that a resource's entry lets pass."""
    spark = entries.sparkSession
    kept = staged(entries.filter(F.col("entry").isNotNull()).groupBy("entry").agg(F.max("verdict").alias("verdict"), F.min("first").alias("first"))
                  .withColumn("digest", F.xxhash64("entry")), "url-entries")
    labels = F.size(F.split(F.substring_index("entry", "/", 1), r"\."))
    path = F.length("entry") - F.length(F.substring_index("entry", "/", 1))
    shapes = sorted((r.labels, r.path) for r in
                    kept.filter(~F.col("entry").startswith("=")).select(labels.alias("labels"), path.alias("path")).distinct().collect())
    size = kept.agg(F.sum(F.octet_length("entry") + 25)).first()[0] or 0
    if size > most_bytes:
        return Filter(kept, shapes, None)
    rows = kept.select("digest", "entry", "verdict", "first").toArrow()
    digests = rows.column("digest").to_numpy().view(np.uint64)
    order = np.argsort(digests, kind="stable")
    strings = rows.column("entry").to_pylist()
    coded = [strings[i].encode("utf-8", "surrogatepass") for i in order.tolist()]
    ends = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype("<u8")
    firsts = rows.column("first").fill_null(_NO_ID).to_numpy()[order].astype("<i8")
    blocks = (np.array(rows.column("verdict").to_pylist(), object) == BLOCK)[order].astype(np.uint8)
    name = f"url-digests-{uuid.uuid4().hex}"
    place = f"{shared_folder(spark)}/shelfwise/{name}"
    _write(spark, place, [np.array([len(coded)], "<u8").tobytes(), digests[order].astype("<u8").tobytes(), ends.tobytes(),
                          firsts.tobytes(), blocks.tobytes(), b"".join(coded)])
    spark.sparkContext.addFile(place)
    return Filter(kept, shapes, name)


class DigestArray:
    """The memory-mapped file."""

    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        n, at = int(data[:8].view("<u8")[0]), 8
        parts = []
        for kind, count in (("<u8", n), ("<u8", n + 1), ("<i8", n), ("u1", n)):
            width = np.dtype(kind).itemsize * count
            parts.append(data[at:at + width].view(kind))
            at += width
        self.digests, self.ends, self.firsts, self.blocks = parts
        self.strings = data[at:]

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Place of each key's entry, -1 for none."""
        wanted = np.fromiter(map(digest, keys), np.uint64, len(keys))
        low, high = (np.searchsorted(self.digests, wanted, side) for side in ("left", "right"))
        out = np.full(len(keys), -1)
        for i in np.flatnonzero(high > low).tolist():
            for k in range(low[i], high[i]):
                if self.strings[self.ends[k]:self.ends[k + 1]].tobytes() == keys[i]:
                    out[i] = k
        return out


def digest(key: bytes) -> int:
    return xxhash.xxh64_intdigest(key, SEED)


_MAPPED: dict[str, DigestArray] = {}


def _mapped(name: str) -> DigestArray:
    if name not in _MAPPED:
        _MAPPED.clear()  # of earlier filters
        _MAPPED[name] = DigestArray(SparkFiles.get(name))
    return _MAPPED[name]


def candidates(host: str, path: str, resource: str, shapes: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """(length, length of the host, entry) of every entry that would fit; -1 for the resource."""
    if not host:
        return []
    labels = host.split(".")
    out = [(-1, 0, "=" + resource)]
    for n, size in shapes:
        if n <= len(labels) and size <= len(path):
            end = ".".join(labels[-n:])
            out.append((len(end) + size, len(end), end + path[:size]))
    return out


def judged(pages: DataFrame, index: Filter) -> DataFrame:
    """Rows of ``pages`` as ``_row`` with host, path, rule and its verdict (null if none fits), and listed:
    is the page blocked as a resource?"""
    host, path, resource = url_parts()
    parts = pages.select(F.struct("*").alias("_row"), host.alias("host"), path.alias("path"),
                         resource.alias("resource"))
    if index.file is None:
        return _joined(parts, index)
    name, shapes = index.file, index.shapes
    schema = T.StructType([parts.schema["_row"], *(T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")),
                           T.StructField("listed", T.BooleanType())])
    rows = parts.withColumn("_id", F.coalesce(F.col("_row.page_id").cast("long"), F.lit(_NO_ID)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = _mapped(name)
        for batch in batches:
            made = [candidates(*x, shapes) for x in zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)), strict=True)]
            place = array.find([key.encode("utf-8", "surrogatepass") for some in made for _, _, key in some])
            ids, rule, verdict, listed, at = batch.column(4).to_numpy(), [], [], [], 0
            for some, own in zip(made, ids, strict=True):
                fit = [(*c, k) for c, k in zip(some, place[at:at + len(some)].tolist(), strict=True) if k >= 0]
                at += len(some)
                best = max(fit, default=(-1,))
                rule.append(best[2] if best[0] >= 0 else None)
                verdict.append((BLOCK if array.blocks[best[3]] else ALLOW) if best[0] >= 0 else None)
                listed.append(any(c[0] < 0 and array.firsts[c[3]] not in (_NO_ID, own) for c in fit))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(rule, pa.string()), pa.array(verdict, pa.string()),
                                              pa.array(listed, pa.bool_())], ["_row", "host", "path", "rule", "verdict", "listed"])

    return rows.mapInArrow(run, schema)


def _joined(parts: DataFrame, index: Filter) -> DataFrame:
    """As ``judged``, by a join of the candidates of each different url. What fits is a matter of the url alone."""
    shapes = index.shapes
    keys = ["host", "path", "resource"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [candidates(*x, shapes) for x in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            owner = pa.array(np.repeat(np.arange(len(made)), [len(m) for m in made]), pa.int64())
            flat = list(zip(*(c for some in made for c in some), strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([*(c.take(owner) for c in batch.columns), pa.array(flat[0], pa.int64()),
                                              pa.array(flat[1], pa.int64()), pa.array(flat[2], pa.string())],
                                             [*keys, "size", "hosted", "entry"])

    fit = (parts.select(*keys).distinct().mapInArrow(run, "host string, path string, resource string, size long, hosted long, entry string")
           .withColumn("digest", F.xxhash64("entry")).join(index.entries, ["digest", "entry"]))
    best = fit.groupBy(*keys).agg(
        F.max(F.when(F.col("size") >= 0, F.struct("size", "hosted", "entry", "verdict"))).alias("best"),
        F.max(F.when(F.col("size") < 0, F.col("first"))).alias("first"))
    return parts.join(best, keys, "left").select(
        "_row", "host", "path", F.col("best.entry").alias("rule"), F.col("best.verdict").alias("verdict"),
        F.coalesce(F.col("first") != F.coalesce(F.col("_row.page_id").cast("long"), F.lit(_NO_ID)), F.lit(False)).alias("listed"))


#: Of the query: (verdict, rule).
RULES = [(BLOCK, "net/"), (ALLOW, "example.net/en/"), (BLOCK, "example.com/de/"), (ALLOW, "org/fr/")]


def filtered(pages: DataFrame, given: Sequence[tuple[str, str]] = tuple(RULES), most_bytes: int = MOST_BYTES) -> DataFrame:
    """page_id, host, path, rule, verdict and repeated of every page.

    Where no rule fits, the verdict is that of the listed resources: a page whose host, path and query an earlier
    page has (a lesser page_id, rows without an id after all others) is blocked, all others are allowed. Equal ids
    are both first; where no page of a resource has an id, all pass.
    """
    index = build(rules(pages.sparkSession, given).unionByName(repeated_resources(pages)), most_bytes)
    out = judged(pages.select("page_id", "url"), index)
    return out.select(F.col("_row.page_id").cast("long").alias("page_id"), "host", "path", "rule",
                      F.coalesce("verdict", F.when(F.col("listed"), BLOCK).otherwise(ALLOW)).alias("verdict"),
                      F.col("listed").alias("repeated"))
