"""Users and goods that share tags, summed for whole batches of users among goods that were checked to be few.

Spark spreads and orders the users' tag rows; a task sums the matches of a batch of users with one
``bincount`` and hands on a list a user, which Spark writes out as rows. No pair is exchanged.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

# Workers get these functions with the job, whether or not the package is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Users times goods that a task holds at once.
CELLS = 1_000_000


def carriers(tags: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    """One row per goods from its rows of (keys, tag, weight), with its tags in ``entries``."""
    return tags.filter(F.col("tag").isNotNull()).groupBy(*keys).agg(
        F.collect_list(F.struct("tag", F.col(weight).cast("bigint").alias("weight"))).alias("entries"))


def tag_index(entries: pa.ChunkedArray) -> dict:
    """Per tag the places of the goods that carry it, and how often they do."""
    lists = pa.concat_arrays(entries.chunks) if entries.num_chunks else pa.array([], entries.type)
    flat = lists.flatten()
    tags = flat.field("tag").dictionary_encode()
    code = tags.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(code, kind="stable")
    return {"names": tags.dictionary, "starts": np.searchsorted(code[order], np.arange(len(tags.dictionary) + 1)),
            "places": pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)[order],
            "weights": flat.field("weight").to_numpy(zero_copy_only=False)[order].astype("float64")}


def numbered(table: pa.Table) -> np.ndarray:
    """Numbers 0, 1, ... of the users of rows that are ordered by user."""
    users = pa.concat_arrays(table["user_id"].chunks)
    return pc.dictionary_encode(users, null_encoding="encode").indices.to_numpy(zero_copy_only=False)


def whole_users(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches ordered by user cut anew so that no user is split, with the users' numbers."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        number = numbered(table)
        last = int(np.searchsorted(number, number[-1]))
        if last:
            yield table.slice(0, last), number[:last]
        held = table.slice(last)
    if held is not None:
        yield held, numbered(held)


def summed(rows: pa.Table, user: np.ndarray, n_users: int, index: dict, width: int, rest: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Sums of users x goods and where there is a match; tags that no goods carries count for the place ``rest``."""
    code = pc.fill_null(pc.index_in(rows["tag"], value_set=index["names"]), -1).to_numpy()
    n = pc.fill_null(rows["n"], 0).to_numpy().astype("float64")
    hit = code >= 0
    first = index["starts"][code[hit]]
    length = index["starts"][code[hit] + 1] - first
    # Positions first, first + 1, ... of every row, one after the other.
    at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length - first, length)
    cell = np.repeat(user[hit].astype("int64") * width, length) + index["places"][at]
    weight = np.repeat(n[hit], length) * index["weights"][at]
    if rest is not None:
        cell = np.concatenate([cell, user[~hit].astype("int64") * width + rest])
        weight = np.concatenate([weight, n[~hit]])
    sums = np.bincount(cell, weight, n_users * width).reshape(n_users, width)
    met = sums > 0 if (weight > 0).all() else np.bincount(cell, minlength=n_users * width).reshape(n_users, width) > 0
    return sums, met


def ranks_among(met: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Dense ranks by level (from 1) of each user's matches, in the order of ``np.nonzero(met)``."""
    user, at = np.nonzero(met)
    present = np.zeros((len(met), int(level.max(initial=0)) + 1), bool)
    present[user, level[at]] = True
    return present.cumsum(axis=1, dtype="int32")[user, level[at]]


def tag_matches(known: DataFrame, goods: DataFrame, per_user: Sequence[str], per_goods: Sequence[str], total: str,
                least: int | None = None, rest: bool = False, tops: Mapping[str, str] | None = None, k: int = 0) -> DataFrame:
    """The columns per user and goods of every pair that shares a tag, and ``total``, the sum of n x weight over the shared tags.

    ``known`` has user_id, tag, n; ``goods`` comes from ``carriers``, must have passed a size check and is sent to
    every task. Only totals of at least ``least`` stay. With ``rest`` a user's other tags count for a null goods.
    ``tops`` names ranks and the goods columns by which a user's pairs are ranked (descending, nulls last, dense);
    pairs within k in any of them stay.
    """
    tops = dict(tops or {})
    if rest:
        blank = {c: F.lit(None).cast(goods.schema[c].dataType) for c in goods.columns}
        goods = goods.withColumn("_rest", F.lit(False)).unionByName(known.sparkSession.range(1).select(
            *[value.alias(c) for c, value in blank.items()], F.lit(True).alias("_rest")))
    # The goods are few, so a window over all of them is bounded.
    levels = [F.dense_rank().over(Window.orderBy(F.col(c).desc_nulls_last())).alias(f"_{name}") for name, c in tops.items()]
    table = goods.select("*", *levels).toArrow()
    facts = {"index": tag_index(table["entries"]), "goods": table.select(list(per_goods)).combine_chunks(),
             "levels": {name: table[f"_{name}"].to_numpy() for name in tops},
             "rest": int(np.argmax(table["_rest"].to_numpy())) if rest else None}
    sent = known.sparkSession.sparkContext.broadcast(facts)
    own, width = list(dict.fromkeys(["user_id", *per_user])), max(1, table.num_rows)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts = sent.value
        step = max(1, CELLS // width)
        for rows, number in whole_users(batches):
            for low in range(0, int(number[-1]) + 1, step):
                begin, end = np.searchsorted(number, [low, low + step])
                some, user = rows.slice(begin, end - begin), number[begin:end] - low
                n_users = int(user[-1]) + 1
                sums, met = summed(some, user, n_users, facts["index"], width, facts["rest"])
                if least is not None:
                    met &= sums >= least
                ranks = {name: ranks_among(met, level) for name, level in facts["levels"].items()}
                who, at = np.nonzero(met)
                if ranks:
                    kept = np.any([r <= k for r in ranks.values()], axis=0)
                    who, at, ranks = who[kept], at[kept], {name: r[kept] for name, r in ranks.items()}
                offsets = pa.array(np.searchsorted(who, np.arange(n_users + 1)), pa.int32())
                heads = some.select(own).take(pa.array(np.searchsorted(user, np.arange(n_users)))).combine_chunks()
                found = facts["goods"].take(pa.array(at))
                values = [*(pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type) for c in found.columns),
                          pa.array(np.rint(sums[who, at]).astype("int64")), *(pa.array(r, pa.int32()) for r in ranks.values())]
                lists = [pa.ListArray.from_arrays(offsets, v) for v in values]
                yield pa.RecordBatch.from_arrays([*(pa.concat_arrays(c.chunks) for c in heads.columns), *lists],
                                                 names=[*own, *per_goods, total, *ranks])

    listed = {**{c: goods.schema[c].dataType for c in per_goods}, total: LongType(), **{name: IntegerType() for name in tops}}
    schema = StructType([*(known.schema[c] for c in own), *(StructField(c, ArrayType(t)) for c, t in listed.items())])
    tasks = int(known.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = known.select(*own, "tag", "n").repartition(tasks, "user_id").sortWithinPartitions("user_id")
    first, *others = listed
    written = spread.mapInArrow(match, schema).select(*own, *others, F.posexplode(first).alias("_at", first))
    return written.select(*own, first, *[F.get(c, F.col("_at")).alias(c) for c in others])
