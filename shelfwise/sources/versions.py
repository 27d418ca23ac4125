"""Several tables that change together.

Each write puts every table of a group into a folder of its own version and then, in one step,
creates the next file of the group's list of versions, which names the folders. Readers follow
the last file of that list, so they see all tables of a write or none: a job that fails between
two tables, or loses its driver, leaves the former state. Folders of earlier versions stay
readable until ``drop_versions_before``. Of two writers at once one is refused where the store
does not rename onto an existing file, as HDFS does not; elsewhere let one job write a group.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Folder of the list of versions; its name starts like that of files that Spark's readers pass over.
LIST = "_versions"


class TakenVersion(RuntimeError):
    """Another writer has made this version; nothing of the own write is visible."""


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the versions of a group, in order; none for a folder that is not there."""
    path, fs = _path(spark, f"{folder}/{LIST}")
    if not fs.exists(path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    return sorted(int(name) for name in names if name.isdigit())


def tables_of(spark: SparkSession, folder: str, version: int | None = None) -> dict[str, str]:
    """Folder and schema (as text) of every table of a version, the last unless one is given."""
    if version is None:
        known = versions(spark, folder)
        if not known:
            return {}
        version = known[-1]
    path, fs = _path(spark, f"{folder}/{LIST}/{version}")
    stream = fs.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def write_together(frames: Mapping[str, DataFrame], folder: str) -> int:
    """Replace the named tables of a group at once, keep its others; the number of the new version.

    ``TakenVersion`` if another writer came first; the caller may write again.
    """
    spark = next(iter(frames.values())).sparkSession
    known = versions(spark, folder)
    number = known[-1] + 1 if known else 1
    listed = tables_of(spark, folder, known[-1]) if known else {}
    for name, df in frames.items():
        place = f"{folder}/{name}/{number}-{uuid.uuid4().hex}"
        df.hint("rebalance").write.parquet(place)
        listed[name] = {"folder": place, "schema": df.schema.json()}
    _publish(spark, folder, number, listed)
    return number


def _publish(spark: SparkSession, folder: str, number: int, listed: dict) -> None:
    """Write the list aside and give it the name of the version, which only one writer can take."""
    aside, fs = _path(spark, f"{folder}/{LIST}/.{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(json.dumps(listed).encode()))
    finally:
        stream.close()
    final, _ = _path(spark, f"{folder}/{LIST}/{number}")
    if fs.exists(final) or not fs.rename(aside, final):
        fs.delete(aside, False)
        raise TakenVersion(f"version {number} of {folder}")


def read_together(spark: SparkSession, folder: str, version: int | None = None) -> dict[str, DataFrame]:
    """All tables of a group as one write left them; later writes do not change these frames."""
    return {name: spark.read.schema(StructType.fromJson(json.loads(one["schema"]))).parquet(one["folder"])
            for name, one in tables_of(spark, folder, version).items()}


def drop_versions_before(spark: SparkSession, folder: str, version: int) -> None:
    """Forget earlier versions and delete the folders that no later one names."""
    known = versions(spark, folder)
    kept = {one["folder"] for v in known if v >= version for one in tables_of(spark, folder, v).values()}
    for v in (v for v in known if v < version):
        old = {one["folder"] for one in tables_of(spark, folder, v).values()}
        path, fs = _path(spark, f"{folder}/{LIST}/{v}")
        fs.delete(path, False)
        for place in old - kept:
            path, fs = _path(spark, place)
            fs.delete(path, True)
