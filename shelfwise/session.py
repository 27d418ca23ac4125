"""Session set-up and the shared folder used to cut long plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLUSTER_CONF = {
    # Re-plan joins from measured sizes, merge small reducers, split skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Unions of inputs that AQE re-partitioned differently must not be zipped by partition.
    "spark.sql.unionOutputPartitioning": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "shelfwise", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**CLUSTER_CONF, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def prepared(spark: SparkSession) -> None:
    """Give a session that was built elsewhere the one setting on which the plans' rows depend.

    With it, a union zips partitions that adaptive execution may have dealt out in different ways.
    """
    name = "spark.sql.unionOutputPartitioning"
    if spark.conf.get(name, "false") != CLUSTER_CONF[name]:
        spark.conf.set(name, CLUSTER_CONF[name])


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would lose data with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="shelfwise-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches read one expensive result. The files survive the
    loss of executors, and their sizes let Spark choose joins from real numbers.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/shelfwise/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_enough(df: DataFrame, max_rows: int = 500_000) -> bool:
    """Counts up to ``max_rows`` + 1 rows: may this side be sent to every task?

    Meant for stored or bounded frames, where the count is a cheap scan.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def lineage_cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder, for loops."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
