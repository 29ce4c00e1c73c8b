"""Session settings and the shared folders that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on.  AQE does three things the operators count
# on: it splits skewed join partitions, turns a shuffle join into a broadcast
# once the measured side is small enough, and coalesces small partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(app: str = "cuadrante", master: str | None = None, **extra: str) -> SparkSession:
    """Build (or fetch) a session with the library's settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach.

    It is the one the cluster names in ``spark.checkpoint.dir``.  Only a local
    master may fall back to a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(root)
        return root
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the application's part of the shared folder; nothing is
    created yet."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def release_scratch(spark: SparkSession) -> None:
    """Delete what the application wrote to its scratch paths.  Call it once the
    results that were read from them have been written elsewhere."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    This cuts the lineage: the rows survive the loss of executors, and later
    reads all see the same values.  Unlike a checkpoint the table is columnar and
    brings its true size, where iterated checkpoints hand on estimates that grow
    with every join until no side of a join looks small.
    """
    spark = df.sparkSession
    path = scratch(spark, "pinned")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
