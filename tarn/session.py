"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split skewed join partitions even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # streamed sessions of a hot key are merged on the map side first
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(master: str | None = None, app: str = "tarn", **extra: str) -> SparkSession:
    """A session with UTC time, ANSI arithmetic and adaptive execution."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, "spark.ui.enabled": "false", **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; a cluster
    without the setting is an error, because a machine-local path would lose
    data with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    current = context.getCheckpointDir()
    if current is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tarn-"))
        current = context.getCheckpointDir()
    return current.rstrip("/")


# what ``stage`` has written in this session and nobody has dropped
_STAGED: list[str] = []


def staged_paths() -> list[str]:
    """Folders that ``stage`` has written so far, oldest first."""
    return list(_STAGED)


def drop_staged(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged folders. No frame that reads them may be evaluated afterwards."""
    for path in paths:
        if path in _STAGED:
            _STAGED.remove(path)
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/tarn/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Used where one result feeds several plans, or where a long lineage must be
    cut; the files survive the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_database(spark: SparkSession, label: str) -> str:
    """A fresh database whose tables live in the shared scratch folder."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, label)}'")
    return name
