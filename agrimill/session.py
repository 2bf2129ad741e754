"""Session settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results or plan quality and can be set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot join keys even when the next operator reuses the partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Batches handed to Python are bounded by bytes as well as rows: long texts come few at a time.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 26),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "12g") -> SparkSession:
    """Session for tests and benches on one machine; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("agrimill")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", os.environ.get("AGRIMILL_DRIVER_MEMORY", memory))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.files.minPartitionNum", str(cores))
        # Call sites in error messages cost a round trip per column expression. Fixed at start.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Folders made for sessions on one machine, by application: spark.checkpoint.dir cannot be set on a live session.
_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and cut lineage.

    A cluster names it in ``spark.checkpoint.dir``. A session on one machine (``local`` master) without that setting gets
    a temporary folder of its own; any other session without it is refused, as its executors do not share local disks.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _OWN_DIRS:
        _OWN_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="agrimill-")
    return _OWN_DIRS[context.applicationId]


def shared_path(spark: SparkSession, label: str) -> str:
    """A new place in the folder that all executors reach."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, and a lost executor costs nothing.

    Nothing removes the table; whoever runs a finished job may empty the shared folder.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
