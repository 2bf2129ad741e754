"""Picking up new shard files with Structured Streaming."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_new_shards(
    spark: SparkSession,
    path: str,
    schema: str,
    out: str,
    checkpoint: str,
    shard_patterns: Mapping[str, str],
    sep: str = ";",
    max_files: int = 1000,
) -> StreamingQuery:
    """Append the rows of files not seen before to a Parquet table, then stop.

    The checkpoint remembers the files of every finished batch, so a rerun takes
    only new ones and a failed run repeats its last batch without doubling it.
    """
    rows = (
        spark.readStream.schema(schema).option("header", True).option("sep", sep)
        .option("maxFilesPerTrigger", max_files).csv(path)
    )
    tagged = rows.withColumns(
        {k: F.regexp_extract(F.col("_metadata.file_path"), p, 1) for k, p in shard_patterns.items()}
    )
    writer = (
        tagged.writeStream.format("parquet").outputMode("append").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True)
    )
    if shard_patterns:
        writer = writer.partitionBy(*shard_patterns)
    return writer.start()
