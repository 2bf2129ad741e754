"""Sharded and incremental file sets."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from agrimill.sources.delimited import read_delimited


def union_shards(
    spark: SparkSession, paths: Sequence[str], shard_patterns: Mapping[str, str], sep: str = ","
) -> DataFrame:
    """Files of one layout read in one scan; shard keys are cut out of the file name.

    ``shard_patterns`` maps a column to a pattern with one group.
    """
    df = read_delimited(spark, paths, sep=sep)
    return df.withColumns({k: F.regexp_extract(F.input_file_name(), p, 1) for k, p in shard_patterns.items()})


def union_tables(shards: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Tables of like layout as one, the shard name kept as data; absent columns are NULL."""
    tagged = [df.withColumn(key, F.lit(name)) for name, df in shards.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def file_listing(spark: SparkSession, path: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    """Files with size, time and SHA-256 of their content, hashed where they are read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"),
        F.sha2("content", 256).alias("sha256"),
    )


# Files above this size are hashed by lines, as one value of a table cannot hold them.
WHOLE_FILE = 1 << 30


def collect_new(
    spark: SparkSession, path: str, manifest: DataFrame, pattern: str | None = None, whole_file: int = WHOLE_FILE
) -> DataFrame:
    """Files to collect: path, size, modified and hash of those that neither stamp nor content shows as collected.

    Files the manifest knows by path, size and time are never opened. Of the others those up to ``whole_file`` bytes are
    hashed in one piece; larger ones are read in splits by many tasks, and their hash is made of the count and two sums
    of hashes of their lines, whose order it does not see. Only the names of files with a new stamp come to the driver.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    stamps = reader.load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    known = manifest.select("path", "size", "modified")
    fresh = stamps.join(known, ["path", "size", "modified"], "left_anti").collect()
    hashed = []
    small = [_literal(r["path"]) for r in fresh if r["size"] <= whole_file]
    if small:
        hashed.append(file_listing(spark, small))
    large = [r for r in fresh if r["size"] > whole_file]
    if large:
        # The scan names files in their encoded form.
        encoded = [(spark._jvm.org.apache.hadoop.fs.Path(r["path"]).toUri().toString(), *r) for r in large]
        listed = spark.createDataFrame(encoded, "_file string, path string, size long, modified timestamp")
        lines = spark.read.option("lineSep", "\n").text([_literal(r["path"]) for r in large])
        sums = [F.sum(F.xxhash64(F.lit(seed), "value").cast("decimal(38,0)")) for seed in (1, 2)]
        digest = F.sha2(F.concat_ws(",", F.count(F.lit(1)), *sums), 256)
        by_file = lines.groupBy(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/").alias("_file")).agg(digest.alias("sha256"))
        hashed.append(listed.join(by_file, "_file", "left").drop("_file"))
    if not hashed:
        return file_listing(spark, path, pattern).limit(0)
    return new_files(reduce(DataFrame.unionByName, hashed), manifest)


def _literal(path: str) -> str:
    """A path whose special characters stand for themselves where patterns are read."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def new_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files not collected before: the key is unknown, or size, time and hash all moved on.

    A file is known when its key is in the manifest and either size and time or
    the content hash are the same.
    """
    m = manifest.select(
        F.col("path").alias("_path"), F.col("size").alias("_size"), F.col("modified").alias("_modified"),
        F.col("sha256").alias("_sha256"),
    )
    same = (F.col("path") == F.col("_path")) & (
        ((F.col("size") == F.col("_size")) & (F.col("modified") == F.col("_modified")))
        | (F.col("sha256") == F.col("_sha256"))
    )
    return files.join(m, same, "left_anti")
