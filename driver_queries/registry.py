"""Where queries and their checking SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from agrimill.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Parquet tables of one folder, opened by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def wide(self, name: str, *columns: str) -> DataFrame:
        """Some columns of a table; where the scan has fewer splits than there are cores, their rows are dealt over all cores.

        For costly expressions on small files only: a table that fills the cores is not shuffled.
        """
        narrow = getattr(self, name).select(*columns)
        cores = self.spark.sparkContext.defaultParallelism
        splits = narrow._jdf.queryExecution().toRdd().getNumPartitions()
        return narrow.repartition(cores) if splits < cores else narrow


def query(sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under its own name."""

    def register(f: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return f(Tables(configure(spark), folder))

        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register
