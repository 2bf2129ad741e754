"""Checks on tables: state, keys, references, verdict."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from agrimill.specs import TableSpec


def table_states(spark: SparkSession, tables: Mapping[str, DataFrame], expected: Sequence[str]) -> DataFrame:
    """``table_name``, ``n_rows`` and state ``ok``, ``empty`` or ``missing`` of each expected table."""
    wanted = spark.createDataFrame([(n,) for n in expected], "table_name string")
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(name)) for name, df in tables.items()
    ]
    if counts:
        counted = reduce(DataFrame.unionByName, counts)
        joined = wanted.join(counted, "table_name", "left")
    else:
        joined = wanted.withColumn("n_rows", F.lit(None).cast("bigint"))
    state = F.when(F.col("n_rows").isNull(), "missing").when(F.col("n_rows") == 0, "empty").otherwise("ok")
    return joined.select("table_name", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), state.alias("state"))


def orphans(df: DataFrame, column: str, target: DataFrame, target_column: str) -> DataFrame:
    """Key values without a target row, and how many rows carry each.

    Rows are counted per value first, so only distinct values are shuffled into
    the anti join and a hot value costs one row.
    """
    values = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    keys = target.select(F.col(target_column).alias("value"))
    return values.join(keys, "value", "left_anti")


def orphan_report(tables: Mapping[str, DataFrame], specs: Sequence[TableSpec]) -> DataFrame:
    """One row per declared reference: distinct orphan values and rows carrying them."""
    parts = []
    for spec in specs:
        for column, (target, target_column) in spec.fks.items():
            if spec.name not in tables or target not in tables:
                continue
            found = orphans(tables[spec.name], column, tables[target], target_column)
            parts.append(
                found.agg(
                    F.count(F.lit(1)).alias("n_values"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")
                ).select(
                    F.lit(spec.source).alias("source"), F.lit(spec.name).alias("table_name"),
                    F.lit(column).alias("column_name"), F.lit(target).alias("target"), "n_values", "n_rows",
                )
            )
    if not parts:
        raise ValueError("no declared reference between the given tables")
    return reduce(DataFrame.unionByName, parts)


def key_violations(df: DataFrame, pk: Sequence[str], not_null: Sequence[str] = ()) -> DataFrame:
    """Rows of ``rule``, ``n``: duplicate keys and NULLs in required columns."""
    parts = []
    if pk:
        dup = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1)
        parts.append(dup.agg(F.count(F.lit(1)).alias("n")).select(F.lit("duplicate:" + ",".join(pk)).alias("rule"), "n"))
    required = list(dict.fromkeys([*pk, *not_null]))
    if required:
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        stacked = F.explode(F.array(*[F.struct(F.lit(f"null:{c}").alias("rule"), F.col(c).alias("n")) for c in required]))
        parts.append(nulls.select(stacked.alias("v")).select("v.*"))
    return reduce(DataFrame.unionByName, parts)


def verdict(results: DataFrame) -> DataFrame:
    """One row per source: valid when every one of its checks is ok."""
    return results.groupBy("source").agg(F.bool_and("ok").alias("valid"))


def checks(
    spark: SparkSession, tables: Mapping[str, DataFrame], specs: Sequence[TableSpec]
) -> DataFrame:
    """Every check on a table set: ``source``, ``table_name``, ``rule``, ``n``, ``ok``.

    A reference to a table that is not given cannot hold: it is not ok, with ``n`` NULL.
    """
    source_of = {s.name: s.source for s in specs}
    parts = []
    states = table_states(spark, {k: v for k, v in tables.items() if k in source_of}, list(source_of))
    sources = spark.createDataFrame(list(source_of.items()), "table_name string, source string")
    parts.append(
        states.join(F.broadcast(sources), "table_name").select(
            "source", "table_name", F.concat(F.lit("state:"), "state").alias("rule"), F.col("n_rows").alias("n"),
            (F.col("state") == "ok").alias("ok"),
        )
    )
    for spec in specs:
        if spec.name in tables and (spec.pk or spec.required):
            v = key_violations(tables[spec.name], spec.pk, spec.required)
            parts.append(
                v.select(F.lit(spec.source).alias("source"), F.lit(spec.name).alias("table_name"), "rule", "n", (F.col("n") == 0).alias("ok"))
            )
        for column, (target, target_column) in spec.fks.items():
            if spec.name in tables:
                if target in tables:
                    bad = orphans(tables[spec.name], column, tables[target], target_column)
                    n = bad.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"))
                else:
                    n = spark.createDataFrame([(None,)], "n bigint")
                parts.append(
                    n.select(
                        F.lit(spec.source).alias("source"), F.lit(spec.name).alias("table_name"),
                        F.lit(f"reference:{column}->{target}").alias("rule"), "n", F.coalesce(F.col("n") == 0, F.lit(False)).alias("ok"),
                    )
                )
    return reduce(DataFrame.unionByName, parts)
