"""Row reshaping: segment unpivot and unions of families."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def unpivot_segments(
    df: DataFrame, segments: Sequence[tuple[str, Mapping[str, Column]]], suffix: str = "suffix"
) -> DataFrame:
    """One row per segment in one scan: ``(suffix, {column: expression})`` for each.

    Every segment must give the same columns.
    """
    rows = [
        F.struct(F.lit(name).alias(suffix), *[c.alias(n) for n, c in values.items()]) for name, values in segments
    ]
    return df.withColumn("_segment", F.explode(F.array(*rows))).select(*df.columns, "_segment.*")


def union_families(families: Sequence[DataFrame]) -> DataFrame:
    """All rows of several sources; columns a source lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), families)
