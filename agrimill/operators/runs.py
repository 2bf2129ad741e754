"""Sheet-shaped data: header lines, runs of equal lines, pivot of cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _with_previous(df: DataFrame, keys: list[str], at: str, value: str, width: int, levels: int) -> DataFrame:
    """Adds ``_prev``, the value of the row before in the order of ``at``; NULL where there is none.

    Rows look back inside blocks of ``width`` numbers. What the block before ends with is found the same way in a
    table of one row per block, ``levels`` times over, so a task holds ``width`` rows whatever the group's size.
    """
    if levels == 0:
        return df.withColumn("_prev", F.lag(value).over(Window.partitionBy(*keys).orderBy(at)))
    block = f"_block{levels}"
    tagged = df.withColumn(block, F.floor(F.col(at) / width))
    ends = tagged.groupBy(*keys, block).agg(F.max_by(value, at).alias(value))
    carried = _with_previous(ends, keys, block, value, width, levels - 1).select(
        *keys, block, F.col("_prev").alias(value), F.lit(0).alias("_real")
    )
    # The carried value goes in front of its block as a row of its own, so no join is needed.
    lines = tagged.withColumn("_real", F.lit(1)).unionByName(carried, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, block).orderBy("_real", at)
    return lines.withColumn("_prev", F.lag(value).over(inside)).filter(F.col("_real") == 1).drop(block, "_real")


def run_heads(
    df: DataFrame, group: Sequence[str], row: str, footprint: Column, chunk: int = 100_000, levels: int = 2
) -> DataFrame:
    """Lines whose footprint differs from the line before in the same group.

    One huge group is spread over many tasks of ``chunk`` row numbers each; with the two levels given, the one window
    that spans a group sees a row per ``chunk`` squared row numbers.
    """
    looked = _with_previous(df.withColumn("_foot", F.struct(footprint.alias("v"))), list(group), row, "_foot", chunk, levels)
    head = F.col("_prev").isNull() | ~F.col("_prev.v").eqNullSafe(F.col("_foot.v"))
    return looked.filter(head).select(*df.columns)


def sheet_rows(cells: DataFrame, columns: Sequence[str], group: Sequence[str] = ("sheet",)) -> DataFrame:
    """Long cells ``(sheet, row, col, value)`` to one row per sheet line; of repeated cells the smallest value."""
    return cells.groupBy(*group, "row").pivot("col", list(columns)).agg(F.min("value"))


def with_header_line(
    rows: DataFrame, group: Sequence[str], header_row: int, names: dict[str, str], first_line: int
) -> DataFrame:
    """Cells of the header line put on every line from ``first_line`` on.

    The header is one row per sheet, joined back; nothing gathers a sheet.
    """
    header = rows.filter(F.col("row") == header_row).select(
        *group, *[F.col(cell).alias(name) for cell, name in names.items()]
    )
    return rows.filter(F.col("row") >= first_line).join(header, list(group), "inner")
