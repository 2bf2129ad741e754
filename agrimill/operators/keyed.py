"""Keyed dedupe, upsert, update and delete.

"First row wins" is an aggregate (``min_by`` over a total order), not a ranked
window: it combines on the map side, so a key holding a large share of all rows
never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import MapType

from agrimill.session import stored


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in ``order``, ties settled by row content."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order], F.xxhash64(*hashed))
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_first"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def insert_ignore(
    existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """Existing rows plus the first incoming row of each key not there yet."""
    fresh = first_wins(incoming, keys, order)
    if existing is None:
        return fresh
    return existing.unionByName(fresh.join(existing.select(*keys), list(keys), "left_anti"), allowMissingColumns=True)


def upsert_columns(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], update: Sequence[str]
) -> DataFrame:
    """New keys are inserted whole; on a known key only ``update`` is taken over.

    Both sides must be unique by key.
    """
    columns = existing.columns
    old = existing.select(*keys, F.struct(*columns).alias("_old"))
    filled = [F.col(c) if c in incoming.columns else F.lit(None).cast(existing.schema[c].dataType).alias(c) for c in columns]
    new = incoming.select(*keys, F.struct(*filled).alias("_new"))
    both = old.join(new, list(keys), "full_outer")
    known = F.col("_old").isNotNull()
    out = []
    for c in columns:
        kept = F.when(known, F.col(f"_old.{c}")).otherwise(F.col(f"_new.{c}"))
        if c in update:
            kept = F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}"))
        out.append(kept.alias(c))
    return both.select(*out)


def replace_scope(table: DataFrame, scope: str, name: str, fresh: DataFrame) -> DataFrame:
    """Shared table with every row of one scope replaced."""
    kept = table.filter(F.col(scope) != name)
    return kept.unionByName(fresh.withColumn(scope, F.lit(name)), allowMissingColumns=True)


def translations(df: DataFrame, scope: str, key: str = "reference_name") -> DataFrame:
    """Translation rows of one table: ``<scope>_<key>``, French, English."""
    return df.select(
        F.lit(scope).alias("scope"),
        F.concat_ws("", F.lit(f"{scope}_"), F.col(key)).alias("id"),
        F.col("fra"),
        F.col("eng"),
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true (false or NULL)."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "table") -> DataFrame:
    """The rows themselves; fails when a key occurs twice. Runs one job."""
    bad = duplicates(df, keys).limit(3).collect()
    if bad:
        raise ValueError(f"{what}: duplicate key {[r.asDict() for r in bad]}")
    return df


def surrogate_hash(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """64-bit id from content: needs no order and no shuffle."""
    return df.withColumn(name, F.xxhash64(*columns))


def surrogate_dense(df: DataFrame, name: str, order: str, width: int = 1_000_000) -> DataFrame:
    """Ids 1, 2, 3 … in the order of a unique whole-number column.

    Rows are numbered inside value ranges of ``width``, and each range is moved
    up by the count of all ranges before it. Only the range counts are summed in
    one task, not the rows.
    """
    bucket = F.floor(F.col(order) / width)
    tagged = df.withColumn("_bucket", bucket)
    counts = tagged.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(order))
    return (
        tagged.withColumn("_inside", inside)
        .join(offsets, "_bucket")
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_bucket", "_inside", "_before")
    )


def spare_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores after it as it takes to be new in the table."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def number_rows(df: DataFrame, name: str, order: Sequence[Column | str], start: int = 1) -> DataFrame:
    """Number all rows without gaps in a global order, with no window over the table.

    Rows are dealt by ranges of the order and sorted inside them, the table is written to the shared folder with every
    row's place in its range, and each range begins where the counts of the ranges before it end. Only one count per
    range is summed in one task. Rows equal in ``order`` follow each other in the order they are read in and may span
    ranges, so a hot value is no single task; name enough columns where two runs must agree. A column called ``name`` is
    replaced. An empty table stays empty.
    """
    kept = df.drop(name)
    tie, place = spare_name(kept, "_tie"), spare_name(kept, "_place")
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    # Places are (range << 33) + row: what monotonically_increasing_id counts after the sort.
    dealt = kept.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys, tie).sortWithinPartitions(*keys, tie)
    placed = stored(dealt.drop(tie).withColumn(place, F.monotonically_increasing_id()), "numbered")
    part, before = spare_name(placed, "_part"), spare_name(placed, "_before")
    placed = placed.withColumn(part, F.shiftright(F.col(place), 33))
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    offsets = counts.select(part, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias(before))
    inside = F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    # The broadcast has one row for each range: it follows the number of shuffle partitions, not the rows.
    numbered = placed.join(F.broadcast(offsets), part).withColumn(name, (F.col(before) + inside + F.lit(start)).cast("long"))
    return numbered.select(*kept.columns, name)
