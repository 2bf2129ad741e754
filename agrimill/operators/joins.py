"""Joins.

No join here carries a broadcast hint on a DataFrame argument: Spark broadcasts
a side when its measured size is under ``spark.sql.autoBroadcastJoinThreshold``
and shuffles otherwise, and adaptive execution splits hot keys of the shuffled
form. Sides that must be unique are reduced with a map-side aggregate first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import MapType

from agrimill.functions.labels import in_locale, list_literal, replace_first
from agrimill.operators.keyed import first_wins


def hashable(df: DataFrame) -> list[str]:
    """Columns a hash can be taken of (maps cannot)."""
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with at least ``hot_rows`` rows: at most rows / hot_rows of them."""
    return df.groupBy(*on).count().filter(F.col("count") >= hot_rows).select(*on)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    hot_rows: int | None = None,
    salts: int = 32,
    extra: Column | None = None,
) -> DataFrame:
    """Equi-join (inner or left) that spreads the hot keys of the left side.

    Rows of a hot key get a salt from their own content, so a lost task gives
    them the same salt again; the few right rows of that key are repeated once
    per salt. The list of hot keys is bounded by rows / hot_rows, which is what
    makes it safe to broadcast. With ``hot_rows=None`` nothing is salted and
    adaptive execution does the splitting.
    """
    shared = [c for c in left.columns if c in right.columns and c not in on]
    if shared:
        raise ValueError(f"columns on both sides: {shared}")
    keys = list(on)
    if hot_rows is not None:
        hot = F.broadcast(hot_keys(left, on, hot_rows).withColumn("_hot", F.lit(True)))
        salt = F.pmod(F.xxhash64(*hashable(left)), F.lit(salts)).cast("int")
        left = left.join(hot, keys, "left").withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(0)).drop("_hot")
        every = F.sequence(F.lit(0), F.lit(salts - 1))
        right = (
            right.join(hot, keys, "left")
            .withColumn("_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0)))))
            .drop("_hot")
        )
        keys = [*keys, "_salt"]
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_r_{k}"))
    if extra is not None:
        cond = cond & extra
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys], "_salt")


def region_fan_out(df: DataFrame, zones: DataFrame, zone_col: str, upper: bool = True) -> DataFrame:
    """One row per department of the row's region; rows of an unknown region are dropped.

    ``zones`` has the columns ``department`` and ``region``.
    """
    key = F.upper(F.col(zone_col)) if upper else F.col(zone_col)
    z = zones.select(F.col("department").alias("department_zone"), F.col("region").alias("_region"))
    return df.join(z, key == F.col("_region"), "inner").drop("_region")


def null_safe_update(
    df: DataFrame, donors: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]
) -> DataFrame:
    """Left join where NULL keys match NULL keys; sets ``value`` where a donor matches.

    Several donors of one key are reduced to the first in ``order``.
    """
    one = first_wins(donors.select(*dict.fromkeys([*keys, value, *order])), keys, order).select(
        *[F.col(k).alias(f"_d_{k}") for k in keys], F.col(value).alias("_d_value"), F.lit(True).alias("_d_hit")
    )
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_d_{k}"))
    joined = df.join(one, cond, "left")
    own = F.col(value) if value in df.columns else F.lit(None)
    return joined.withColumn(value, F.when(F.col("_d_hit"), F.col("_d_value")).otherwise(own)).drop(
        *[f"_d_{k}" for k in keys], "_d_value", "_d_hit"
    )


def update_from(
    df: DataFrame, source: DataFrame, on: str, columns: Sequence[str], source_key: str | None = None
) -> DataFrame:
    """Overwrite columns by the matching source row; rows without a match keep theirs.

    A matching row overwrites with NULL too. The source must be unique by key.
    """
    src = source.select(
        F.col(source_key or on).alias("_s_key"), *[F.col(c).alias(f"_s_{c}") for c in columns], F.lit(True).alias("_s_hit")
    )
    out = df.join(src, F.col(on) == F.col("_s_key"), "left")
    for c in columns:
        own = F.col(c) if c in df.columns else F.lit(None)
        out = out.withColumn(c, F.when(F.col("_s_hit"), F.col(f"_s_{c}")).otherwise(own))
    return out.drop("_s_key", "_s_hit", *[f"_s_{c}" for c in columns])


def fill_from(df: DataFrame, source: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    """Like ``update_from``, but a NULL in the source leaves the value alone."""
    src = source.select(F.col(on).alias("_s_key"), *[F.col(c).alias(f"_s_{c}") for c in columns])
    out = df.join(src, F.col(on) == F.col("_s_key"), "left")
    for c in columns:
        own = F.col(c) if c in df.columns else F.lit(None)
        out = out.withColumn(c, F.coalesce(F.col(f"_s_{c}"), own))
    return out.drop("_s_key", *[f"_s_{c}" for c in columns])


def propagate(
    df: DataFrame, group: str, is_donor: Column, columns: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Copy columns from the first donor row of a group onto every row of the group."""
    donors = first_wins(df.filter(is_donor).select(*dict.fromkeys([group, *columns, *order])), [group], order)
    return update_from(df, donors, group, columns)


def join_on_label(df: DataFrame, text_col: str, labelled: DataFrame, label_col: str, locale: str = "fra") -> DataFrame:
    """Inner join of a text column with one locale of a label map."""
    return df.join(labelled, F.col(text_col) == in_locale(F.col(label_col), locale), "inner")


def lookup_first(df: DataFrame, lookup: DataFrame, on: str, value: str, order: Sequence[str]) -> DataFrame:
    """Scalar look-up: the first value by ``order``, NULL without a match."""
    one = first_wins(lookup.select(*dict.fromkeys([on, value, *order])), [on], order).select(on, value)
    return df.join(one, on, "left")


def keep_known(df: DataFrame, other: DataFrame, on: str, other_key: str) -> DataFrame:
    """Rows whose key occurs on the other side (semi join); a hot key there is one row after the map-side distinct."""
    return df.join(other.select(F.col(other_key).alias(on)).distinct(), on, "left_semi")


def drop_known(df: DataFrame, other: DataFrame, on: str, other_key: str) -> DataFrame:
    """Rows whose key does not occur on the other side (anti join); distinct there as in ``keep_known``."""
    return df.join(other.select(F.col(other_key).alias(on)).distinct(), on, "left_anti")


def species_chain(
    usages: DataFrame,
    cropsets: DataFrame,
    varieties: DataFrame,
    exceptions: DataFrame,
    *,
    crop: str = "crop_label_fra",
    exception_species: str = "species",
    default: str = "plant",
) -> DataFrame:
    """Species list of a usage by crop label, from three look-ups.

    The crop set's list; where that leaves the default, the nomenclature name
    replaces its first element; an exception overrides both. Each look-up is
    reduced to one row per label.
    """
    sets = cropsets.select(in_locale(F.col("label")).alias(crop), F.col("name").alias("_set"))
    names = varieties.select(in_locale(F.col("label")).alias(crop), F.col("name").alias("_variety"))
    exc = exceptions.select(F.col("crop_label").alias(crop), F.col(exception_species).alias("_exception"))
    out = (
        usages.join(first_wins(sets, [crop], ["_set"]), crop, "left")
        .join(first_wins(names, [crop], ["_variety"]), crop, "left")
        .join(first_wins(exc, [crop], ["_exception"]), crop, "left")
    )
    chosen = F.coalesce(F.when(F.col("_set").isNotNull(), list_literal(F.col("_set"))), F.array(F.lit(default)))
    chosen = F.when(
        F.col("_variety").isNotNull() & (chosen == F.array(F.lit(default))), replace_first(chosen, F.col("_variety"))
    ).otherwise(chosen)
    chosen = F.coalesce(F.when(F.col("_exception").isNotNull(), list_literal(F.col("_exception"))), chosen)
    return out.withColumn("species", chosen).drop("_set", "_variety", "_exception")
