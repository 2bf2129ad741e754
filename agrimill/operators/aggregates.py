"""Aggregations. All of them combine on the map side before any shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from agrimill.functions.lookups import H_MIX_CATEGORY, R_MIX_CATEGORY, REENTRY_HOURS, decode


def distinct_array(col: Column, keep_null: bool = True) -> Column:
    """Sorted distinct values; a NULL among them comes last, as in PostgreSQL."""
    values = F.array_sort(F.collect_set(col))
    if not keep_null:
        return values
    return F.when(F.count(F.lit(1)) > F.count(col), F.concat(values, F.array(F.lit(None).cast("string")))).otherwise(values)


def distinct_text(col: Column, sep: str = " | ") -> Column:
    """Sorted distinct values as one text, NULL left out."""
    return F.array_join(F.array_sort(F.collect_set(col)), sep)


def min_text(col: Column) -> Column:
    """Minimum of a text column, for few groups of very many rows.

    A plain minimum of texts sorts all rows of a task by group first. Beside a collected set, here an empty one, groups
    are kept in a hash map instead, one row for each; a task that meets more than 128 groups goes back to sorting.
    """
    nothing = F.get(F.collect_set(F.when(F.lit(False), col)), F.lit(0))
    return F.coalesce(F.min(col), nothing)


def min_text_as_int(col: Column, numeric: bool = False) -> Column:
    """Minimum of a text column cast to int. Text order unless ``numeric``."""
    return F.min(col.cast("int")) if numeric else F.min(col).cast("int")


def reentry_hours(codes: Column, table: dict[str, int] = REENTRY_HOURS) -> Column:
    """Longest re-entry delay over the codes of a group; 6 hours at least."""
    return F.greatest(F.lit(6), F.coalesce(F.max(decode(codes, table)), F.lit(6)))


def mix_categories(codes: Column, table: dict[str, int] | None = None) -> Column:
    """Sorted mix categories over the codes of a group; category 1 always is one."""
    table = table or {**H_MIX_CATEGORY, **R_MIX_CATEGORY}
    return F.array_sort(F.array_union(F.array(F.lit(1)), F.collect_set(decode(codes, table))))


def reentry_hours_of(codes: Column, table: dict[str, int] = REENTRY_HOURS) -> Column:
    """Same as ``reentry_hours``, over an array in one row."""
    found = F.array_max(F.transform(codes, lambda c: F.coalesce(decode(c, table), F.lit(6))))
    return F.greatest(F.lit(6), F.coalesce(found, F.lit(6)))


def mix_categories_of(codes: Column, table: dict[str, int] | None = None) -> Column:
    """Same as ``mix_categories``, over an array in one row."""
    table = table or {**H_MIX_CATEGORY, **R_MIX_CATEGORY}
    found = F.filter(F.transform(codes, lambda c: decode(c, table)), lambda c: c.isNotNull())
    return F.array_sort(F.array_union(F.array(F.lit(1)), F.coalesce(found, F.array().cast("array<int>"))))


def legacy_mix_category(
    phrases: DataFrame, risks: DataFrame, key: str, code: str, table: dict[str, int] | None = None
) -> DataFrame:
    """Highest mix category over two code tables; codes may be joined by `` + ``; 1 at least."""
    table = table or {**H_MIX_CATEGORY, **R_MIX_CATEGORY}
    codes = phrases.select(key, code).union(risks.select(key, code)).distinct()
    single = codes.select(key, F.explode_outer(F.split(F.col(code), r" \+ ")).alias("_code"))
    best = F.max(decode(F.col("_code"), table))
    return single.groupBy(key).agg(F.greatest(F.lit(1), F.coalesce(best, F.lit(1))).alias("mix_category_code"))


def loglog_fit(df: DataFrame, keys: Sequence[str], x: Column, y: Column) -> DataFrame:
    """Least squares of ln y on ln x per group: ``slope`` and ``intercept``."""
    lx, ly = F.ln(x), F.ln(y)
    return df.groupBy(*keys).agg(F.regr_slope(ly, lx).alias("slope"), F.regr_intercept(ly, lx).alias("intercept"))


def loglog_at(x: Column, slope: Column, intercept: Column) -> Column:
    """Value of the fitted curve, rounded to four places."""
    return F.round(F.exp(intercept) * F.pow(x, slope), 4)


def loglog_extrapolate(points: Sequence[tuple[Column, Column]], x: Column) -> Column:
    """Fit through the points of one row and value at ``x``: no shuffle needed."""
    n = len(points)
    lx = [F.ln(px) for px, _ in points]
    ly = [F.ln(py) for _, py in points]
    mean_x, mean_y = sum(lx[1:], lx[0]) / n, sum(ly[1:], ly[0]) / n
    cov = sum((a - mean_x) * (b - mean_y) for a, b in zip(lx, ly)) / n
    var = sum((a - mean_x) * (a - mean_x) for a in lx) / n
    slope = cov / F.nullif(var, F.lit(0.0))
    return loglog_at(x, slope, mean_y - slope * mean_x)


def spread(df: DataFrame, keys: Sequence[str], x: Column, y: Column) -> DataFrame:
    """Population mean, variance and covariance per group."""
    return df.groupBy(*keys).agg(
        F.avg(x).alias("mean_x"), F.avg(y).alias("mean_y"), F.var_pop(x).alias("var_x"), F.covar_pop(x, y).alias("cov_xy")
    )


def latest_version(df: DataFrame, col: str) -> DataFrame:
    """One row: the newest ``major.minor.patch`` text of a column."""
    return df.agg(F.max_by(F.col(col), version_rank(F.col(col))).alias(col))


def version_rank(col: Column) -> Column:
    """Sort key of a version text: its three numbers."""
    parts = F.split(col, r"\.")
    return F.struct(*[F.coalesce(F.get(parts, i).try_cast("int"), F.lit(0)) for i in range(3)])
