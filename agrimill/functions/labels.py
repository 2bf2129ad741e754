"""Label objects, indicator objects and lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def label(col: Column, locale: str = "fra") -> Column:
    """One-locale label; a NULL text gives an empty label (concatenating form)."""
    return F.create_map(F.lit(locale), F.coalesce(col, F.lit("")))


def label_or_null(col: Column, locale: str = "fra") -> Column:
    """One-locale label; a NULL text gives a NULL label (strict form)."""
    return F.when(col.isNotNull(), F.create_map(F.lit(locale), col))


def in_locale(col: Column, locale: str = "fra") -> Column:
    """Text of a label map or JSON column in one locale."""
    return F.element_at(col, F.lit(locale))


def json_text(col: Column, path: str) -> Column:
    """Scalar of a JSON text column as text."""
    return F.get_json_object(col, path)


def measures(units: dict[str, str], value: dict[str, Column] | None = None) -> Column:
    """Map of the measures that are present, each value followed by its unit."""
    value = value or {}
    pairs: list[Column] = []
    for name, unit in units.items():
        pairs += [F.lit(name), F.concat(value.get(name, F.col(name)), F.lit(unit))]
    return F.map_filter(F.create_map(*pairs), lambda _k, v: v.isNotNull())


def empty_map() -> Column:
    return F.create_map().cast("map<string,string>")


def indicator(name: Column, value: Column, unit: Column) -> Column:
    """One-indicator map, or an empty map when the indicator has no name."""
    return F.when(
        name.isNotNull(), F.create_map(name, F.concat_ws("", value, unit))
    ).otherwise(empty_map())


def indicator_or_default(name: str, value: Column, unit: str, default: str) -> Column:
    return F.create_map(F.lit(name), F.when(value.isNotNull(), F.concat(value, F.lit(unit))).otherwise(F.lit(default)))


def flags(mentions: Column, names: dict[str, str]) -> Column:
    """Map flag → true for the mentions present; NULL when there is none."""
    pairs: list[Column] = []
    for text, flag in names.items():
        pairs += [F.lit(flag), F.array_contains(F.coalesce(mentions, F.array().cast("array<string>")), text)]
    found = F.map_filter(F.create_map(*pairs), lambda _k, v: v)
    return F.when(F.size(found) > 0, found)


def list_literal(col: Column) -> Column:
    """Comma list to an array of trimmed items; NULL and blank give an empty array."""
    parts = F.transform(F.split(F.coalesce(col, F.lit("")), ","), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def list_or_null(col: Column) -> Column:
    """Comma list to an array, keeping NULL as NULL."""
    return F.when(col.isNotNull(), list_literal(col))


def lowered_items(items: Column) -> Column:
    return F.transform(items, lambda x: F.lower(F.trim(x)))


def null_if_empty(items: Column) -> Column:
    return F.when(F.size(items) > 0, items)


def replace_first(items: Column, value: Column) -> Column:
    """Array with its first element replaced, the rest kept."""
    return F.transform(items, lambda x, i: F.when(i == 0, value).otherwise(x))


def piped(items: Column) -> Column:
    """Items joined by `` | ``; NULL when there is none."""
    return F.when(F.size(items) > 0, F.array_join(items, " | "))
