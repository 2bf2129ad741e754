"""Dates, timestamps and intervals held in text, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def day_first(col: Column) -> Column:
    """``31/12/2020`` to a date."""
    return F.to_date(col, "d/M/yyyy")


def day_first_short(col: Column, pivot: int = 70) -> Column:
    """``31/12/20`` or ``31/12/2020`` to a date; two-digit years below the pivot are 20xx."""
    year = F.element_at(F.split(col, "/"), 3).cast("int")
    full = F.when(F.length(F.element_at(F.split(col, "/"), 3)) > 2, year).otherwise(
        F.when(year < pivot, year + 2000).otherwise(year + 1900)
    )
    return F.make_date(full, F.element_at(F.split(col, "/"), 2).cast("int"), F.element_at(F.split(col, "/"), 1).cast("int"))


def compact_day(col: Column) -> Column:
    """``20201231`` to a date."""
    return F.to_date(col, "yyyyMMdd")


def iso_day(col: Column) -> Column:
    """``2020-12-31`` to a date."""
    return F.to_date(col, "yyyy-MM-dd")


def first_of_month(year: Column, month: Column) -> Column:
    """Year and month, as text or number, to the first day of that month."""
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))


def repair_year(col: Column, wrong: int = 16, right: int = 2016) -> Column:
    """Dates of the year 16, a known typing error, moved to 2016."""
    return F.when(F.year(col) == wrong, F.make_date(F.lit(right), F.month(col), F.dayofmonth(col))).otherwise(col)


def day_first_repaired(col: Column) -> Column:
    """``day_first`` with the year repair; also accepts the year as 16 or 0016."""
    parts = F.split(col, "/")
    d = F.make_date(parts[2].cast("int"), parts[1].cast("int"), parts[0].cast("int"))
    return repair_year(d)


def hour_stamp(col: Column) -> Column:
    """``2020123123`` to a timestamp without zone."""
    return F.to_timestamp_ntz(col, F.lit("yyyyMMddHH"))


def years_interval(col: Column) -> Column:
    return F.make_ym_interval(col.cast("int"), F.lit(0))


def months_interval(n: Column) -> Column:
    return F.make_ym_interval(F.lit(0), n.cast("int"))


def days_interval(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"), F.lit(0), F.lit(0), F.lit(0).cast("decimal(18,6)"))


def hours_interval(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"), F.lit(0), F.lit(0).cast("decimal(18,6)"))


def months_of(interval: Column) -> Column:
    """Year-month interval as a count of months (drivers cannot collect the type)."""
    return F.extract(F.lit("YEAR"), interval) * 12 + F.extract(F.lit("MONTH"), interval)


def latest_day(days: Column) -> Column:
    """Latest date in an array of ``31/12/2020`` texts, NULL for none."""
    return F.array_max(F.transform(days, day_first))
