"""Numbers held in text, and small arithmetic, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def decimal_comma(col: Column, precision: int = 20, scale: int = 2) -> Column:
    """``12,345`` to 12.35; text that is no number becomes NULL (see ``rejected``)."""
    return F.round(F.replace(col, F.lit(","), F.lit(".")).try_cast("decimal(38,10)"), scale).cast(
        f"decimal({precision},{scale})"
    )


def rejected(raw: Column, parsed: Column) -> Column:
    """True where a value was given but did not parse; use it to quarantine rows."""
    return raw.isNotNull() & parsed.isNull()


def leading_price(col: Column, thousands: bool = False) -> Column:
    """Price text such as ``€1,234.50`` to a number.

    The plain form reads the leading number of what is left after dropping all
    but digits, ``^``, comma and dot, so it stops at a comma and gives 0.0 when
    nothing leads. ``thousands=True`` drops the commas first.
    """
    kept = F.regexp_replace(col, "[^0-9^,.]", "")
    if thousands:
        kept = F.replace(kept, F.lit(","), F.lit(""))
    lead = F.regexp_extract(kept, r"^(\d+(\.\d+)?|\.\d+)", 0)
    return F.when(col.isNotNull(), F.coalesce(F.nullif(lead, F.lit("")).cast("double"), F.lit(0.0)))


def leading_float(col: Column) -> Column:
    """Number a cell starts with, decimal comma allowed; anything else is 0.0."""
    lead = F.regexp_extract(F.replace(F.trim(col), F.lit(","), F.lit(".")), r"^[+-]?(\d+(\.\d+)?|\.\d+)([eE][+-]?\d+)?", 0)
    return F.coalesce(F.nullif(lead, F.lit("")).cast("double"), F.lit(0.0))


def leading_int(col: Column) -> Column:
    """Whole number a cell starts with; anything else is 0."""
    return leading_float(col).cast("int")


def int_of_float_text(col: Column) -> Column:
    """``"5.0"`` to 5, cutting decimals toward zero."""
    return col.cast("double").cast("int")


def md5_prefix_int(*cols: Column) -> Column:
    """First 32 bits of the MD5 of the concatenated columns, read as a signed int."""
    digest = F.md5(F.concat_ws("", *cols))
    unsigned = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.when(unsigned >= F.lit(2**31), unsigned - F.lit(2**32)).otherwise(unsigned).cast("int")
