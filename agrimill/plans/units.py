"""Dimensions, units, packagings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from agrimill.functions import text
from agrimill.operators import keyed
from agrimill.operators.reshape import union_families
from agrimill.specs import TableSpec

_FACTOR = "decimal(25,10)"
DIMENSIONS = TableSpec(
    "units", "master_dimensions", "reference_name string, symbol string, translation_id string",
    pk=("reference_name",), not_null=("symbol", "translation_id"),
)
UNITS = TableSpec(
    "units", "master_units",
    f"reference_name string, dimension string, symbol string, a {_FACTOR}, d {_FACTOR}, b {_FACTOR}, translation_id string",
    pk=("reference_name",), not_null=("dimension", "symbol", "translation_id"),
)
PACKAGINGS = TableSpec(
    "units", "master_packagings", f"reference_name string, capacity {_FACTOR}, capacity_unit string, translation_id string",
    pk=("reference_name",), not_null=("capacity", "capacity_unit", "translation_id"),
)
SPECS = [DIMENSIONS, UNITS, PACKAGINGS]


def _translation_id(scope: str):
    return text.join_skip_null(F.lit(f"{scope}_"), "reference_name").alias("translation_id")


def dimensions(raw: DataFrame) -> DataFrame:
    return DIMENSIONS.align(raw.select("reference_name", "symbol", _translation_id("dimensions")))


def units(raw: DataFrame) -> DataFrame:
    factors = [F.col(c).cast(_FACTOR).alias(c) for c in ("a", "d", "b")]
    return UNITS.align(raw.select("reference_name", "dimension", "symbol", *factors, _translation_id("units")))


def packagings(raw: DataFrame) -> DataFrame:
    return PACKAGINGS.align(
        raw.select("reference_name", F.col("capacity").cast(_FACTOR).alias("capacity"), "capacity_unit", _translation_id("packagings"))
    )


def unit_translations(raw: Mapping[str, DataFrame]) -> DataFrame:
    return union_families([keyed.translations(raw[n], n) for n in ("dimensions", "units", "packagings") if n in raw])
