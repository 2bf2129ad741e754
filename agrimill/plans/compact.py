"""Compact extracts for small devices, each written as one JSON array over part files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from agrimill.functions.labels import in_locale
from agrimill.operators.joins import keep_known
from agrimill.plans.protection import PRODUCTS


def productions(rows: DataFrame) -> DataFrame:
    return rows.select("reference_name", "specie", "agroedi_crop_code", "season")


def products(rows: DataFrame) -> DataFrame:
    """All plant-protection products, every column."""
    return PRODUCTS.align(rows)


def species(nomenclature: DataFrame, seeds: DataFrame) -> DataFrame:
    """Nomenclature species that occur in the seed register, ordered by French name."""
    named = nomenclature.select("name", in_locale(F.col("label")).alias("fra"), in_locale(F.col("label"), "eng").alias("eng"))
    return keep_known(named, seeds, "name", "id_specie").dropDuplicates().orderBy("fra")


def fertilizers(variants: DataFrame) -> DataFrame:
    return variants.filter(F.col("category") == "fertilizer")


def smallest_doses(usages: DataFrame) -> DataFrame:
    """Smallest dose per product among doses in litres."""
    litres = usages.filter(F.col("dose_unit").like("liter%"))
    return litres.groupBy("product_id").agg(F.min("dose_quantity").alias("dose")).orderBy("product_id")


def extracts(tables: Mapping[str, DataFrame], nomenclature: DataFrame) -> dict[str, DataFrame]:
    """The five extracts by file name, from release tables by table name."""
    return {
        "production_natures": productions(tables["master_productions"]),
        "phytosanitary_products": products(tables["registered_phytosanitary_products"]),
        "species": species(nomenclature, tables["registered_seed_varieties"]),
        "fertilizers": fertilizers(tables["master_variants"]),
        "phytosanitary_doses": smallest_doses(tables["registered_phytosanitary_usages"]),
    }
