"""Productions, crop codes, yields and production prices."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from agrimill.functions import dates, lookups, numbers, text
from agrimill.operators import joins, keyed
from agrimill.operators.reshape import union_families
from agrimill.session import stored
from agrimill.specs import TableSpec

_PRODUCTION = {"production": ("master_productions", "reference_name")}
_SPECIE = {"specie": ("master_taxonomy", "reference_name")}
PRODUCTIONS = TableSpec(
    "productions", "master_productions",
    "reference_name string, activity_family string, specie string, usage string, started_on date, stopped_on date, "
    "agroedi_crop_code string, season string, life_duration interval year to month, idea_botanic_family string, "
    "idea_specie_family string, idea_output_family string, color string, translation_id string",
    pk=("reference_name",), not_null=("activity_family", "started_on", "stopped_on", "translation_id"),
)
START_STATES = TableSpec(
    "productions", "master_production_start_states", "production string, year int, key string",
    not_null=("production", "year", "key"), fks=_PRODUCTION,
)
SUBSIDY_CODES = TableSpec(
    "productions", "master_crop_production_cap_codes",
    "cap_code string, cap_label string, production string, cap_precision string, cap_category string, is_seed boolean, year int",
    pk=("cap_code", "production", "year"), not_null=("cap_label",), fks=_PRODUCTION,
)
LAND_FEATURES = TableSpec(
    "productions", "master_crop_production_cap_sna_codes",
    "reference_name string, nature string, parent string, translation_id string",
    pk=("reference_name",), not_null=("nature", "translation_id"),
)
TREATMENT_CODES = TableSpec(
    "productions", "master_crop_production_tfi_codes",
    "tfi_code string, tfi_label string, production string, tfi_crop_group string, campaign int",
    not_null=("tfi_code", "tfi_label", "campaign"), fks=_PRODUCTION,
)
YIELDS = TableSpec(
    "productions", "master_production_yields",
    "department_zone string, specie string, production string, yield_value decimal(8,2), yield_unit string, campaign int",
    not_null=("department_zone", "specie", "production", "yield_value", "yield_unit", "campaign"), fks={**_PRODUCTION, **_SPECIE},
)
PRICES = TableSpec(
    "productions", "master_production_prices",
    # Durations mix months and days, which one interval column cannot hold: both parts are kept.
    "department_zone string, started_on date, nature string, price_duration_months int, price_duration_days int, specie string, "
    "waiting_price decimal(8,2), final_price decimal(8,2), currency string, price_unit string, product_output_specie string, "
    "production_reference_name string, campaign int, organic boolean, label string",
    not_null=(
        "department_zone", "started_on", "specie", "waiting_price", "final_price", "currency", "price_unit", "product_output_specie"
    ),
    fks=_SPECIE,
)
SPECS = [PRODUCTIONS, START_STATES, SUBSIDY_CODES, LAND_FEATURES, TREATMENT_CODES, YIELDS, PRICES]

# Production families; the first one has all columns.
FAMILIES = ("crop_productions", "animal_productions", "auxiliary_productions", "processing_productions", "service_productions")
CROP_ONLY = ("agroedi_crop_code", "season", "idea_botanic_family", "idea_specie_family", "idea_output_family", "color")
MISSING_PRICE = "S."


def productions(raw: Mapping[str, DataFrame]) -> DataFrame:
    """The production families as one table; crop columns are NULL elsewhere."""
    families = []
    for name in FAMILIES:
        if name not in raw:
            continue
        extra = [F.col(c) for c in CROP_ONLY if name == "crop_productions" and c in raw[name].columns]
        families.append(
            raw[name].select(
                "reference_name", "activity_family", "specie", "usage", dates.day_first_short(F.col("started_on")).alias("started_on"),
                dates.day_first_short(F.col("stopped_on")).alias("stopped_on"),
                dates.years_interval(F.col("life_duration")).alias("life_duration"), *extra,
                text.join_skip_null(F.lit(f"{name}_"), "reference_name").alias("translation_id"),
            )
        )
    return PRODUCTIONS.align(union_families(families))


def production_translations(raw: Mapping[str, DataFrame]) -> DataFrame:
    return union_families([keyed.translations(raw[n], n) for n in (*FAMILIES, "sna_codes") if n in raw])


def start_states(raw: DataFrame) -> DataFrame:
    return START_STATES.align(raw.select("production", F.col("year").cast("int").alias("year"), "key"))


def subsidy_codes(raw: DataFrame) -> DataFrame:
    """Codes of all years read as shards; ``year`` is the shard key."""
    return SUBSIDY_CODES.align(
        raw.select(
            "cap_code", "cap_label", "production", "cap_precision", "cap_category",
            lookups.flag_is_one(F.col("is_seed")).alias("is_seed"), F.col("year").cast("int").alias("year"),
        )
    )


def land_features(raw: DataFrame) -> DataFrame:
    return LAND_FEATURES.align(
        raw.select("reference_name", "nature", "parent", text.join_skip_null(F.lit("sna_codes_"), "reference_name").alias("translation_id"))
    )


def treatment_codes(raw: DataFrame, campaign: int = 2020) -> DataFrame:
    return TREATMENT_CODES.align(raw.select("tfi_code", "tfi_label", "production", "tfi_crop_group", F.lit(campaign).alias("campaign")))


def yields(raw: DataFrame, zones: DataFrame) -> DataFrame:
    """Yields of a region given to each of its departments."""
    rows = raw.select(
        "zone", "specie", "production", numbers.decimal_comma(F.col("yield_value"), 8, 2).alias("yield_value"), "yield_unit",
        F.col("campaign").cast("int").alias("campaign"),
    )
    return YIELDS.align(joins.region_fan_out(rows, _measured(zones), "zone", upper=False).drop("zone"))


def _measured(zones: DataFrame) -> DataFrame:
    """Zones stored, so that Spark knows their size: what it guesses for a join behind them may make it broadcast the rows instead."""
    return stored(zones.select("department", "region"), "zones")


def _feed(
    raw: DataFrame, zones: DataFrame, nature: str | None, started: Column, months: int, days: int, campaign: Column | None,
    organic: Column | None = None,
) -> DataFrame:
    rows = raw.select(
        "zone", F.lit(nature).cast("string").alias("nature"), started.alias("started_on"), F.lit(months).alias("price_duration_months"),
        F.lit(days).alias("price_duration_days"), "specie", numbers.decimal_comma(F.col("waiting_price"), 8, 2).alias("waiting_price"),
        numbers.decimal_comma(F.col("final_price"), 8, 2).alias("final_price"), F.lit("EUR").alias("currency"), "price_unit",
        "product_output_specie", F.col("production_label").alias("label"),
        *([campaign.cast("int").alias("campaign")] if campaign is not None else []),
        *([organic.cast("boolean").alias("organic")] if organic is not None else []),
    )
    return joins.region_fan_out(rows, zones, "zone").drop("zone")


def priced(raw: DataFrame) -> DataFrame:
    """Rows with both prices given; the placeholder ``S.`` counts as missing."""
    both = F.lit(True)
    for c in ("waiting_price", "final_price"):
        both = both & F.col(c).isNotNull() & (F.col(c) != MISSING_PRICE)
    return raw.filter(both)


def production_prices(raw: Mapping[str, DataFrame], zones: DataFrame) -> DataFrame:
    """Farm, futures, shipping and milk prices given to each department of their zone.

    ``crop_prices`` holds the yearly files as shards with the shard's ``campaign``.
    ``milk_cow_prices`` and, optionally, ``meat_prices`` have an ``organic`` flag.
    """
    month = dates.first_of_month(F.col("year"), F.col("month"))
    zones = _measured(zones)
    parts = []
    if "crop_prices" in raw:
        parts.append(_feed(raw["crop_prices"], zones, "farmer_price", month, 1, 0, F.col("campaign")))
    if "crop_matif_price" in raw:
        parts.append(_feed(raw["crop_matif_price"], zones, "matif_price", month, 1, 0, F.col("campaign")))
    if "crop_shipping_price" in raw:
        day = dates.day_first(F.col("started_on"))
        parts.append(_feed(raw["crop_shipping_price"], zones, "shipping_price", day, 0, 1, F.col("campaign")))
    for name in ("milk_cow_prices", "meat_prices"):
        if name in raw:
            parts.append(_feed(priced(raw[name]), zones, None, month, 1, 0, None, F.col("organic")))
    return PRICES.align(union_families(parts))
