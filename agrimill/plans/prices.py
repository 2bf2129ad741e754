"""Prices of inputs and equipment, work contracts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from agrimill.functions import dates, text
from agrimill.operators import aggregates, keyed
from agrimill.operators.reshape import union_families, unpivot_segments
from agrimill.specs import TableSpec

_AMOUNT = "decimal(19,4)"
PRICES = TableSpec(
    "prices", "master_prices",
    f"id string, reference_name string, reference_article_name string, unit_pretax_amount {_AMOUNT}, currency string, "
    "reference_packaging_name string, started_on date, variant_id string, packaging_id string, usage string, "
    f"main_indicator string, main_indicator_unit string, main_indicator_minimal_value {_AMOUNT}, "
    f"main_indicator_maximal_value {_AMOUNT}, working_flow_value {_AMOUNT}, working_flow_unit string, "
    f"threshold_min_value {_AMOUNT}, threshold_max_value {_AMOUNT}",
    pk=("id",),
    not_null=(
        "reference_name", "reference_article_name", "unit_pretax_amount", "currency", "reference_packaging_name", "started_on", "usage"
    ),
    fks={
        "reference_article_name": ("master_variants", "reference_name"),
        "reference_packaging_name": ("master_packagings", "reference_name"),
    },
)
CONTRACTS = TableSpec(
    "prices", "master_doer_contracts",
    "reference_name string, worker_variant string, salaried boolean, contract_end string, "
    "legal_monthly_working_time decimal(8,2), legal_monthly_offline_time decimal(8,2), min_raw_wage_per_hour decimal(8,2), "
    "salary_charges_ratio decimal(8,2), farm_charges_ratio decimal(8,2), translation_id string",
    pk=("reference_name",),
    not_null=(
        "worker_variant", "legal_monthly_working_time", "legal_monthly_offline_time", "min_raw_wage_per_hour",
        "salary_charges_ratio", "farm_charges_ratio", "translation_id",
    ),
)
PROTECTION_PRICES = TableSpec(
    "prices", "master_phytosanitary_prices",
    f"id string, reference_name string, reference_article_name int, unit_pretax_amount {_AMOUNT}, currency string, "
    "reference_packaging_name string, started_on date, usage string",
    pk=("id",),
    not_null=(
        "reference_name", "reference_article_name", "unit_pretax_amount", "currency", "reference_packaging_name", "started_on", "usage"
    ),
    fks={
        "reference_article_name": ("registered_phytosanitary_products", "id"),
        "reference_packaging_name": ("master_packagings", "reference_name"),
    },
)
SPECS = [PRICES, CONTRACTS, PROTECTION_PRICES]

# Id prefix of each cost file.
COST_PREFIXES = {"fertilizer_costs": "FE", "seed_costs": "SE", "farm_product_costs": "F_P", "other_input_costs": "OI"}
LAST_SEGMENT_STRETCH = 1.4


def _costs(raw: DataFrame, prefix: str, article: str) -> DataFrame:
    return raw.select(
        text.join_skip_null(F.lit(prefix), "n").alias("id"), F.col("name").alias("reference_name"),
        F.col(article).alias("reference_article_name"), F.col("price").cast(_AMOUNT).alias("unit_pretax_amount"), "currency",
        F.col("packaging").alias("reference_packaging_name"), dates.day_first(F.col("date")).alias("started_on"),
        F.lit("cost").alias("usage"),
    )


def equipment_prices(raw: DataFrame) -> DataFrame:
    """Four price rows per equipment, in one scan.

    Three are given; the fourth continues the fitted curve to 1.4 times the last
    threshold.
    """
    num = {c: F.col(c).cast(_AMOUNT) for c in raw.columns if c.startswith("segment_")}
    pairs = [
        (F.col(f"segment_{i}_threshold").cast("double"), F.col(f"segment_{i}_cost").cast("double")) for i in (1, 2, 3)
    ]
    last = F.round(F.col("segment_3_threshold").cast("double") * LAST_SEGMENT_STRETCH, 0)
    last_cost = F.round(aggregates.loglog_extrapolate(pairs, last), 2).cast(_AMOUNT)
    zero = F.lit(0).cast(_AMOUNT)
    segments = [
        ("_a", {"cost": num["segment_1_cost"], "low": zero, "high": num["segment_1_threshold"]}),
        ("_b", {"cost": num["segment_2_cost"], "low": num["segment_1_threshold"], "high": num["segment_2_threshold"]}),
        ("_c", {"cost": num["segment_3_cost"], "low": num["segment_2_threshold"], "high": num["segment_3_threshold"]}),
        ("_d", {"cost": last_cost, "low": num["segment_3_threshold"], "high": last.cast(_AMOUNT)}),
    ]
    rows = unpivot_segments(raw, segments)
    return rows.select(
        text.join_skip_null(F.lit("E"), "n", "suffix").alias("id"), text.join_skip_null("equipment", "suffix").alias("reference_name"),
        F.col("equipment").alias("reference_article_name"), F.col("cost").alias("unit_pretax_amount"), F.lit("euro").alias("currency"),
        F.col("unit").alias("reference_packaging_name"), dates.day_first(F.col("date")).alias("started_on"), F.lit("cost").alias("usage"),
        "main_indicator", F.col("indicator_unit").alias("main_indicator_unit"),
        F.col("minimal_value").cast(_AMOUNT).alias("main_indicator_minimal_value"),
        F.col("maximal_value").cast(_AMOUNT).alias("main_indicator_maximal_value"),
        F.col("working_flow_value").cast(_AMOUNT).alias("working_flow_value"), "working_flow_unit",
        F.col("low").alias("threshold_min_value"), F.col("high").alias("threshold_max_value"),
    )


def prices(raw: Mapping[str, DataFrame]) -> DataFrame:
    """All cost files as one price table; ``equipment_costs`` may be missing."""
    families = [_costs(raw[name], prefix, "article") for name, prefix in COST_PREFIXES.items() if name in raw]
    if "equipment_costs" in raw:
        families.append(equipment_prices(raw["equipment_costs"]))
    return PRICES.align(union_families(families))


def protection_prices(raw: DataFrame) -> DataFrame:
    rows = _costs(raw, "PH", "article_id")
    return PROTECTION_PRICES.align(rows.withColumn("reference_article_name", F.col("reference_article_name").cast("int")))


def contracts(raw: DataFrame) -> DataFrame:
    numbers = (
        "legal_monthly_working_time", "legal_monthly_offline_time", "min_raw_wage_per_hour", "salary_charges_ratio", "farm_charges_ratio"
    )
    return CONTRACTS.align(
        raw.select(
            "reference_name", "worker_variant", F.col("salaried").cast("boolean").alias("salaried"), "contract_end",
            *[F.col(c).cast("decimal(8,2)").alias(c) for c in numbers],
            text.join_skip_null(F.lit("worker_contracts_"), "reference_name").alias("translation_id"),
        )
    )


def contract_translations(raw: DataFrame) -> DataFrame:
    return keyed.translations(raw, "worker_contracts")
