"""Article catalogue: categories, natures, variants."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from agrimill.functions import labels, text
from agrimill.operators import joins, keyed
from agrimill.operators.reshape import union_families
from agrimill.specs import TableSpec

CATEGORIES = TableSpec(
    "variants", "master_variant_categories",
    "reference_name string, family string, fixed_asset_account string, fixed_asset_allocation_account string, "
    "fixed_asset_expenses_account string, depreciation_percentage decimal(5,2), purchase_account string, sale_account string, "
    "stock_account string, stock_movement_account string, default_vat_rate decimal(5,2), payment_frequency_value int, "
    "payment_frequency_unit string, pictogram string, translation_id string",
    pk=("reference_name",), not_null=("family", "translation_id"),
)
NATURES = TableSpec(
    "variants", "master_variant_natures",
    "reference_name string, family string, population_counting string, frozen_indicators array<string>, "
    "variable_indicators array<string>, abilities array<string>, variety string, derivative_of string, pictogram string, "
    "translation_id string",
    pk=("reference_name",), not_null=("family", "population_counting", "variety", "translation_id"),
)
VARIANTS = TableSpec(
    "variants", "master_variants",
    "reference_name string, family string, category string, nature string, sub_family string, default_unit string, "
    "target_specie string, specie string, indicators map<string,string>, pictogram string, name_tags array<string>, "
    "translation_id string",
    pk=("reference_name",), not_null=("family", "category", "nature", "default_unit", "translation_id"),
    fks={
        "category": ("master_variant_categories", "reference_name"), "nature": ("master_variant_natures", "reference_name"),
        "target_specie": ("master_taxonomy", "reference_name"), "specie": ("master_taxonomy", "reference_name"),
        "default_unit": ("master_units", "reference_name"),
    },
)
SPECS = [CATEGORIES, NATURES, VARIANTS]

# Unit of each fertilizer measure.
FERTILIZER_MEASURES = {
    "mass_volume_density": "kilogram_per_liter", "nitrogen_concentration": "percent", "phosphorus_concentration": "percent",
    "potassium_concentration": "percent", "sulfur_dioxide_concentration": "percent", "magnesium_concentration": "percent",
    "manganese_concentration": "percent", "calcium_concentration": "percent", "zinc_concentration": "percent",
    "sodium_concentration": "percent", "copper_concentration": "percent",
}


def categories(raw: DataFrame) -> DataFrame:
    c = F.col
    return CATEGORIES.align(
        raw.select(
            "reference_name", "family", "fixed_asset_account", "fixed_asset_allocation_account", "fixed_asset_expenses_account",
            c("depreciation_percentage").cast("decimal(5,2)").alias("depreciation_percentage"),
            c("charge_account").alias("purchase_account"), c("product_account").alias("sale_account"), "stock_account",
            "stock_movement_account", c("default_vat_rate").cast("decimal(5,2)").alias("default_vat_rate"),
            c("payment_frequency_value").cast("int").alias("payment_frequency_value"), "payment_frequency_unit", "pictogram",
            text.join_skip_null(F.lit("categories_"), "reference_name").alias("translation_id"),
        )
    )


def natures(raw: DataFrame) -> DataFrame:
    lists = [labels.list_literal(F.col(c)).alias(c) for c in ("frozen_indicators", "variable_indicators", "abilities")]
    return NATURES.align(
        raw.select(
            "reference_name", "family", "population_counting", *lists, "variety", "derivative_of", "pictogram",
            text.join_skip_null(F.lit("natures_"), "reference_name").alias("translation_id"),
        )
    )


def _farm_indicators(every: bool) -> Column:
    first = labels.indicator(F.col("indicator_1_name"), F.col("indicator_1_value"), F.col("indicator_1_unit"))
    if not every:
        return first
    more = [labels.indicator(F.col(f"indicator_{i}_name"), F.col(f"indicator_{i}_value"), F.col(f"indicator_{i}_unit")) for i in (2, 3)]
    return F.map_concat(first, *more)


def variants(raw: Mapping[str, DataFrame], aliases: DataFrame | None = None, every_indicator: bool = False) -> DataFrame:
    """Eleven article families as one table.

    Farm products keep their first indicator unless ``every_indicator``.
    ``aliases`` (reference_name, tags array) sets the name tags.
    """
    c, lit = F.col, F.lit
    none = labels.empty_map()

    def family(name: str, kind: str, **columns: Column) -> DataFrame | None:
        if name not in raw:
            return None
        base = {
            "reference_name": c("reference_name"), "family": lit(kind), "category": c("category"), "nature": c("nature"),
            "indicators": none, "translation_id": text.join_skip_null(lit("variants_"), "reference_name"),
        }
        return raw[name].select(*[v.alias(k) for k, v in {**base, **columns}.items()])

    unit, target, picture, specie = c("default_unit"), c("target_specie"), c("pictogram"), c("specie")
    families = [
        family(
            "farm_products", "article", sub_family=lit("farm_product"), default_unit=unit, target_specie=target, pictogram=picture,
            indicators=_farm_indicators(every_indicator),
        ),
        family(
            "seeds_and_plants", "article", category=lit("seed_and_plant"), sub_family=lit("seed_and_plant"), default_unit=unit,
            target_specie=target, pictogram=lit("uf989-seed.svg"),
            indicators=labels.indicator_or_default("thousand_grains_mass", c("pmg"), "gram", "50gram"),
        ),
        family(
            "fertilizers", "article", category=lit("fertilizer"), sub_family=lit("fertilizer"), default_unit=unit, target_specie=target,
            pictogram=lit("uf3d7-filter-tilt-shift.svg"), indicators=labels.measures(FERTILIZER_MEASURES),
        ),
        family("other_articles", "article", default_unit=unit, target_specie=target, pictogram=picture),
        family("equipments", "equipment", sub_family=c("sub_family"), default_unit=lit("unity"), pictogram=picture),
        family("services", "service", default_unit=unit, pictogram=picture),
        family("crops", "crop", default_unit=lit("hectare"), specie=specie, pictogram=lit("uf940-seedling-solid.svg")),
        family("animals", "animal", default_unit=lit("unity"), specie=specie, pictogram=picture),
        family(
            "animal_groups", "animal", default_unit=lit("unity"), specie=lit("animal_group"), target_specie=c("derivative_of"),
            pictogram=picture,
            indicators=F.create_map(
                lit("sex "), F.coalesce(c("sex"), lit("")), lit("reproductor "), F.coalesce(c("reproductor"), lit(""))
            ),
        ),
        family("workers", "worker", default_unit=lit("unity"), pictogram=lit("uf0d5-male.svg")),
        family("zones", "zone", default_unit=unit, pictogram=picture),
    ]
    table = VARIANTS.align(union_families([f for f in families if f is not None]))
    if aliases is None:
        return table
    tags = aliases.select("reference_name", labels.lowered_items(c("tags")).alias("name_tags"))
    return VARIANTS.align(joins.update_from(table, tags, "reference_name", ["name_tags"]))


def variant_translations(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Translations of categories, natures and all variant families."""
    scopes = {"categories": "categories", "natures": "natures"}
    return union_families([keyed.translations(df, scopes.get(name, "variants")) for name, df in raw.items()])
