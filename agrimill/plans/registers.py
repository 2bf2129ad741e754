"""Small registers and nomenclatures."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from agrimill.functions import dates, labels, lookups, text
from agrimill.operators import keyed
from agrimill.operators.reshape import union_families
from agrimill.specs import LABEL, TableSpec

SEED_VARIETIES = TableSpec(
    "seed_varieties", "registered_seed_varieties",
    f"id string, id_specie string, specie_name {LABEL}, specie_name_fra string, variety_name string, registration_date date",
    pk=("id",), not_null=("id_specie",), fks={"id_specie": ("master_taxonomy", "reference_name")},
)
VINE_VARIETIES = TableSpec(
    "vine_varieties", "registered_vine_varieties",
    "id string, short_name string, long_name string, category string, fr_validated boolean, utilities array<string>, "
    "color string, custom_code string",
    pk=("id",), not_null=("short_name", "category"),
)
SIGNS = TableSpec(
    "quality_and_origin_signs", "registered_quality_and_origin_signs",
    f"id int, ida int, geographic_area string, fr_sign string, eu_sign string, product_human_name {LABEL}, "
    "product_human_name_fra string, reference_number string",
    pk=("id",), not_null=("ida",),
)
EDI_CODES = TableSpec(
    "agroedi", "registered_agroedi_codes",
    "repository_id int, reference_id int, reference_code string, reference_label string, scope string, value string",
    not_null=("repository_id", "reference_id"),
)
EDI_CROPS = TableSpec(
    "agroedi", "registered_agroedi_crops", "agroedi_code string, agroedi_name string, production string",
    not_null=("agroedi_code", "agroedi_name"), fks={"production": ("master_productions", "reference_name")},
)
LEGAL_POSITIONS = TableSpec(
    "legal_positions", "master_legal_positions",
    f"code string, name {LABEL}, nature string, country string, insee_code string, fiscal_positions array<string>",
    pk=("code",), not_null=("nature", "country", "insee_code"),
)
USER_ROLES = TableSpec(
    "user_roles", "master_user_roles", "reference_name string, accesses array<string>, translation_id string",
    pk=("reference_name",), not_null=("translation_id",),
)
STAGES = TableSpec(
    "phenological_stages", "master_phenological_stages",
    "id string, bbch_code string, variety string, biaggiolini string, eichhorn_lorenz string, chasselas_date string, "
    f"label {LABEL}, description {LABEL}",
    pk=("id",), not_null=("bbch_code", "variety"),
)
TAXONOMY = TableSpec(
    "taxonomy", "master_taxonomy", "reference_name string, parent string, taxonomic_rank string, translation_id string",
    pk=("reference_name",), not_null=("translation_id",),
)
ACCOUNTS = TableSpec(
    "chart_of_accounts", "master_chart_of_accounts",
    f"id int, reference_name string, previous_reference_name string, fr_pcga string, fr_pcg82 string, name {LABEL}", pk=("id",),
)
TRANSLATIONS = TableSpec(
    "translations", "master_translations", "scope string, id string, fra string, eng string", pk=("id",), not_null=("fra", "eng"),
)
SPECS = [
    SEED_VARIETIES, VINE_VARIETIES, SIGNS, EDI_CODES, EDI_CROPS, LEGAL_POSITIONS, USER_ROLES, STAGES, TAXONOMY, ACCOUNTS, TRANSLATIONS,
]

# Vine varieties known to customs only; wine signs without an area.
CUSTOMS_VARIETIES = {"3309": "Couderc", "9960": "Riparia", "9985": "Binova", "9986": "Borner"}
WINE_SIGNS = {1: "VSIG", 2: "VSIG rouge", 3: "VSIG blanc", 4: "VSIG rosé"}


def seed_varieties(raw: DataFrame, species: DataFrame) -> DataFrame:
    """Register rows whose species code is known."""
    s = species.select(F.col("id").alias("id_espece"), "name", "specie")
    return SEED_VARIETIES.align(
        raw.join(s, "id_espece", "inner").select(
            F.replace("code_gnis", F.lit(" "), F.lit("")).alias("id"), F.col("specie").alias("id_specie"),
            labels.label(F.col("name")).alias("specie_name"), F.col("name").alias("specie_name_fra"), F.col("variete").alias("variety_name"),
            dates.compact_day(F.col("date_d_inscription")).alias("registration_date"),
        )
    )


def vine_varieties(raw: DataFrame, customs: DataFrame, id_prefix: str = "CUS_VARIETY_") -> DataFrame:
    """Varieties with their customs code, plus the ones only customs knows."""
    codes = customs.select(F.col("short_name").alias("name"), "long_name", "custom_code")
    known = raw.join(codes, "name", "left").select(
        "id", F.col("name").alias("short_name"), "long_name", "category", F.lit(True).alias("fr_validated"),
        labels.list_or_null(F.col("utilities")).alias("utilities"), "color", "custom_code",
    )
    extra = raw.sparkSession.createDataFrame(list(CUSTOMS_VARIETIES.items()), "custom_code string, short_name string").select(
        F.concat(F.lit(id_prefix), "custom_code").alias("id"), "short_name", F.col("short_name").alias("long_name"),
        F.lit("rootstock").alias("category"), F.lit(False).alias("fr_validated"), F.array(F.lit("wine")).alias("utilities"), "custom_code",
    )
    return VINE_VARIETIES.align(union_families([known, extra]))


def signs(raw: DataFrame) -> DataFrame:
    """Quality and origin signs, backslashes dropped, plus the wines without an area."""
    product = F.replace("produit", F.lit("\\"), F.lit(""))
    given = raw.select(
        F.col("id_produit").cast("int").alias("id"), F.col("ida").cast("int").alias("ida"), F.col("aire_geographique").alias("geographic_area"),
        F.col("signe_fr").alias("fr_sign"), F.col("signe_ue").alias("eu_sign"), labels.label(product).alias("product_human_name"),
        product.alias("product_human_name_fra"), F.col("reference").alias("reference_number"),
    )
    wines = raw.sparkSession.createDataFrame(list(WINE_SIGNS.items()), "id int, product_human_name_fra string").select(
        "id", F.lit(1).alias("ida"), F.lit("-------").alias("geographic_area"), F.lit("Vin de France -").alias("fr_sign"),
        F.lit("VSIG").alias("eu_sign"), labels.label(F.col("product_human_name_fra")).alias("product_human_name"), "product_human_name_fra",
    )
    return SIGNS.align(union_families([given, wines]))


def edi_codes(raw: DataFrame, scope: str = "scope", value: str = "value") -> DataFrame:
    """Exchange-format dictionary; the two mapping columns are named by the caller."""
    return EDI_CODES.align(
        raw.select(
            F.col("repository_id").cast("int").alias("repository_id"), F.col("reference_id").cast("int").alias("reference_id"),
            "reference_code", "reference_label", F.col(scope).alias("scope"), F.col(value).alias("value"),
        )
    )


def edi_crops(raw: DataFrame) -> DataFrame:
    return EDI_CROPS.align(raw.select("agroedi_code", "agroedi_name", "production"))


def legal_positions(raw: DataFrame) -> DataFrame:
    return LEGAL_POSITIONS.align(
        raw.select(
            "code", labels.label(F.col("name")).alias("name"), "nature", "country", "insee_code",
            labels.list_literal(F.col("fiscal_positions")).alias("fiscal_positions"),
        )
    )


def user_roles(raw: DataFrame) -> DataFrame:
    return USER_ROLES.align(
        raw.select(
            "reference_name", labels.list_literal(F.col("accesses")).alias("accesses"),
            text.join_skip_null(F.lit("user_roles_"), "reference_name").alias("translation_id"),
        )
    )


def stages(vine: DataFrame, crops: DataFrame) -> DataFrame:
    """Growth stages of vine and of other crops."""
    v = vine.select(
        text.join_skip_null("bbch_code", F.lit("-vitis")).alias("id"), "bbch_code", F.lit("vitis").alias("variety"), "biaggiolini",
        "eichhorn_lorenz", "chasselas_date", labels.label(F.col("label_fr")).alias("label"),
        labels.label(F.col("description_fr")).alias("description"),
    )
    c = crops.select(
        text.join_skip_null("bbch", F.lit("-"), "variety").alias("id"), F.col("bbch").alias("bbch_code"), "variety",
        labels.label(F.col("label")).alias("label"),
    )
    return STAGES.align(union_families([v, c]))


def taxonomy(raw: DataFrame) -> DataFrame:
    return TAXONOMY.align(
        raw.select("reference_name", "parent", "taxonomic_rank", text.join_skip_null(F.lit("taxonomy_"), "reference_name").alias("translation_id"))
    )


def accounts(raw: DataFrame) -> DataFrame:
    return ACCOUNTS.align(
        raw.select(
            F.col("n").cast("int").alias("id"), F.col("name").alias("reference_name"), F.col("previous_name").alias("previous_reference_name"),
            "fr_pcga", "fr_pcg82", labels.label(F.col("label_fr")).alias("name"),
        )
    )


def translations(table: DataFrame | None, fresh: dict[str, DataFrame]) -> DataFrame:
    """Shared translations with the given scopes rebuilt, all others kept.

    ``fresh`` maps a scope to its new rows (``keyed.translations``).
    """
    out = table
    for scope, rows in fresh.items():
        rows = rows.select("scope", "id", "fra", "eng")
        out = rows if out is None else keyed.replace_scope(out, "scope", scope, rows.drop("scope"))
    return TRANSLATIONS.align(out)


def normalised_labels(df: DataFrame, label: str, table: DataFrame, out: str) -> DataFrame:
    """Free label to its normal form by a label table (``label``, ``normalized`` and any ratio).

    Serves the treatment category, dose unit and crop tables; an unmatched label gives NULL.
    """
    one = keyed.first_wins(table, ["label"], ["normalized"])
    extra = [F.col(c).alias(f"{out}_{c}") for c in one.columns if c not in ("label", "normalized")]
    return df.join(one.select(F.col("label").alias(label), F.col("normalized").alias(out), *extra), label, "left")


def enrich_states(df: DataFrame, col: str) -> DataFrame:
    """Catalogue state words to the states used in tables."""
    return df.withColumn(col, lookups.decode_strict(F.col(col), lookups.PRODUCT_STATES, "state"))
