"""Plant-protection catalogue: products, usages, risks, crop sets, permits."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DayTimeIntervalType, MapType

from agrimill.functions import dates, labels, lookups, numbers, phrases, text
from agrimill.operators import aggregates, joins, keyed
from agrimill.session import stored
from agrimill.specs import LABEL, TableSpec

CROPSETS = TableSpec(
    "phytosanitary", "registered_phytosanitary_cropsets",
    f"id string, name string, label {LABEL}, crop_names array<string>, crop_labels {LABEL}, record_checksum int",
    pk=("id",), not_null=("name",),
)
PRODUCTS = TableSpec(
    "phytosanitary", "registered_phytosanitary_products",
    "id int, reference_name string, name string, other_names array<string>, natures array<string>, "
    "active_compounds array<string>, france_maaid string, mix_category_codes array<int>, "
    "in_field_reentry_delay interval day to second, state string, started_on date, stopped_on date, "
    "allowed_mentions map<string,boolean>, restricted_mentions string, operator_protection_mentions string, "
    "firm_name string, product_type string, record_checksum int",
    pk=("id",), not_null=("reference_name", "name", "france_maaid", "state"),
)
USAGES = TableSpec(
    "phytosanitary", "registered_phytosanitary_usages",
    f"id string, lib_court int, product_id int, ephy_usage_phrase string, crop {LABEL}, crop_label_fra string, "
    f"species array<string>, target_name {LABEL}, target_name_label_fra string, description {LABEL}, treatment {LABEL}, "
    "dose_quantity decimal(19,4), dose_unit string, dose_unit_name string, dose_unit_factor float, "
    "pre_harvest_delay interval day to second, pre_harvest_delay_bbch int, applications_count int, "
    "applications_frequency interval day to second, development_stage_min int, development_stage_max int, "
    "usage_conditions string, untreated_buffer_aquatic int, untreated_buffer_arthropod int, untreated_buffer_plants int, "
    "decision_date date, state string, extract_spray_volume_max_quantity string, extract_spray_volume_max_unit string, "
    "spray_volume_max_quantity decimal(19,4), spray_volume_max_unit string, spray_volume_max_unit_name string, "
    "spray_volume_max_dose_quantity decimal(19,4), spray_volume_max_dose_unit string, "
    "spray_volume_max_dose_unit_name string, record_checksum int",
    pk=("id",), not_null=("product_id", "ephy_usage_phrase", "state"),
)
RISKS = TableSpec(
    "phytosanitary", "registered_phytosanitary_risks",
    "product_id int, risk_code string, risk_phrase string, record_checksum int",
    pk=("product_id", "risk_code"), not_null=("risk_phrase",),
)
SYMBOLS = TableSpec("phytosanitary", "registered_phytosanitary_symbols", "id string, symbol_name string", pk=("id",))
TARGET_LINKS = TableSpec(
    "phytosanitary", "registered_phytosanitary_target_name_to_pfi_targets",
    "ephy_name string, pfi_id int, pfi_name string, default_pfi_treatment_type_id string", pk=("ephy_name",),
)
SPECS = [CROPSETS, PRODUCTS, USAGES, RISKS, SYMBOLS, TARGET_LINKS]

# Record tags of the catalogue in loading order; types that pass attributes on.
RECORD_TAGS = ("PPP", "adjuvant", "produit-mixte")
DONOR_TYPES = ("PPP", "ADJUVANT", "PRODUIT-MIXTE")
OPERATOR_PROTECTION = "Protection de l'opérateur"
NOT_FARMING = "Usages non agricoles"
SPRAY_PHRASINGS = ("bouillie : ", "bouillie de ", "bouillie: ")

_REF = "struct<`_VALUE`:string,`_lib-court`:string>"
_QUANTITY = "struct<`_VALUE`:string,`_unite`:string>"
_USAGE = (
    f"struct<`_date-decision`:string,id:string,`etat-usage`:string,`identifiant-usage`:{_REF},"
    f"`date-fin-utilisation`:string,`dose-retenue`:{_QUANTITY},`delai-avant-recolte-jour`:string,"
    "`delai-avant-recolte-bbch`:string,`nombre-apport-max`:string,`stade-cultural-min`:string,"
    "`stade-cultural-max`:string,`condition-emploi`:string,`ZNT-aquatique`:string,"
    "`ZNT-arthropodes-non-cibles`:string,`ZNT-plantes-non-cibles`:string>"
)
CATALOGUE_SCHEMA = (
    "`numero-AMM` string, `nom-produit` string, `autres-noms` struct<`autre-nom`:array<struct<nom:string>>>, "
    "fonctions struct<ref:array<string>>, `composition-integrale` struct<`substances-actives`:struct<"
    f"`substance-active`:array<struct<substance:string,`teneur-SA-pure`:{_QUANTITY}>>>>, "
    "`conditions-emploi-produit` struct<`condition-emploi-produit`:array<struct<`condition-emploi-categorie`:string,"
    "description:string>>>, `etat-produit` string, `date-premiere-autorisation` string, "
    f"usages struct<usage:array<{_USAGE}>>, `mentions-autorisees` struct<ref:array<string>>, "
    "`restrictions-usage` struct<ref:array<string>>, titulaire string, `type-produit` string, "
    f"`classement-CLP` struct<`phrases-risque`:struct<ref:array<{_REF}>>>, "
    f"`classement-DSD` struct<`phrases-risque`:struct<ref:array<{_REF}>>>"
)


def _known(catalogue: DataFrame) -> DataFrame:
    """Catalogue records with a number, and the position of their tag in the loading order."""
    tags = F.create_map(*[F.lit(v) for i, t in enumerate(RECORD_TAGS) for v in (t, i)])
    return catalogue.withColumns({
        "_maaid": F.trim("numero-AMM"), "_rank": F.coalesce(F.try_element_at(tags, F.col("record_tag")), F.lit(len(RECORD_TAGS))),
    }).filter(F.col("_maaid") != "N/A")


def _refs(path: str) -> Column:
    none = F.array().cast(f"array<{_REF}>")
    return F.coalesce(F.col(path), none)


def _risk_refs() -> Column:
    """Hazard references kept: all of one scheme, only codes starting with R of the older one."""
    clp = _refs("`classement-CLP`.`phrases-risque`.ref")
    dsd = F.filter(_refs("`classement-DSD`.`phrases-risque`.ref"), lambda r: F.startswith(r["_lib-court"], F.lit("R")))
    return F.concat(clp, dsd)


def products(catalogue: DataFrame) -> DataFrame:
    """One product per number, the first record in loading order."""
    c = F.col
    state = lookups.decode_strict(c("etat-produit"), lookups.PRODUCT_STATES, "product state")
    compounds = F.transform(
        F.filter("composition-integrale.substances-actives.substance-active", lambda s: s["substance"].isNotNull()),
        lambda s: F.concat_ws(" ", s["substance"], s["teneur-SA-pure"]["_VALUE"], s["teneur-SA-pure"]["_unite"]),
    )
    guard = F.filter(
        "conditions-emploi-produit.condition-emploi-produit",
        lambda d: d["condition-emploi-categorie"] == OPERATOR_PROTECTION,
    )
    ends = F.filter(F.transform("usages.usage", lambda u: u["date-fin-utilisation"]), lambda d: d.isNotNull())
    codes = F.transform(_risk_refs(), lambda r: r["_lib-court"])
    rows = _known(catalogue).select(
        c("_maaid").cast("int").alias("id"), text.slug_with_id(c("_maaid"), c("nom-produit")).alias("reference_name"),
        c("nom-produit").alias("name"),
        labels.null_if_empty(F.transform("autres-noms.autre-nom", lambda n: n["nom"])).alias("other_names"),
        labels.null_if_empty(c("fonctions.ref")).alias("natures"),
        F.coalesce(compounds, F.array().cast("array<string>")).alias("active_compounds"), c("_maaid").alias("france_maaid"),
        aggregates.mix_categories_of(codes).alias("mix_category_codes"),
        dates.hours_interval(aggregates.reentry_hours_of(codes)).alias("in_field_reentry_delay"), state.alias("state"),
        dates.day_first_repaired(c("date-premiere-autorisation")).alias("started_on"),
        F.when(state == "withdrawn", dates.latest_day(ends)).alias("stopped_on"),
        labels.flags(c("mentions-autorisees.ref"), lookups.MENTION_FLAGS).alias("allowed_mentions"),
        labels.piped(c("restrictions-usage.ref")).alias("restricted_mentions"),
        F.get(guard, 0)["description"].alias("operator_protection_mentions"), c("titulaire").alias("firm_name"),
        c("type-produit").alias("product_type"), c("_rank"),
    )
    # Maps cannot be part of the tie-break hash; the rank and name decide first.
    one = keyed.first_wins(rows, ["id"], ["_rank", "reference_name"])
    return PRODUCTS.align(one.drop("_rank"))


def risks(catalogue: DataFrame) -> DataFrame:
    """Hazard phrases per product, first phrase of a code."""
    rows = _known(catalogue).select(
        F.col("_maaid").cast("int").alias("product_id"), "_rank", F.posexplode_outer(_risk_refs()).alias("_pos", "_ref")
    ).filter(F.col("_ref").isNotNull()).select(
        "product_id", F.col("_ref._lib-court").alias("risk_code"), F.col("_ref._VALUE").alias("risk_phrase"), "_rank", "_pos"
    )
    one = keyed.first_wins(rows, ["product_id", "risk_code"], ["_rank", "_pos"])
    return RISKS.align(one.drop("_rank", "_pos"))


def usages(catalogue: DataFrame) -> DataFrame:
    """One row per authorised usage; non-farming crops are left out."""
    # Outer explode and a test after it: the inner form would parse a catalogue held as text twice.
    every = _known(catalogue).select(F.col("_maaid").cast("int").alias("product_id"), F.explode_outer("usages.usage").alias("u"))
    u = every.filter(F.col("u").isNotNull())

    def col(name: str) -> Column:
        return F.col(f"u.`{name}`")

    crop, treatment, target = phrases.usage_phrase(F.col("ephy_usage_phrase"))
    rows = u.select(
        col("id").alias("id"), F.col("u.`identifiant-usage`.`_lib-court`").cast("int").alias("lib_court"), "product_id",
        F.col("u.`identifiant-usage`.`_VALUE`").alias("ephy_usage_phrase"),
        F.col("u.`dose-retenue`.`_VALUE`").cast("decimal(19,4)").alias("dose_quantity"),
        F.col("u.`dose-retenue`.`_unite`").alias("dose_unit_name"),
        dates.days_interval(F.coalesce(col("delai-avant-recolte-jour").cast("int"), F.lit(3))).alias("pre_harvest_delay"),
        col("delai-avant-recolte-bbch").cast("int").alias("pre_harvest_delay_bbch"),
        col("nombre-apport-max").cast("int").alias("applications_count"),
        col("stade-cultural-min").cast("int").alias("development_stage_min"),
        col("stade-cultural-max").cast("int").alias("development_stage_max"), col("condition-emploi").alias("usage_conditions"),
        numbers.int_of_float_text(col("ZNT-aquatique")).alias("untreated_buffer_aquatic"),
        numbers.int_of_float_text(col("ZNT-arthropodes-non-cibles")).alias("untreated_buffer_arthropod"),
        numbers.int_of_float_text(col("ZNT-plantes-non-cibles")).alias("untreated_buffer_plants"),
        dates.day_first_repaired(col("_date-decision")).alias("decision_date"),
        lookups.decode_strict(col("etat-usage"), lookups.USAGE_STATES, "usage state").alias("state"),
    )
    named = rows.withColumns({
        "crop_label_fra": phrases.clean_crop(crop), "target_name_label_fra": phrases.clean_target(target),
        "treatment": labels.label_or_null(F.nullif(treatment, F.lit(""))), "species": F.array(F.lit("plant")),
    }).filter(F.col("crop_label_fra") != NOT_FARMING)
    labelled = named.withColumns({
        "crop": labels.label_or_null(F.col("crop_label_fra")),
        "target_name": labels.label_or_null(F.col("target_name_label_fra")),
    })
    return USAGES.align(lookups.with_dose_unit(labelled, "dose_unit_name"))


def with_frequency(usage_rows: DataFrame, extract: DataFrame) -> DataFrame:
    """Sets the application interval from the delimited extract, on six keys where NULL equals NULL.

    ``tade_cultural_max_bbch`` is how the extract itself spells that header.
    """
    c = F.col
    donors = extract.filter(
        c("intervalle_minimum_entre_applications_jour").isNotNull() & (c("etat_usage") != "Retrait")
    ).select(
        c("numero_amm").cast("int").alias("product_id"), c("identifiant_usage").alias("ephy_usage_phrase"),
        c("stade_cultural_min_bbch").cast("int").alias("development_stage_min"),
        c("tade_cultural_max_bbch").cast("int").alias("development_stage_max"),
        c("nombre_max_d_application").cast("int").alias("applications_count"), c("condition_emploi").alias("_condition"),
        c("intervalle_minimum_entre_applications_jour").cast("int").alias("_days"),
    )
    keys = [
        "product_id", "ephy_usage_phrase", "development_stage_min", "development_stage_max", "applications_count", "_condition"
    ]
    rows = usage_rows.withColumn("_condition", text.flatten_sentence(c("usage_conditions")))
    hit = joins.null_safe_update(rows, donors, keys, "_days", ["_days"])
    value = F.coalesce(dates.days_interval(c("_days")), c("applications_frequency"))
    return USAGES.align(hit.withColumn("applications_frequency", value).drop("_days", "_condition"))


def with_spray_volume(usage_rows: DataFrame) -> DataFrame:
    """Largest spraying volume named in the conditions, as quantity and unit."""
    quantity, unit = text.capture_quantity_unit(F.col("usage_conditions"), SPRAY_PHRASINGS)
    return usage_rows.withColumns({"extract_spray_volume_max_quantity": quantity, "extract_spray_volume_max_unit": unit})


def permits(raw: DataFrame) -> DataFrame:
    """Parallel-trade permits: one row per permit with all its product names."""
    name = text.strip_spaces_tabs(F.col("nom_du_produit_importe"))
    french = text.strip_spaces_tabs(F.col("produit_de_reference_francais"))
    grouped = raw.groupBy("nom_du_produit", "n_permis", "detenteur_pcp", "n_amm_de_reference_francais").agg(
        aggregates.distinct_array(name).alias("other_names"), aggregates.distinct_text(french).alias("other_names_fra")
    )
    ident = F.coalesce("n_amm_de_reference_francais", "n_permis")
    return grouped.withColumn("reference_name", text.slug(F.concat_ws("", ident, F.lit(" "), "nom_du_produit")))


def with_permits(product_rows: DataFrame, permit_rows: DataFrame) -> DataFrame:
    """Permits with a French reference become products; a known product takes over their names.

    Afterwards every product carries the attributes of the original product with
    the same authorisation number.
    """
    c = F.col
    incoming = permit_rows.filter(c("n_amm_de_reference_francais").isNotNull()).select(
        c("n_permis").cast("int").alias("id"), "reference_name", c("nom_du_produit").alias("name"), "other_names",
        c("n_amm_de_reference_francais").alias("france_maaid"), F.lit("inherited").alias("state"),
        c("detenteur_pcp").alias("firm_name"), F.lit("PCP").alias("product_type"),
    )
    one = keyed.first_wins(incoming, ["id"], ["name", "firm_name"])
    merged = keyed.upsert_columns(product_rows, PRODUCTS.align(one), ["id"], ["other_names"])
    shared = [
        "natures", "active_compounds", "mix_category_codes", "in_field_reentry_delay", "started_on", "allowed_mentions",
        "operator_protection_mentions",
    ]
    return PRODUCTS.align(joins.propagate(merged, "france_maaid", c("product_type").isin(*DONOR_TYPES), shared, ["id"]))


def cropsets(raw: DataFrame) -> DataFrame:
    return CROPSETS.align(
        raw.select(
            F.col("n").alias("id"), "name", labels.label(F.col("label_fr")).alias("label"),
            labels.list_literal(F.col("crop_names")).alias("crop_names"), labels.label(F.col("crop_labels_fr")).alias("crop_labels"),
        )
    )


def symbols(raw: DataFrame) -> DataFrame:
    return SYMBOLS.align(raw.select(F.col("mention_danger").alias("id"), F.col("code_pictogramme").alias("symbol_name")))


def target_links(raw: DataFrame) -> DataFrame:
    return TARGET_LINKS.align(
        raw.select("ephy_name", F.col("pfi_id").cast("int").alias("pfi_id"), "pfi_name", "default_pfi_treatment_type_id")
    )


def with_species(usage_rows: DataFrame, cropset_rows: DataFrame, varieties: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Species of a usage from crop sets, nomenclature and exceptions, in that precedence."""
    plain = usage_rows.drop("species")
    return USAGES.align(joins.species_chain(plain, cropset_rows, varieties, exceptions))


def _canonical(field) -> Column:
    """Text form of a column for the row checksum."""
    col = F.col(field.name)
    if isinstance(field.dataType, (ArrayType, MapType)):
        return F.to_json(col)
    if isinstance(field.dataType, DayTimeIntervalType):
        return col.cast("string")
    return col.cast("string")


def with_checksum(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Row checksum over every column but itself, in declared order."""
    cols = [_canonical(f) for f in spec.schema.fields if f.name != "record_checksum"]
    return df.withColumn("record_checksum", numbers.md5_prefix_int(*cols))


# Inputs of a load besides the catalogue itself.
LOAD_INPUTS = ("usages", "parallel_trade", "cropsets", "varieties", "exceptions", "symbols", "target_links")


def load(catalogue: DataFrame, raw: Mapping[str, DataFrame], store: bool = True) -> dict[str, DataFrame]:
    """All plant-protection tables, by table name, from a parsed catalogue and the files around it.

    ``raw`` holds what is there of LOAD_INPUTS: the delimited extract of the usages, parallel-trade permits, crop sets,
    nomenclature varieties (``name``, ``label``), species exceptions (``crop_label``, ``species``), hazard symbols and
    target links. A missing file leaves its step out, and its own table; without crop sets, varieties and exceptions
    alike, every species is the default. Four tables carry a row checksum, taken last. The catalogue feeds three
    tables: it is parsed once and written to the shared folder unless ``store`` is off; so are products and usages
    before their checksums, which would repeat every expression of a column.
    """
    unknown = sorted(set(raw) - set(LOAD_INPUTS))
    if unknown:
        raise ValueError(f"unknown inputs {unknown}")
    records = stored(catalogue, "catalogue") if store else catalogue
    product_rows, usage_rows = products(records), usages(records)
    if "usages" in raw:
        usage_rows = with_frequency(usage_rows, raw["usages"])
    if "parallel_trade" in raw:
        product_rows = with_permits(product_rows, permits(raw["parallel_trade"]))
    tables = {}
    if "cropsets" in raw:
        tables[CROPSETS.name] = cropsets(raw["cropsets"])
    if {"cropsets", "varieties", "exceptions"} & set(raw):
        none = records.sparkSession.createDataFrame([], f"name string, label {LABEL}, crop_label string, species string")
        usage_rows = with_species(usage_rows, tables.get(CROPSETS.name, none), raw.get("varieties", none), raw.get("exceptions", none))
    usage_rows = with_spray_volume(usage_rows)
    if store:
        product_rows, usage_rows = stored(product_rows, "products"), stored(usage_rows, "usages")
    tables |= {PRODUCTS.name: product_rows, USAGES.name: usage_rows, RISKS.name: risks(records)}
    tables = {spec.name: spec.align(with_checksum(tables[spec.name], spec)) for spec in (CROPSETS, PRODUCTS, USAGES, RISKS) if spec.name in tables}
    if "symbols" in raw:
        tables[SYMBOLS.name] = symbols(raw["symbols"])
    if "target_links" in raw:
        tables[TARGET_LINKS.name] = target_links(raw["target_links"])
    return tables


def legacy_mix_categories(phrase_rows: DataFrame, risk_rows: DataFrame) -> DataFrame:
    """Mix category per product from two code tables (``product_id``, ``code``)."""
    return aggregates.legacy_mix_category(phrase_rows, risk_rows, "product_id", "code")
