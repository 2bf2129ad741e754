"""Whole loads: the families, feeds and files of a data set that the single-table queries leave out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from agrimill.operators.reshape import union_families
from agrimill.operators.release import select_release
from agrimill.plans import compact, hydrography, presets, prices, productions, protection, units, variants, workflows
from driver_queries.datasets import book, catalogue, cell, money, txt
from driver_queries.registry import Tables, query
from driver_queries.spatial import pt, quad

c = F.col


def listing(df: DataFrame, kind: str, ident: Column | str, *values: Column | str) -> DataFrame:
    """Rows as text: kind, id, and up to four values."""
    texts = [txt(v).alias(f"v{i}") for i, v in enumerate(values, 1)]
    return df.select(F.lit(kind).alias("kind"), txt(ident).alias("id"), *texts)


def listed(parts: list[DataFrame], width: int) -> DataFrame:
    every = union_families(parts)
    return every.select("kind", "id", *[f"v{i}" for i in range(1, width + 1)])


def fra(col: str) -> Column:
    return F.element_at(col, F.lit("fra"))


def _signed(sql: str) -> str:
    """SQL of the row checksum of a text."""
    h = f"CAST('0x' || substr(md5({sql}), 1, 8) AS BIGINT)"
    return f"CAST(CASE WHEN {h} >= 2147483648 THEN {h} - 4294967296 ELSE {h} END AS VARCHAR)"


@query(f"""
WITH p AS (SELECT * FROM part WHERE p_brand <> 'Brand#1'),
permit AS (SELECT CAST(s_suppkey AS VARCHAR) AS amm, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey ELSE 1000000 + s_suppkey END AS id, s_name,
  s_name || ' A,' || s_name || ' B' AS names FROM supplier WHERE s_nationkey < 15),
risk AS (SELECT p_partkey, 'H' || CASE p_size % 3 WHEN 0 THEN '317' WHEN 1 THEN '361d' ELSE '999' END AS code, 'x' AS phrase FROM p UNION ALL SELECT p_partkey, 'R36', 'y' FROM p)
SELECT 'product' AS kind, CAST(p_partkey AS VARCHAR) AS id, CAST(p_partkey AS VARCHAR) || '_' || replace(lower(p_name), ' ', '_') AS v1, 'PPP' AS v2, permit.names AS v3, 'Fongicide' AS v4
FROM p LEFT JOIN permit ON permit.id = p_partkey
UNION ALL SELECT 'product', CAST(permit.id AS VARCHAR), lower(regexp_replace(amm || ' ' || s_name, '[^a-zA-Z0-9]', '_', 'g')), 'PCP', names, CASE WHEN donor.p_partkey IS NOT NULL THEN 'Fongicide' END
FROM permit LEFT JOIN p donor ON CAST(donor.p_partkey AS VARCHAR) = amm WHERE permit.id NOT IN (SELECT p_partkey FROM p)
UNION ALL SELECT 'usage', 'u' || p_partkey, CASE p_type WHEN 'SMALL' THEN 's1,s2' WHEN 'LARGE' THEN 'large_v' WHEN 'PROMO' THEN 'except' ELSE 'plant' END,
  CASE WHEN p_size BETWEEN 20 AND 30 THEN '7' END, CAST(p_size AS VARCHAR), 'true' FROM p
UNION ALL SELECT 'risk', p_partkey || '_' || code, phrase, {_signed("p_partkey || code || phrase")}, NULL, NULL FROM risk
UNION ALL SELECT 'cropset', '1', 's1, s2', {_signed("'1s1, s2' || '{\"fra\":\"Small\"}' || '[\"s1\",\"s2\"]' || '{\"fra\":\"\"}'")}, NULL, NULL WHERE EXISTS (SELECT 1 FROM part WHERE p_type = 'SMALL')
UNION ALL SELECT 'symbol', n_name, 'GHS' || n_nationkey, NULL, NULL, NULL FROM nation
UNION ALL SELECT 'target', r_name, CAST(r_regionkey AS VARCHAR), 'T', NULL, NULL FROM region
""")
def d_protection_load(t: Tables):
    """Catalogue, extract, permits, crop sets, exceptions, symbols and targets in one call, with row checksums."""
    null = F.lit(None).cast("string")
    extract = t.part.filter("p_size between 20 and 30").select(
        txt("p_partkey").alias("numero_amm"), F.concat("p_type", F.lit("*Trt Part.Aer.*"), "p_name").alias("identifiant_usage"),
        null.alias("stade_cultural_min_bbch"), null.alias("tade_cultural_max_bbch"), null.alias("nombre_max_d_application"),
        F.concat(F.lit("bouillie : "), txt("p_size"), F.lit(" L/ha, fin")).alias("condition_emploi"),
        F.lit("7").alias("intervalle_minimum_entre_applications_jour"), F.lit("Autorisé").alias("etat_usage"),
    )
    number = F.when(c("s_suppkey") % 2 == 0, c("s_suppkey")).otherwise(c("s_suppkey") + 1000000)
    trade = t.supplier.select(
        c("s_name").alias("nom_du_produit"), txt(number).alias("n_permis"), F.lit("ref").alias("produit_de_reference_francais"), F.lit("H").alias("detenteur_pcp"),
        F.when(c("s_nationkey") < 15, txt("s_suppkey")).alias("n_amm_de_reference_francais"),
        F.explode(F.array(F.concat("s_name", F.lit(" B\t")), F.concat(F.lit(" "), "s_name", F.lit(" A")))).alias("nom_du_produit_importe"),
    )
    kinds = t.part.select("p_type", F.concat(F.substring("p_type", 1, 1), F.lower(F.substr("p_type", F.lit(2)))).alias("crop")).distinct()
    loaded = protection.load(catalogue(t), {
        "usages": extract, "parallel_trade": trade,
        "cropsets": kinds.filter("p_type = 'SMALL'").select(
            F.lit("1").alias("n"), F.lit("s1, s2").alias("name"), c("crop").alias("label_fr"), F.lit("s1,s2").alias("crop_names"), null.alias("crop_labels_fr")
        ),
        "varieties": kinds.filter("p_type = 'LARGE'").select(F.lit("large_v").alias("name"), F.create_map(F.lit("fra"), "crop").alias("label")),
        "exceptions": kinds.filter("p_type = 'PROMO'").select(c("crop").alias("crop_label"), F.lit("except").alias("species")),
        "symbols": t.nation.select(c("n_name").alias("mention_danger"), F.concat(F.lit("GHS"), txt("n_nationkey")).alias("code_pictogramme")),
        "target_links": t.region.select(
            c("r_name").alias("ephy_name"), txt("r_regionkey").alias("pfi_id"), F.lit("x").alias("pfi_name"), F.lit("T").alias("default_pfi_treatment_type_id")
        ),
    })
    days = F.extract(F.lit("DAY"), "applications_frequency").cast("int")
    sure = c("record_checksum").isNotNull()
    return listed([
        listing(loaded[protection.PRODUCTS.name].filter(sure), "product", "id", "reference_name", "product_type", F.array_join("other_names", ","), F.array_join("natures", ",")),
        listing(loaded[protection.USAGES.name], "usage", "id", F.array_join("species", ","), days, "extract_spray_volume_max_quantity", sure),
        listing(loaded[protection.RISKS.name], "risk", F.concat_ws("_", "product_id", "risk_code"), "risk_phrase", "record_checksum"),
        listing(loaded[protection.CROPSETS.name], "cropset", "id", "name", "record_checksum"),
        listing(loaded[protection.SYMBOLS.name], "symbol", "id", "symbol_name"),
        listing(loaded[protection.TARGET_LINKS.name], "target", "ephy_name", "pfi_id", "default_pfi_treatment_type_id"),
    ], 4)


@query("""
WITH i AS (SELECT p_brand || '_' || p_size AS k, CAST(p_size AS DOUBLE) AS y, p_type, CASE p_type WHEN 'SMALL' THEN 0 WHEN 'LARGE' THEN 1 ELSE 2 END AS rank
  FROM part WHERE p_type IN ('SMALL', 'LARGE', 'PROMO') AND p_partkey % 3 <> 0),
g AS (SELECT k, min(rank) AS rank, max(y) AS y FROM i GROUP BY k)
SELECT k || '_fra_D017' AS id, CASE rank WHEN 0 THEN 'edge' WHEN 1 THEN 'green_zone' ELSE 'electric_pole' END AS nature,
  CASE rank WHEN 0 THEN 'haie' WHEN 1 THEN 'bois' ELSE 'pylone' END AS name,
  CASE rank WHEN 0 THEN y + 1.5 WHEN 1 THEN y + 1 ELSE y END AS cx, CASE rank WHEN 1 THEN y + 1 ELSE y END AS cy FROM g
""")
def d_area_items(t: Tables):
    """Hedges, green zones and pylons of metropolitan departments; those overseas are left out."""
    y, two = c("p_size").cast("double"), F.lit(2.0)
    base = t.part.select(
        F.concat("p_brand", F.lit("_"), txt("p_size")).alias("id"), F.when(c("p_partkey") % 3 == 0, "D971").otherwise("D017").alias("department"),
        F.lit(4326).alias("srid"), F.lit("bois").alias("nature"), "p_type", y.alias("y"),
    )

    def layer(kind, geom):
        return base.filter(c("p_type") == kind).withColumn("geom", geom)

    items = hydrography.area_items({
        "hedge": layer("SMALL", F.array(F.array(pt(c("y"), c("y")), pt(c("y") + 3, c("y"))))),
        "green_zone": layer("LARGE", F.array(F.array(quad(c("y"), c("y"), two, two)), F.array(quad(c("y") + 50, c("y"), two, two)))),
        "pylon": layer("PROMO", F.array(pt(c("y"), c("y")))),
    })
    return items.select("id", "nature", fra("name").alias("name"), c("centroid.x").alias("cx"), c("centroid.y").alias("cy"))


@query("""
WITH z AS (SELECT n_name AS department FROM nation WHERE n_nationkey < 3),
o AS (SELECT *, o_orderkey % 5 AS feed, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DECIMAL(8,2)) AS price FROM orders),
f AS (SELECT CASE feed WHEN 0 THEN 'farmer_price' WHEN 1 THEN 'matif_price' WHEN 2 THEN 'shipping_price' END AS nature, CASE WHEN feed = 2 THEN 0 ELSE 1 END AS months,
  CASE WHEN feed = 2 THEN 1 ELSE 0 END AS days, CASE WHEN feed < 3 THEN 2020 END AS campaign, CASE feed WHEN 3 THEN true WHEN 4 THEN o_orderstatus = 'F' END AS organic,
  CASE WHEN feed = 2 THEN CAST(o_orderdate AS DATE) ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS started_on, price FROM o WHERE feed < 3 OR o_orderkey % 7 > 1)
SELECT department AS department_zone, nature, months AS duration_months, days AS duration_days, campaign, organic, count(*) AS n, CAST(min(started_on) AS VARCHAR) AS first_day,
  count(DISTINCT started_on) AS n_days, CAST(CAST(sum(price) AS DECIMAL(18,2)) AS VARCHAR) AS total FROM f, z GROUP BY ALL
""")
def d_price_feeds(t: Tables):
    """Farm, futures, shipping, milk and meat prices of one zone given to its departments; ``S.`` and NULL are no price."""
    zones = t.nation.filter("n_nationkey < 3").select(c("n_name").alias("department"), F.lit("FRANCE").alias("region"))
    key = c("o_orderkey")
    waiting = F.when((key % 7 == 0) & (key % 5 > 2), "S.").when((key % 7 == 1) & (key % 5 > 2), None).otherwise("0")
    raw = t.orders.select(
        key, txt(F.year("o_orderdate")).alias("year"), txt(F.month("o_orderdate")).alias("month"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("started_on"),
        F.lit("France").alias("zone"), F.lit("x").alias("production_label"), F.lit("specie").alias("specie"), waiting.alias("waiting_price"),
        F.replace(money("o_totalprice"), F.lit("."), F.lit(",")).alias("final_price"), F.lit("ton").alias("price_unit"), F.lit("grain").alias("product_output_specie"),
        F.lit("2020").alias("campaign"), F.when(key % 5 == 3, "true").otherwise(txt(c("o_orderstatus") == "F")).alias("organic"),
    )
    feeds = ("crop_prices", "crop_matif_price", "crop_shipping_price", "milk_cow_prices", "meat_prices")
    p = productions.production_prices({name: raw.filter(key % 5 == i) for i, name in enumerate(feeds)}, zones)
    return p.groupBy(
        "department_zone", "nature", c("price_duration_months").alias("duration_months"), c("price_duration_days").alias("duration_days"), "campaign", "organic"
    ).agg(
        F.count(F.lit(1)).alias("n"), txt(F.min("started_on")).alias("first_day"), F.countDistinct("started_on").alias("n_days"),
        txt(F.sum("final_price").cast("decimal(18,2)")).alias("total"),
    )


@query("""
WITH p AS (SELECT *, p_partkey % 9 AS k, CAST(p_partkey AS VARCHAR) AS name FROM part)
SELECT CASE WHEN k < 7 THEN 'variant' WHEN k = 7 THEN 'nature' ELSE 'category' END AS kind, name AS id,
  CASE k WHEN 0 THEN 'article' WHEN 1 THEN 'article' WHEN 2 THEN 'service' WHEN 3 THEN 'crop' WHEN 4 THEN 'animal' WHEN 5 THEN 'animal' WHEN 6 THEN 'worker' ELSE 'fam' END AS v1,
  CASE WHEN k < 3 THEN 'u' WHEN k = 3 THEN 'hectare' WHEN k < 7 THEN 'unity' WHEN k = 7 THEN 'a|b' ELSE CAST(CAST(p_size AS DECIMAL(5,2)) AS VARCHAR) END AS v2,
  CASE WHEN k IN (3, 4) THEN p_brand WHEN k = 5 THEN 'animal_group' WHEN k = 7 THEN '' WHEN k = 8 THEN p_type END AS v3,
  CASE WHEN k = 0 AND p_size > 20 THEN '{"thousand_grains_mass":"' || p_size || 'gram"}' WHEN k = 0 THEN '{"thousand_grains_mass":"50gram"}' WHEN k = 5 THEN '{"sex ":"male","reproductor ":""}'
    WHEN k < 7 THEN '{}' WHEN k = 7 THEN 'natures_' || name ELSE 'categories_' || name END AS v4,
  CASE k WHEN 0 THEN 'uf989-seed.svg' WHEN 3 THEN 'uf940-seedling-solid.svg' WHEN 6 THEN 'uf0d5-male.svg' ELSE 'p.svg' END AS v5,
  CASE WHEN k < 2 THEN 'target' WHEN k = 5 THEN 'bos' END AS v6
FROM p
""")
def d_article_families(t: Tables):
    """The article families beside products, fertilizers, equipment and zones; categories and natures."""
    null, k = F.lit(None).cast("string"), c("p_partkey") % 9
    names = ("seeds_and_plants", "other_articles", "services", "crops", "animals", "animal_groups", "workers")
    base = t.part.select(
        k.alias("k"), txt("p_partkey").alias("reference_name"), F.lit("fam").alias("family"), F.lit("cat").alias("category"), F.lit("nat").alias("nature"),
        F.lit("u").alias("default_unit"), F.lit("target").alias("target_specie"), c("p_brand").alias("specie"), F.lit("p.svg").alias("pictogram"),
        F.when(c("p_size") > 20, txt("p_size")).alias("pmg"), F.lit("bos").alias("derivative_of"), F.lit("male").alias("sex"), null.alias("reproductor"),
        F.lit("decimal").alias("population_counting"), F.lit("a, b").alias("frozen_indicators"), null.alias("variable_indicators"), F.lit("").alias("abilities"), F.lit("v").alias("variety"),
        *[null.alias(f"fixed_asset_{n}") for n in ("account", "allocation_account", "expenses_account")], txt("p_size").alias("depreciation_percentage"),
        c("p_type").alias("charge_account"), null.alias("product_account"), null.alias("stock_account"), null.alias("stock_movement_account"), F.lit("5.5").alias("default_vat_rate"),
        null.alias("payment_frequency_value"), null.alias("payment_frequency_unit"),
    )
    v = variants.variants({name: base.filter(c("k") == i) for i, name in enumerate(names)})
    n, g = variants.natures(base.filter("k = 7")), variants.categories(base.filter("k = 8"))
    return listed([
        listing(v, "variant", "reference_name", "family", "default_unit", "specie", F.to_json("indicators"), "pictogram", "target_specie"),
        listing(n, "nature", "reference_name", "family", F.array_join("frozen_indicators", "|"), F.array_join("variable_indicators", "|"), "translation_id", "pictogram"),
        listing(g, "category", "reference_name", "family", "depreciation_percentage", "purchase_account", "translation_id", "pictogram"),
    ], 6)


@query("""
WITH h AS (SELECT conv_id, role, 'plant_' || role || '_bio_' || conv_id AS wid FROM conversations WHERE turn = 0)
SELECT 'workflow' AS kind, wid AS id, (conv_id % 9 + 1) || '/3' AS v1, CASE WHEN conv_id % 2 = 0 THEN 'perennial' ELSE 'annual' END || '/1' AS v2, CAST(conv_id AS VARCHAR) AS v3, role AS v4 FROM h
UNION ALL SELECT 'item', h.wid || '_' || l.role || '_1_tool_w' || l.turn, 'driver', CAST(CAST(l.turn + 0.5 AS DECIMAL(19,4)) AS VARCHAR), l.role, h.wid || '_' || l.role || '_1'
FROM conversations l JOIN h USING (conv_id) WHERE l.turn >= 1 AND l.role = 'assistant'
UNION ALL SELECT 'sequence', CAST(conv_id AS VARCHAR), 'plant', role, 'bio', 'technical_sequences_' || conv_id FROM h
UNION ALL SELECT 'title', 'technical_workflows_' || wid, 'L a', 'L a', NULL, NULL FROM h UNION ALL SELECT 'title', 'technical_sequences_' || conv_id, 'L a', 'L a', NULL, NULL FROM h
""")
def d_workflow_books(t: Tables):
    """Header lines of workbooks as workflows and sequences with their titles, and the lines that name an actor as items."""
    head = F.array(
        cell("A", F.lit("plant")), cell("B", c("role")), cell("C", F.lit("bio")), cell("D", F.lit("L'a")), cell("E", F.concat(F.lit("2020-03-0"), txt(c("conv_id") % 9 + 1))),
        cell("H", F.when(c("conv_id") % 2 == 0, "perennial")), cell("I", F.concat(txt("conv_id"), F.lit(".7"))),
    )
    line = F.array(
        cell("A", F.lit("1")), cell("B", c("role")), cell("G", F.when(c("role") == "assistant", "driver")), cell("H", F.lit("tool")),
        cell("I", F.concat(F.lit("w"), txt("turn"))), cell("J", F.concat(txt("turn"), F.lit(",5"))),
    )
    cells = book(t, head, line)
    w, i, s = workflows.workflows(cells), workflows.procedure_items(cells), workflows.sequences(cells)
    titles = [listing(x, "title", "id", "fra", "eng") for x in (workflows.workflow_translations(cells), workflows.sequence_translations(cells))]
    return listed([
        listing(w, "workflow", "reference_name", F.concat_ws("/", "start_day", "start_month"), F.concat_ws("/", "life_cycle", "life_state"), "plant_density", "production_reference_name"),
        listing(i, "item", "reference_name", "actor_reference", "quantity", "procedure_reference", "technical_workflow_procedure_id"),
        listing(s, "sequence", "reference_name", "family", "production_reference_name", "production_system", "translation_id"), *titles,
    ], 4)


@query("""
SELECT 'dimension' AS kind, n_name AS id, 's' || n_nationkey AS v1, 'dimensions_' || n_name AS v2, NULL AS v3 FROM nation
UNION ALL SELECT 'packaging', CAST(p_partkey AS VARCHAR), CAST(CAST(CAST(p_retailprice AS DECIMAL(14,2)) AS DECIMAL(25,10)) AS VARCHAR), p_brand, 'packagings_' || p_partkey FROM part
UNION ALL SELECT 'label', 'packagings_' || p_partkey, p_name, p_type, NULL FROM part
UNION ALL SELECT 'label', 'dimensions_' || n_name, n_name, n_name, NULL FROM nation
""")
def d_packagings(t: Tables):
    """Dimensions, packagings and their labels."""
    dims = t.nation.select(c("n_name").alias("reference_name"), F.concat(F.lit("s"), txt("n_nationkey")).alias("symbol"), c("n_name").alias("fra"), c("n_name").alias("eng"))
    packs = t.part.select(
        txt("p_partkey").alias("reference_name"), money("p_retailprice").alias("capacity"), c("p_brand").alias("capacity_unit"), c("p_name").alias("fra"), c("p_type").alias("eng")
    )
    return listed([
        listing(units.dimensions(dims), "dimension", "reference_name", "symbol", "translation_id"),
        listing(units.packagings(packs), "packaging", "reference_name", "capacity", "capacity_unit", "translation_id"),
        listing(units.unit_translations({"dimensions": dims, "packagings": packs}), "label", "id", "fra", "eng"),
    ], 3)


@query("""
SELECT 'price' AS kind, CASE WHEN p_size < 25 THEN 'F_P' ELSE 'OI' END || p_partkey AS id, CAST(CAST(CAST(p_retailprice AS DECIMAL(14,2)) AS DECIMAL(19,4)) AS VARCHAR) AS v1, '2020-02-01' AS v2, p_brand AS v3 FROM part
UNION ALL SELECT 'protection', 'PH' || p_partkey, CAST(CAST(CAST(p_retailprice AS DECIMAL(14,2)) AS DECIMAL(19,4)) AS VARCHAR), '2020-02-01', CAST(p_partkey AS VARCHAR) FROM part
UNION ALL SELECT 'contract', s_name, CASE WHEN s_nationkey < 9 THEN 'true' ELSE 'false' END, CAST(CAST(CAST(s_acctbal AS DECIMAL(14,2)) AS DECIMAL(8,2)) AS VARCHAR), 'worker_contracts_' || s_name FROM supplier
UNION ALL SELECT 'label', 'worker_contracts_' || s_name, s_name, lower(s_name), NULL FROM supplier
""")
def d_cost_files(t: Tables):
    """Farm-product and other costs, plant-protection prices, and work contracts with their labels."""
    cost = t.part.select(
        txt("p_partkey").alias("n"), c("p_name").alias("name"), c("p_brand").alias("article"), txt("p_partkey").alias("article_id"), money("p_retailprice").alias("price"),
        F.lit("euro").alias("currency"), F.lit("bag").alias("packaging"), F.lit("01/02/2020").alias("date"), "p_size",
    )
    people = t.supplier.select(
        c("s_name").alias("reference_name"), F.lit("worker").alias("worker_variant"), F.when(c("s_nationkey") < 9, "true").otherwise("false").alias("salaried"),
        F.lit(None).cast("string").alias("contract_end"), money("s_acctbal").alias("legal_monthly_working_time"),
        *[F.lit("0.5").alias(n) for n in ("legal_monthly_offline_time", "min_raw_wage_per_hour", "salary_charges_ratio", "farm_charges_ratio")],
        c("s_name").alias("fra"), F.lower("s_name").alias("eng"),
    )
    bought = prices.prices({"farm_product_costs": cost.filter("p_size < 25"), "other_input_costs": cost.filter("p_size >= 25")})
    return listed([
        listing(bought, "price", "id", "unit_pretax_amount", "started_on", "reference_article_name"),
        listing(prices.protection_prices(cost), "protection", "id", "unit_pretax_amount", "started_on", "reference_article_name"),
        listing(prices.contracts(people), "contract", "reference_name", "salaried", "legal_monthly_working_time", "translation_id"),
        listing(prices.contract_translations(people), "label", "id", "fra", "eng"),
    ], 3)


@query("""
SELECT 'production' AS kind, p_type || p_partkey AS id, CASE p_type WHEN 'SMALL' THEN 'processing' ELSE 'service' END || '_productions_' || p_type || p_partkey AS v1, NULL AS v2 FROM part WHERE p_type IN ('SMALL', 'LARGE')
UNION ALL SELECT 'start', p_name || p_partkey, CAST(p_size AS VARCHAR), p_brand FROM part
UNION ALL SELECT 'feature', n_name, 'sna_codes_' || n_name, CASE WHEN n_regionkey > 1 THEN 'parent' END FROM nation
UNION ALL SELECT 'treatment', s_name, '2020', 'group' FROM supplier
UNION ALL SELECT 'label', 'sna_codes_' || n_name, n_name, lower(n_name) FROM nation
""")
def d_production_codes(t: Tables):
    """Processing and service productions, start states, land features and treatment codes."""
    null = F.lit(None).cast("string")
    base = t.part.select(
        F.concat("p_type", txt("p_partkey")).alias("reference_name"), F.lit("fam").alias("activity_family"), null.alias("specie"), null.alias("usage"),
        F.lit("01/02/19").alias("started_on"), F.lit("31/12/2029").alias("stopped_on"), null.alias("life_duration"), "p_type",
    )
    made = productions.productions({"processing_productions": base.filter("p_type = 'SMALL'"), "service_productions": base.filter("p_type = 'LARGE'")})
    starts = t.part.select(F.concat("p_name", txt("p_partkey")).alias("production"), txt("p_size").alias("year"), c("p_brand").alias("key"))
    land = t.nation.select(
        c("n_name").alias("reference_name"), F.lit("line").alias("nature"), F.when(c("n_regionkey") > 1, "parent").alias("parent"), c("n_name").alias("fra"), F.lower("n_name").alias("eng")
    )
    codes = t.supplier.select(c("s_name").alias("tfi_code"), F.lit("l").alias("tfi_label"), F.lit("p").alias("production"), F.lit("group").alias("tfi_crop_group"))
    return listed([
        listing(made, "production", "reference_name", "translation_id", "season"), listing(productions.start_states(starts), "start", "production", "year", "key"),
        listing(productions.land_features(land), "feature", "reference_name", "translation_id", "parent"),
        listing(productions.treatment_codes(codes), "treatment", "tfi_code", "campaign", "tfi_crop_group"),
        listing(productions.production_translations({"sna_codes": land}), "label", "id", "fra", "eng"),
    ], 2)


@query("""
SELECT 'production_natures' AS kind, p_name AS id, 'ZAA' AS v1, count(*) AS n FROM part GROUP BY ALL
UNION ALL SELECT 'phytosanitary_products', p_type, 'authorized', count(*) FROM part GROUP BY ALL
UNION ALL SELECT 'species', n_name, lower(n_name), 1 FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING')
UNION ALL SELECT 'fertilizers', p_brand, 'u', count(*) FROM part WHERE p_size < 20 GROUP BY ALL
UNION ALL SELECT 'phytosanitary_doses', CAST(p_partkey AS VARCHAR), CAST(CAST(min(l_quantity) AS DECIMAL(19,4)) AS VARCHAR), 1
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type IN ('SMALL', 'LARGE') GROUP BY p_partkey
""")
def d_compact_extracts(t: Tables):
    """The five extracts for small devices, from release tables."""
    kept = t.part.withColumn("category", F.when(c("p_size") < 20, "fertilizer").otherwise("seed"))
    unit = F.when(c("p_type") == "SMALL", "liter_per_hectare").when(c("p_type") == "LARGE", "liter").otherwise("kilogram")
    out = compact.extracts({
        "master_productions": productions.PRODUCTIONS.align(t.part.select(c("p_name").alias("reference_name"), c("p_brand").alias("specie"), F.lit("ZAA").alias("agroedi_crop_code"))),
        "registered_phytosanitary_products": t.part.select(c("p_partkey").alias("id"), c("p_type").alias("name"), F.lit("authorized").alias("state")),
        "registered_seed_varieties": t.customer.filter("c_mktsegment = 'BUILDING'").join(t.nation, c("c_nationkey") == c("n_nationkey")).select(c("n_name").alias("id_specie")),
        "master_variants": variants.VARIANTS.align(kept.select(c("p_brand").alias("reference_name"), "category", F.lit("u").alias("default_unit"))),
        "registered_phytosanitary_usages": t.lineitem.join(t.part, c("l_partkey") == c("p_partkey")).select(
            c("p_partkey").alias("product_id"), c("l_quantity").cast("decimal(19,4)").alias("dose_quantity"), unit.alias("dose_unit")
        ),
    }, t.nation.select(c("n_name").alias("name"), F.create_map(F.lit("fra"), c("n_name"), F.lit("eng"), F.lower("n_name")).alias("label")))
    shown = {
        "production_natures": ("reference_name", "agroedi_crop_code"), "phytosanitary_products": ("name", "state"), "species": ("fra", "eng"),
        "fertilizers": ("reference_name", "default_unit"), "phytosanitary_doses": ("product_id", "dose"),
    }
    every = listed([listing(out[name], name, *columns) for name, columns in shown.items()], 1)
    return every.groupBy("kind", "id", "v1").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH f(flavor) AS (VALUES ('vines'), ('light'), ('test'), ('pv'))
SELECT flavor, 'postal' AS kind, count(*) AS n FROM f, customer WHERE flavor = 'vines' OR flavor = 'test' AND c_nationkey = 1 OR flavor = 'pv' AND c_nationkey IN (2, 3) GROUP BY flavor
UNION ALL SELECT flavor, 'item', count(*) FROM f, customer
WHERE flavor = 'vines' OR flavor = 'test' AND c_custkey % 2 = 0 AND c_custkey % 10 / 100.0 + 0.025 <= 0.1 OR flavor = 'pv' AND c_custkey % 2 = 1 GROUP BY flavor
UNION ALL SELECT flavor, 'account', count(*) FROM f, nation GROUP BY flavor
""")
def q_presets(t: Tables):
    """Rows that ready-made releases keep of postal codes, water items and accounts."""
    code = F.when(c("c_nationkey") == 1, "17250").when(c("c_nationkey").isin(2, 3), F.concat(F.lit("33"), txt(c("c_nationkey") + 100))).otherwise("75001")
    tables = {
        "registered_postal_codes": t.customer.select(txt("c_custkey").alias("id"), code.alias("postal_code")),
        "registered_hydrographic_items": t.customer.select(
            txt("c_custkey").alias("id"), F.struct((c("c_custkey") % 10 / 100 - 0.755).alias("x"), F.when(c("c_custkey") % 2 == 0, 45.81).otherwise(44.75).alias("y")).alias("centroid")
        ),
        "master_chart_of_accounts": t.nation.select(txt("n_nationkey").alias("id")),
    }
    short = {"registered_postal_codes": "postal", "registered_hydrographic_items": "item", "master_chart_of_accounts": "account"}
    parts = [
        df.select(F.lit(name).alias("flavor"), F.lit(short[table]).alias("kind"))
        for name in ("vines", "light", "test", "pv")
        for table, df in select_release(tables, presets.SPECS, presets.PRESETS[name]).items()
    ]
    return union_families(parts).groupBy("flavor", "kind").agg(F.count(F.lit(1)).alias("n"))
