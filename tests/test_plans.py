"""Data set plans on small hand-made inputs; the larger comparisons are in the driver queries."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from agrimill.operators import keyed
from agrimill.plans import compact, hydrography, land, market, prices, productions, protection, registers, units, variants, weather, workflows
from agrimill.sources.documents import read_xml_catalogue
from agrimill.specs import MULTILINE, MULTIPOLYGON, POINT
from tests.conftest import ring, rows

CATALOGUE = """<?xml version="1.0" encoding="UTF-8"?>
<intrants>
<PPP>
  <numero-AMM> 2090141</numero-AMM><nom-produit>BARBARIAN SUPER 360</nom-produit>
  <autres-noms><autre-nom><nom>AUTRE</nom></autre-nom></autres-noms>
  <fonctions><ref>Herbicide</ref></fonctions>
  <composition-integrale><substances-actives><substance-active><substance>glyphosate</substance><teneur-SA-pure unite="g/L">360.0</teneur-SA-pure></substance-active>
    <substance-active><substance>eau</substance></substance-active></substances-actives></composition-integrale>
  <conditions-emploi-produit><condition-emploi-produit><condition-emploi-categorie>Protection de l'opérateur</condition-emploi-categorie><description>Gants</description></condition-emploi-produit></conditions-emploi-produit>
  <etat-produit>RETIRE</etat-produit><date-premiere-autorisation>03/04/0016</date-premiere-autorisation>
  <usages>
    <usage date-decision="01/02/2019"><id>u1</id><etat-usage>Retrait</etat-usage><identifiant-usage lib-court="11015901">Blé*Désherbage*Toutes cultures</identifiant-usage>
      <date-fin-utilisation>30/06/2020</date-fin-utilisation><dose-retenue unite="L/ha">3.5</dose-retenue><delai-avant-recolte-jour>7</delai-avant-recolte-jour>
      <stade-cultural-min>10</stade-cultural-min><nombre-apport-max>2</nombre-apport-max><condition-emploi>Volume de bouillie : 200 L/ha.</condition-emploi><ZNT-aquatique>5.0</ZNT-aquatique></usage>
    <usage><id>u2</id><etat-usage>Retrait</etat-usage><identifiant-usage lib-court="2">Usages non agricoles*Désherbage*Allées</identifiant-usage><date-fin-utilisation>01/01/2021</date-fin-utilisation></usage>
  </usages>
  <mentions-autorisees><ref>Mention abeille</ref><ref>Liste biocontrôle</ref></mentions-autorisees><restrictions-usage><ref>A</ref><ref>B</ref></restrictions-usage>
  <titulaire>FIRM</titulaire><type-produit>PPP</type-produit>
  <classement-CLP><phrases-risque><ref lib-court="H318">Yeux</ref><ref lib-court="H361d">Foetus</ref></phrases-risque></classement-CLP>
  <classement-DSD><phrases-risque><ref lib-court="R43">Peau</ref><ref lib-court="Xn">Nocif</ref></phrases-risque></classement-DSD>
</PPP>
<PPP><numero-AMM>N/A</numero-AMM><nom-produit>IGNORED</nom-produit><etat-produit>AUTORISE</etat-produit></PPP>
<adjuvant><numero-AMM>2090141</numero-AMM><nom-produit>SECOND</nom-produit><etat-produit>AUTORISE</etat-produit><type-produit>ADJUVANT</type-produit></adjuvant>
<adjuvant><numero-AMM>7</numero-AMM><nom-produit>Mouillant +</nom-produit><etat-produit>AUTORISE</etat-produit><type-produit>ADJUVANT</type-produit>
  <usages><usage><id>u3</id><etat-usage>Autorisé</etat-usage><identifiant-usage lib-court="3">Mais*ROUILLE</identifiant-usage></usage></usages></adjuvant>
</intrants>
"""


@pytest.fixture(scope="module")
def catalogue(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("xml") / "c.xml"
    path.write_text(CATALOGUE, encoding="utf-8")
    return read_xml_catalogue(spark, str(path), protection.RECORD_TAGS, protection.CATALOGUE_SCHEMA)


def test_products(catalogue):
    got = {r["id"]: r for r in protection.products(catalogue).collect()}
    assert sorted(got) == [7, 2090141]
    p = got[2090141]
    assert p["name"] == "BARBARIAN SUPER 360" and p["reference_name"] == "2090141_barbarian_super_360"
    assert p["other_names"] == ["AUTRE"] and p["natures"] == ["Herbicide"] and p["active_compounds"] == ["glyphosate 360.0 g/L", "eau"]
    assert p["mix_category_codes"] == [1, 3] and p["in_field_reentry_delay"] == dt.timedelta(hours=48)
    assert (p["state"], p["started_on"], p["stopped_on"]) == ("withdrawn", dt.date(2016, 4, 3), dt.date(2021, 1, 1))
    assert p["allowed_mentions"] == {"bee_usage": True, "biocontrol_usage": True} and p["restricted_mentions"] == "A | B"
    assert p["operator_protection_mentions"] == "Gants" and p["firm_name"] == "FIRM"
    q = got[7]
    assert q["reference_name"] == "7_mouillant_" and q["mix_category_codes"] == [1] and q["in_field_reentry_delay"] == dt.timedelta(hours=6)
    assert q["stopped_on"] is None and q["allowed_mentions"] is None and q["active_compounds"] == []


def test_usages_and_risks(catalogue):
    u = {r["id"]: r for r in protection.with_spray_volume(protection.usages(catalogue)).collect()}
    assert sorted(u) == ["u1", "u3"]
    a, b = u["u1"], u["u3"]
    assert (a["crop_label_fra"], a["treatment"], a["target_name_label_fra"]) == ("Blé", None, "Désherbage*Toutes cultures")
    assert (a["dose_quantity"], a["dose_unit"], a["pre_harvest_delay"]) == (Decimal("3.5000"), "liter_per_hectare", dt.timedelta(days=7))
    assert (a["untreated_buffer_aquatic"], a["decision_date"], a["applications_count"]) == (5, dt.date(2019, 2, 1), 2)
    assert (a["extract_spray_volume_max_quantity"], a["extract_spray_volume_max_unit"]) == ("200", "L/ha")
    assert (b["crop"], b["target_name"], b["species"]) == ({"fra": "Maïs"}, {"fra": "Rouille"}, ["plant"])
    assert b["pre_harvest_delay"] == dt.timedelta(days=3) and b["dose_unit"] is None
    assert rows(protection.risks(catalogue), "product_id", "risk_code", "risk_phrase") == [
        (2090141, "H318", "Yeux"), (2090141, "H361d", "Foetus"), (2090141, "R43", "Peau")
    ]


def test_frequency_matches_null_keys(catalogue, raw):
    extract = raw(
        "numero_amm,identifiant_usage,stade_cultural_min_bbch,tade_cultural_max_bbch,nombre_max_d_application,condition_emploi,intervalle_minimum_entre_applications_jour,etat_usage",
        [
            ("7", "Mais*ROUILLE", None, None, None, None, "14", "Autorisé"), ("7", "Mais*ROUILLE", None, None, None, None, "3", "Retrait"),
            ("2090141", "Blé*Désherbage*Toutes cultures", "11", None, "2", "Volume de bouillie : 200 L/ha.", "9", "Autorisé"),
        ],
    )
    out = protection.with_frequency(protection.usages(catalogue), extract)
    assert rows(out, "id", "applications_frequency") == [("u1", None), ("u3", dt.timedelta(days=14))]


def test_permits_become_products(catalogue, raw):
    permits = protection.permits(raw(
        "n_permis,nom_du_produit,nom_du_produit_importe,produit_de_reference_francais,detenteur_pcp,n_amm_de_reference_francais",
        [
            ("900", "COPY!", " A\t", "R", "H", "2090141"), ("900", "COPY!", "B", "R", "H", "2090141"), ("901", "LONE", "C", "R", "H", None),
            ("7", "SAME", "NEW", "R", "H", "7"),
        ],
    ))
    out = {r["id"]: r for r in protection.with_permits(protection.products(catalogue), permits).collect()}
    assert sorted(out) == [7, 900, 2090141]
    p = out[900]
    assert (p["state"], p["product_type"], p["other_names"], p["reference_name"]) == ("inherited", "PCP", ["A", "B"], "2090141_copy")
    assert p["mix_category_codes"] == [1, 3] and p["natures"] == ["Herbicide"] and p["started_on"] == dt.date(2016, 4, 3)
    assert out[7]["name"] == "Mouillant +" and out[7]["other_names"] == ["NEW"]


def test_checksum_changes_with_content(catalogue):
    risks = protection.risks(catalogue)
    a = rows(protection.with_checksum(risks, protection.RISKS), "risk_code", "record_checksum")
    b = rows(protection.with_checksum(risks.withColumn("risk_phrase", F.lit("x")), protection.RISKS), "risk_code", "record_checksum")
    assert [x[0] for x in a] == [x[0] for x in b] and all(x[1] != y[1] for x, y in zip(a, b))
    assert protection.with_checksum(protection.usages(catalogue), protection.USAGES).filter("record_checksum is null").count() == 0


def test_small_protection_tables(raw):
    sets = protection.cropsets(raw("n,name,label_fr,crop_names,crop_labels_fr", [("1", "ephy", "Agrumes", "citrus, poncirus", None)]))
    r = sets.collect()[0]
    assert (r["label"], r["crop_names"], r["crop_labels"]) == ({"fra": "Agrumes"}, ["citrus", "poncirus"], {"fra": ""})
    assert rows(protection.symbols(raw("mention_danger,description_danger,code_pictogramme", [("H1", "d", "GHS")]))) == [("H1", "GHS")]
    t = raw("ephy_name,pfi_id,pfi_name,default_pfi_treatment_type_id", [("a", "3", "b", "T")])
    assert rows(protection.target_links(t)) == [("a", 3, "b", "T")]


def cells(spark, sheets):
    data = [(s, n, col, v) for s, lines in sheets.items() for n, line in lines.items() for col, v in line.items()]
    return spark.createDataFrame(data, "sheet string, row int, col string, value string")


def test_workflows(spark):
    book = cells(spark, {
        "S1": {
            2: {"A": "plant", "B": "wheat", "C": "bio", "D": "L'itinéraire", "E": "2020-10-05", "F": "hectare", "I": "250.7"},
            4: {"A": "1", "B": "Labour", "F": "plowing", "G": "driver", "H": "tool", "I": "tractor", "J": "1,5", "K": "h"},
            5: {"A": "1", "B": "Labour", "F": "plowing", "G": "helper", "H": "doer", "I": "worker", "J": "2", "K": "h"},
            6: {"A": " "}, 7: {"A": "2", "B": "Semis", "C": "3", "D": "monthly", "F": "sowing", "L": "09"},
        }
    })
    w = workflows.workflows(book).collect()[0]
    assert w["reference_name"] == "plant_wheat_bio_S1" and (w["start_day"], w["start_month"], w["plant_density"]) == (5, 10, 250)
    assert (w["life_state"], w["life_cycle"]) == ("1", "annual")
    assert rows(workflows.workflow_translations(book), "id", "fra") == [("technical_workflows_plant_wheat_bio_S1", "L itinéraire")]
    p = rows(workflows.procedures(book), "reference_name", "position", "repetition", "frequency", "period", "bbch_stage")
    assert p == [("plant_wheat_bio_S1_Labour_1", 1, 1, "per_year", "0", "-"), ("plant_wheat_bio_S1_Semis_2", 2, 3, "monthly", "0", "09")]
    i = rows(workflows.procedure_items(book), "reference_name", "quantity", "procedure_reference")
    assert i == [("plant_wheat_bio_S1_Labour_1_doer_worker", Decimal("2.0000"), "Labour"), ("plant_wheat_bio_S1_Labour_1_tool_tractor", Decimal("1.5000"), "Labour")]


def test_sequences(spark):
    book = cells(spark, {"rot": {2: {"A": "plant", "B": "wheat", "C": "bio", "D": "T'"}, 4: {"A": "1", "B": "2", "C": "bio_S1"}, 5: {"B": "9"}}})
    assert rows(workflows.sequences(book), "reference_name", "translation_id") == [("rot", "technical_sequences_rot")]
    assert rows(workflows.sequence_steps(book)) == [("rot", 1, 2, "plant_wheat_bio_S1")]
    assert rows(workflows.sequence_translations(book), "id", "eng") == [("technical_sequences_rot", "T ")]


def test_intervention_models(spark):
    book = cells(spark, {"cat": {
        2: {"A": "1", "B": "Labour", "C": "plowing", "D": "a,b", "E": "tool", "F": "x", "J": "2.5", "K": "ha/h"},
        3: {"A": "2", "B": "Labour", "C": "plowing", "D": "a,b", "E": "doer", "F": "y", "G": "mass", "H": "3"}, 4: {"A": "3", "D": "c", "E": "z"},
    }})
    m = rows(workflows.models(book), "reference_name", "number", "procedure_reference", "working_flow", "working_flow_unit")
    assert m == [("a_b", "1", "plowing", Decimal("2.5000"), "ha/h"), ("c", "3", "", Decimal("0.0000"), "")]
    i = rows(workflows.model_items(book), "reference_name", "indicator_name", "indicator_value")
    assert i == [("a_b_doer_y", "mass", Decimal("3.0000")), ("a_b_tool_x", "", Decimal("0.0000")), ("c_z_", "", Decimal("0.0000"))]


def test_budgets(spark):
    b = workflows.budgets(cells(spark, {"fam": {2: {"A": "in", "C": "v", "F": "2", "H": "3", "I": "1,25", "J": "10"}, 3: {"C": "skipped"}}}))
    assert rows(b, "activity_family", "repetition", "start_month", "quantity", "unit_pretax_amount", "tax_rate") == [
        ("fam", 2, 3, Decimal("1.25"), Decimal("10.00"), Decimal("0.00"))
    ]


def test_contracts_and_protection_prices(raw):
    names = "reference_name,worker_variant,salaried,contract_end,legal_monthly_working_time,legal_monthly_offline_time,min_raw_wage_per_hour,salary_charges_ratio,farm_charges_ratio,fra,eng"
    c = raw(names, [("perm", "worker", "true", None, "151.67", "0", "10.15", "0.2", "0.4", "Permanent", "Permanent")])
    assert rows(prices.contracts(c), "salaried", "legal_monthly_working_time", "translation_id") == [(True, Decimal("151.67"), "worker_contracts_perm")]
    assert rows(prices.contract_translations(c), "id") == [("worker_contracts_perm",)]
    p = raw("n,name,article_id,price,currency,packaging,date", [("4", "x", "2090141", "9.99", "euro", "l", "05/03/2021")])
    assert rows(prices.protection_prices(p), "id", "reference_article_name", "started_on") == [("PH4", 2090141, dt.date(2021, 3, 5))]


def test_codes_states_and_translations(spark, raw):
    caps = raw("cap_code,cap_label,production,cap_precision,cap_category,is_seed,year", [("BTH", "Blé", "wheat", None, "1.1", "1", "2023"), ("X", "y", "z", None, None, None, "2024")])
    assert rows(productions.subsidy_codes(caps), "cap_code", "cap_category", "is_seed", "year") == [("BTH", "1.1", True, 2023), ("X", None, False, 2024)]
    assert rows(productions.start_states(raw("production,year,key", [("p", "2", "k")]))) == [("p", 2, "k")]
    assert rows(productions.treatment_codes(raw("tfi_code,tfi_label,production,tfi_crop_group", [("1", "a", "b", "c")])), "campaign") == [(2020,)]
    sna = raw("reference_name,nature,fra,eng,parent", [("hedge", "line", "Haie", "Hedge", None)])
    assert rows(productions.land_features(sna), "translation_id") == [("sna_codes_hedge",)]
    table = registers.translations(None, {"sna_codes": productions.production_translations({"sna_codes": sna})})
    fresh = keyed.translations(raw("reference_name,fra,eng", [("ditch", "Fossé", "Ditch")]), "sna_codes")
    assert rows(registers.translations(table, {"sna_codes": fresh}), "id", "fra") == [("sna_codes_ditch", "Fossé")]


def test_price_feeds(raw):
    zones = raw("department,region", [("17", "FRANCE"), ("33", "FRANCE")])
    milk = raw(
        "year,month,zone,production_label,specie,waiting_price,final_price,price_unit,product_output_specie,organic",
        [("2020", "3", "France", "Lait", "bos", "1,5", "2,555", "l", "milk", "true"), ("2020", "4", "France", "Lait", "bos", "S.", "2", "l", "milk", "true"),
         ("2020", "5", "France", "Lait", "bos", None, "2", "l", "milk", "false")],
    )
    ship = raw(
        "started_on,campaign,zone,production_label,specie,waiting_price,final_price,price_unit,product_output_specie",
        [("09/04/2021", "2021", "france", "Blé", "triticum", "0", "200,1", "ton", "grain")],
    )
    out = productions.production_prices({"milk_cow_prices": milk, "crop_shipping_price": ship}, zones)
    assert rows(out, "department_zone", "started_on", "nature", "price_duration_months", "price_duration_days", "final_price", "organic") == sorted([
        (d, dt.date(2020, 3, 1), None, 1, 0, Decimal("2.56"), True) for d in ("17", "33")
    ] + [(d, dt.date(2021, 4, 9), "shipping_price", 0, 1, Decimal("200.10"), None) for d in ("17", "33")], key=repr)


def test_variants_details(raw):
    groups = raw("reference_name,category,nature,derivative_of,sex,reproductor,pictogram", [("g", "c", "n", "bos", "male", None, "p")])
    seeds = raw("reference_name,nature,default_unit,target_specie,pmg", [("s1", "n", "u", None, None), ("s2", "n", "u", None, "40")])
    got = {r["reference_name"]: r for r in variants.variants({"animal_groups": groups, "seeds_and_plants": seeds}).collect()}
    assert got["g"]["indicators"] == {"sex ": "male", "reproductor ": ""} and got["g"]["specie"] == "animal_group"
    assert got["s1"]["indicators"] == {"thousand_grains_mass": "50gram"} and got["s2"]["indicators"] == {"thousand_grains_mass": "40gram"}
    n = raw("reference_name,family,population_counting,frozen_indicators,variable_indicators,abilities,variety,derivative_of,pictogram", [("n", "f", "d", "a, b", None, "", "v", None, None)])
    r = variants.natures(n).collect()[0]
    assert (r["frozen_indicators"], r["variable_indicators"], r["abilities"]) == (["a", "b"], [], [])
    cols = "reference_name,family,fixed_asset_account,fixed_asset_allocation_account,fixed_asset_expenses_account,depreciation_percentage,charge_account,product_account,stock_account,stock_movement_account,default_vat_rate,payment_frequency_value,payment_frequency_unit,pictogram"
    c = raw(cols, [("c", "f", None, None, None, "20", "60", "70", None, None, "5.5", "1", "per_year", None)])
    assert rows(variants.categories(c), "purchase_account", "sale_account", "default_vat_rate", "payment_frequency_value") == [("60", "70", Decimal("5.50"), 1)]


def test_units_and_dimensions(raw):
    assert rows(units.dimensions(raw("reference_name,symbol", [("mass", "kg")]))) == [("mass", "kg", "dimensions_mass")]
    assert rows(units.packagings(raw("reference_name,capacity,capacity_unit", [("bag", "0.5", "kg")])), "capacity") == [(Decimal("0.5000000000"),)]


def test_area_items_only_metropolitan(spark):
    schema = f"id string, nature string, department string, srid int, geom {MULTILINE}"
    hedge = spark.createDataFrame([("h", "x", "D017", 4326, [[(0.0, 0.0), (2.0, 0.0)]]), ("h", "x", "D971", 4326, [[(0.0, 0.0), (2.0, 0.0)]])], schema)
    green = spark.createDataFrame([("g", "bois", "D017", 4326, [[ring(0, 0, 2, 2)], [ring(9, 9, 1, 1)]])], schema.replace(MULTILINE, MULTIPOLYGON))
    pylon = spark.createDataFrame([("p", "y", "D017", 4326, [(1.0, 5.0)]), ("q", "y", "D017", 4326, [])], schema.replace(MULTILINE, f"array<{POINT}>"))
    layers = {"hedge": hedge, "green_zone": green, "pylon": pylon}
    got = {r["id"]: (r["nature"], r["name"], tuple(r["centroid"])) for r in hydrography.area_items(layers).collect()}
    assert got == {
        "h_fra_D017": ("edge", {"fra": "haie"}, (1.0, 0.0)), "g_fra_D017": ("green_zone", {"fra": "bois"}, (1.0, 1.0)),
        "p_fra_D017": ("electric_pole", {"fra": "pylone"}, (1.0, 5.0)),
    }
    assert hydrography.area_items(layers, all_parts=True).count() == 4


def test_hourly_written_by_month(spark, raw, tmp_path):
    cols = "num_poste,nom_usuel,lat,lon,alti,aaaammjjhh,t,tn,tx,rr1,fxi,dxi,dg,u,sol,pstat,ww"
    one = ("17001001", "A", "45.8", "-0.7", "9", "2020013123", "1.5", *[None] * 10)
    h = weather.hourly(raw(cols, [one, one, ("17001001", "A", "45.8", "-0.7", "100", "2020020100", *[None] * 11)]))
    assert h.count() == 3
    weather.write_hourly(h, str(tmp_path / "h"))
    back = spark.read.parquet(str(tmp_path / "h"))
    assert rows(back.groupBy("month").count()) == [("2020-01", 2), ("2020-02", 1)]
    s = weather.stations(raw(cols, [one, ("17001001", "A", "45.8", "-0.7", "100", "2020020100", *[None] * 11)]))
    assert rows(s, "reference_name", "country_zone", "elevation") == [("FR17001001", "17", 100)]


def test_market_keys(raw):
    p = raw("product_code,memberStateCode,beginDate,endDate,productName,marketName,stageName,unit,price", [
        ("BLTPAN", "FR", "01/02/2020", "07/02/2020", "Blé", "L'ouest", "Farm", "TONNES", "€1,234.5"),
        ("BLTPAN", "FR", "01/02/2020", "07/02/2020", "Blé", "Est", "Farm", "TONNES", "€198.4"), ("MAI", "FR", "01/02/2020", None, "Maïs", "x", None, "?", None),
    ])
    assert rows(market.market_prices(p), "id", "price", "product_label", "unit_name") == [("BLTPAN_FR_2020-02-01", Decimal("198.40"), "Blé Est", "ton")]
    assert market.market_prices(p, extended_key=True).count() == 2
    assert Decimal("1.00") in {r[0] for r in rows(market.market_prices(p, extended_key=True), "price")}


def test_enterprise_spaced_address(raw):
    e = "_etablissement"
    cols = ["siret"] + [f"{c}{e}" for c in (
        "activite_principale", "enseigne1", "enseigne2", "enseigne3", "denomination_usuelle", "numero_voie", "indice_repetition", "type_voie",
        "libelle_voie", "code_postal", "libelle_commune", "coordonnee_lambert_abscisse", "coordonnee_lambert_ordonnee",
    )]
    df = raw(",".join(cols), [("1", "01.11Z", None, "B", None, None, "12", None, "-", "DU PORT", "17250", "X", "700000", "6600000")])
    r = market.enterprises(df, spaced_address=True).collect()[0]
    assert (r["name"], r["address"]) == ("B", "12 DU PORT")
    assert (r["centroid"]["x"], r["centroid"]["y"]) == (pytest.approx(3.0), pytest.approx(46.5))
    assert market.enterprises(df.withColumn("coordonnee_lambert_abscisse_etablissement", F.lit("[ND]"))).collect()[0]["centroid"] is None


def test_sales_ids_are_unique(raw):
    cols = "id_mutation,date_mutation,numero_disposition,nature_mutation,valeur_fonciere,type_local,adresse_numero,adresse_nom_voie,code_postal,nom_commune,code_departement,id_parcelle,surface_reelle_bati,surface_terrain,latitude,longitude"
    same = ("m", "2020-01-02", "1", "Vente", "1000.5", None, None, "RUE", "17250", "X", "17", "p", None, "50", "45.8", "-0.7")
    s = land.sales(raw(cols, [same] * 5).repartition(3))
    assert s.select("id").distinct().count() == 5
    assert set(rows(s, "address", "centroid.x", "centroid.y")) == {("RUE", -0.7, 45.8)}


def test_compact_extracts(spark, raw):
    nomen = spark.createDataFrame([("wheat", {"fra": "Blé", "eng": "Wheat"}), ("oat", {"fra": "Avoine"}), ("rye", {"fra": "Seigle"})], "name string, label map<string,string>")
    seeds = spark.createDataFrame([("wheat",), ("wheat",), ("oat",)], "id_specie string")
    assert rows(compact.species(nomen, seeds), sort=False) == [("oat", "Avoine", None), ("wheat", "Blé", "Wheat")]
    doses = spark.createDataFrame([(1, 2.0, "liter_per_hectare"), (1, 1.0, "liter"), (2, 9.0, "kilogram")], "product_id int, dose_quantity double, dose_unit string")
    assert rows(compact.smallest_doses(doses)) == [(1, 1.0)]


def test_label_tables_not_called_by_default(raw):
    table = raw("label,normalized,ratio", [("L/HA", "liter_per_hectare", "1"), ("G/HA", "gram_per_hectare", "0.1")])
    out = registers.normalised_labels(raw("u", [("L/HA",), ("?",)]), "u", table, "unit")
    assert rows(out, "u", "unit", "unit_ratio") == [("?", None, None), ("L/HA", "liter_per_hectare", "1")]


def test_agro_codes(raw):
    assert rows(registers.edi_codes(raw("repository_id,reference_id,reference_code,reference_label,s,v", [("1", "2", "c", "l", "x", "y")]), "s", "v")) == [(1, 2, "c", "l", "x", "y")]
    assert rows(registers.edi_crops(raw("agroedi_code,agroedi_name,production", [("ZAA", "Blé", None)]))) == [("ZAA", "Blé", None)]


def test_load_of_the_catalogue(spark, catalogue, raw):
    """One call does all steps in order; a missing file leaves out its step and table, an unknown one is an error."""
    bare = protection.load(catalogue, {})
    assert sorted(t.removeprefix("registered_phytosanitary_") for t in bare) == ["products", "risks", "usages"]
    usages = bare["registered_phytosanitary_usages"].collect()
    assert {u["species"][0] for u in usages} == {"plant"} and all(u["record_checksum"] is not None for u in usages)
    permits = "n_permis,nom_du_produit,nom_du_produit_importe,produit_de_reference_francais,detenteur_pcp,n_amm_de_reference_francais"
    full = protection.load(catalogue, {
        "parallel_trade": raw(permits, [("900", "COPY!", "A", "R", "H", "2090141")]),
        "cropsets": raw("n,name,label_fr,crop_names,crop_labels_fr", [("1", "zea, sorghum", "Maïs", "a, b", None)]),
        "exceptions": raw("crop_label,species", [("Blé", "triticum")]),
        "symbols": raw("mention_danger,description_danger,code_pictogramme", [("H1", "d", "GHS")]),
    }, store=False)
    assert len(full) == 5
    got = {u["crop_label_fra"]: u["species"] for u in full["registered_phytosanitary_usages"].collect()}
    assert got == {"Blé": ["triticum"], "Maïs": ["zea", "sorghum"]}
    products = {p["id"]: p for p in full["registered_phytosanitary_products"].collect()}
    assert products[900]["natures"] == ["Herbicide"] and products[900]["record_checksum"] is not None
    empty = protection.load(catalogue.limit(0), {"cropsets": raw("n,name,label_fr,crop_names,crop_labels_fr", [])}, store=False)
    assert all(df.count() == 0 for df in empty.values()) and len(empty) == 4
    with pytest.raises(ValueError):
        protection.load(catalogue, {"cropset": catalogue})


def test_compact_products_and_extracts(spark):
    extra = spark.createDataFrame([(1, "x")], "id int, other string")
    with pytest.raises(ValueError):
        compact.products(extra)
    assert compact.products(extra.select("id")).columns == protection.PRODUCTS.schema.fieldNames()
