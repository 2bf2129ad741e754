"""Data set plans run over raw inputs that Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from agrimill.functions import geometry as geo
from agrimill.operators.aggregates import min_text
from agrimill.plans import compact, hydrography, land, market, prices, productions, protection, registers, units, variants, weather, workflows
from driver_queries.registry import Tables, query
from driver_queries.spatial import lambert_sql, pt, quad

c = F.col


def txt(col):
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def money(col):
    return txt(F.col(col).cast("decimal(14,2)"))


def point_text(p: str, digits: int = 6):
    return F.round(f"{p}.x", digits), F.round(f"{p}.y", digits)


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS mutation_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS mutation_date,
  CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS cadastral_price,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_custkey % 90 AS VARCHAR) END || o_orderpriority AS address,
  CASE WHEN o_orderstatus <> 'F' THEN o_custkey % 500 END AS building_area, CAST(o_custkey % 60 AS DOUBLE) / 10 AS x,
  CASE WHEN o_orderstatus <> 'O' THEN 40 + CAST(o_orderkey % 100 AS DOUBLE) / 10 END AS y
FROM orders
""")
def d_land_sales(t: Tables):
    raw = t.orders.select(
        txt("o_orderkey").alias("id_mutation"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_mutation"),
        F.lit("1").alias("numero_disposition"), F.lit("Vente").alias("nature_mutation"), money("o_totalprice").alias("valeur_fonciere"),
        F.lit("Maison").alias("type_local"), F.when(c("o_orderstatus") != "P", txt(c("o_custkey") % 90)).alias("adresse_numero"),
        c("o_orderpriority").alias("adresse_nom_voie"), F.lit("17250").alias("code_postal"), F.lit("X").alias("nom_commune"),
        F.lit("17").alias("code_departement"), txt("o_custkey").alias("id_parcelle"),
        F.when(c("o_orderstatus") != "F", txt(c("o_custkey") % 500)).alias("surface_reelle_bati"), F.lit("10").alias("surface_terrain"),
        F.when(c("o_orderstatus") != "O", txt(F.lit(40) + (c("o_orderkey") % 100).cast("double") / 10)).alias("latitude"),
        txt((c("o_custkey") % 60).cast("double") / 10).alias("longitude"),
    )
    known = c("centroid").isNotNull()
    s = land.sales(raw)
    x = F.coalesce(c("centroid.x"), (c("cadastral_parcel_id").cast("bigint") % 60).cast("double") / 10)
    return s.select(
        "mutation_id", txt("mutation_date").alias("mutation_date"), c("cadastral_price").cast("double").alias("cadastral_price"), "address",
        c("building_area").cast("bigint").alias("building_area"), x.alias("x"), F.when(known, c("centroid.y")).alias("y"),
    )


@query("""
WITH p AS (SELECT *, p_brand || p_type AS id, row_number() OVER (PARTITION BY p_brand || p_type ORDER BY CASE WHEN p_size < 20 THEN '0' ELSE p_name END, CAST(p_partkey AS VARCHAR)) AS rn FROM part)
SELECT id, CASE WHEN p_size < 20 THEN '0' ELSE p_name END AS section, CAST(p_size AS BIGINT) AS net_surface_area,
       CAST(p_partkey % 50 AS DOUBLE) + 1 AS cx, CAST(p_size AS DOUBLE) + 1 AS cy FROM p WHERE rn = 1 AND p_size % 3 <> 0
""")
def d_land_parcels(t: Tables):
    """Features of repeated ids: the first stays, bow ties are dropped after that."""
    x, y = (c("p_partkey") % 50).cast("double"), c("p_size").cast("double")
    two = F.lit(2.0)
    r = F.when(c("p_size") % 3 == 0, quad(x, y, two, two, bow=True)).otherwise(quad(x, y, two, two))
    features = t.wide("part", "p_partkey", "p_brand", "p_type", "p_size", "p_name").select(
        F.concat("p_brand", "p_type").alias("id"), F.lit("17001").alias("commune"), F.lit("000").alias("prefixe"),
        F.when(c("p_size") < 20, "0").otherwise(c("p_name")).alias("section"), txt("p_partkey").alias("numero"),
        c("p_size").cast("double").alias("contenance"), F.array(F.array(r)).alias("shape"),
    )
    p = land.parcels(features)
    return p.select("id", "section", c("net_surface_area").cast("bigint").alias("net_surface_area"), c("centroid.x").alias("cx"), c("centroid.y").alias("cy"))


@query("""
WITH r AS (SELECT *, CASE l_returnflag WHEN 'A' THEN 'BLTPAN' WHEN 'N' THEN 'MAI' ELSE 'TRI' END AS code, 'S' || (l_suppkey % 7) AS country,
  'Produit ' || 'Marche d''ici ' || l_linestatus AS label0, CAST(floor(l_extendedprice / 1000) AS DOUBLE) AS price FROM lineitem WHERE l_quantity > 2),
k AS (SELECT code || '_' || country || '_' || CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS id, code,
  replace(label0, '''', '') AS product_label, l_linestatus, price FROM r),
f AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY product_label, price) AS rn FROM k)
SELECT code AS product_code, count(*) AS n, count(DISTINCT id) AS n_ids, min(id) AS first_id, CAST(sum(CAST(price AS DECIMAL(8,2))) AS DOUBLE) AS total, min(product_label) AS product_label,
  CASE code WHEN 'BLTPAN' THEN 'triticum_aestivum' WHEN 'MAI' THEN 'zea_mays' ELSE 'x_triticosecale' END AS specie
FROM f WHERE rn = 1 GROUP BY code
""")
def d_market_prices(t: Tables):
    code = F.when(c("l_returnflag") == "A", "BLTPAN").when(c("l_returnflag") == "N", "MAI").otherwise("TRI")
    day = F.date_format("l_shipdate", "dd/MM/yyyy")
    price = F.concat(F.lit("€"), txt(F.floor(c("l_extendedprice") / 1000)))
    payload = t.wide("lineitem", "l_returnflag", "l_linestatus", "l_shipdate", "l_suppkey", "l_quantity", "l_extendedprice").select(
        code.alias("product_code"), F.concat(F.lit("S"), txt(c("l_suppkey") % 7)).alias("memberStateCode"), day.alias("beginDate"),
        F.lit(None).cast("string").alias("endDate"), F.lit("Produit").alias("productName"),
        F.concat(F.lit("Marche d'ici "), "l_linestatus").alias("marketName"), F.lit(None).cast("string").alias("stageName"),
        F.lit("TONNES").alias("unit"), F.when(c("l_quantity") > 2, price).alias("price"),
    )
    p = market.market_prices(payload)
    return p.groupBy("product_code", "specie").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_ids"), F.min("id").alias("first_id"),
        F.sum("price").cast("double").alias("total"), F.min("product_label").alias("product_label"),
    )


RAW_WEATHER = {"tn": None, "tx": None, "rr1": None, "fxi": None, "dxi": None, "dg": None, "u": None, "sol": None, "pstat": None, "ww": None}


def raw_weather(t: Tables):
    missing = [F.lit(None).cast("string").alias(k) for k in RAW_WEATHER if k != "tx"]
    return t.events.select(
        F.concat(F.lit(" "), F.lpad(txt("user_id"), 5, "0"), F.lit(" ")).alias("num_poste"), F.concat(F.lit("ST "), "event_type").alias("nom_usuel"),
        txt((c("user_id") % 40).cast("double") / 10 + 40).alias("lat"), txt((c("user_id") % 30).cast("double") / 10).alias("lon"),
        txt(F.floor("value")).alias("alti"), F.date_format("ts", "yyyyMMddHH").alias("aaaammjjhh"),
        F.when(c("event_type") != "view", txt(c("value").cast("decimal(10,2)"))).alias("t"), txt(c("event_id") % 40).alias("tx"), *missing,
    )


@query("""
WITH g AS (SELECT user_id, event_type, min(CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)) AS alti FROM events GROUP BY 1, 2),
f AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type) AS rn FROM g)
SELECT 'FR' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS reference_name, substr(lpad(CAST(user_id AS VARCHAR), 5, '0'), 1, 2) AS country_zone,
       'ST ' || event_type AS station_name, CAST(alti AS BIGINT) AS elevation, CAST(user_id % 30 AS DOUBLE) / 10 AS x,
       CAST(user_id % 40 AS DOUBLE) / 10 + 40 AS y FROM f WHERE rn = 1
""")
def d_weather_stations(t: Tables):
    s = weather.stations(raw_weather(t))
    x, y = point_text("centroid", 9)
    return s.select("reference_name", "country_zone", "station_name", c("elevation").cast("bigint").alias("elevation"), x.alias("x"), y.alias("y"))


@query("""
SELECT 'FR' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS station_id, strftime(ts, '%Y-%m-%d %H:00:00') AS started_at, 60 AS delay_minutes,
  CASE WHEN event_type <> 'view' THEN CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) END AS average_temp, CAST(event_id % 40 AS DOUBLE) AS max_temp FROM events
""")
def d_weather_hourly(t: Tables):
    h = weather.hourly(raw_weather(t))
    minutes = (F.extract(F.lit("HOUR"), "mesured_delay") * 60 + F.extract(F.lit("MINUTE"), "mesured_delay")).cast("bigint")
    return h.select(
        "station_id", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss").alias("started_at"), minutes.alias("delay_minutes"),
        c("average_temp").cast("double").alias("average_temp"), c("max_temp").cast("double").alias("max_temp"),
    )


_ELON, _ELAT = lambert_sql("(300000 + c_custkey * 7.0e0)", "(6300000 + c_acctbal)")


@query(f"""
SELECT CAST(c_custkey AS VARCHAR) AS establishment_number, CASE WHEN c_nationkey > 10 THEN c_name ELSE 'usual' END AS name,
  '12' || CASE WHEN c_nationkey > 20 THEN 'B' ELSE '' END || 'RUE' || c_mktsegment AS address,
  CASE WHEN c_acctbal > 0 THEN round({_ELON}, 6) END AS lon, CASE WHEN c_acctbal > 0 THEN round({_ELAT}, 6) END AS lat
FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE')
""")
def d_enterprises(t: Tables):
    e = "_etablissement"
    code = F.when(c("c_mktsegment") == "BUILDING", "01.11Z").when(c("c_mktsegment") == "MACHINERY", "01.5Z")
    code = code.when(c("c_mktsegment") == "FURNITURE", "03.22Z").otherwise("47.11A")
    lit = F.lit(None).cast("string")
    raw = t.customer.select(
        txt("c_custkey").alias("siret"), code.alias(f"activite_principale{e}"),
        F.when(c("c_nationkey") > 10, c("c_name")).alias(f"enseigne1{e}"), lit.alias(f"enseigne2{e}"), lit.alias(f"enseigne3{e}"),
        F.lit("usual").alias(f"denomination_usuelle{e}"), F.lit("12").alias(f"numero_voie{e}"),
        F.when(c("c_nationkey") > 20, "B").alias(f"indice_repetition{e}"), F.lit("RUE").alias(f"type_voie{e}"),
        c("c_mktsegment").alias(f"libelle_voie{e}"), F.lit("17250").alias(f"code_postal{e}"), F.lit("X").alias(f"libelle_commune{e}"),
        F.when(c("c_acctbal") > 0, txt(F.lit(300000) + c("c_custkey") * 7)).otherwise("[ND]").alias(f"coordonnee_lambert_abscisse{e}"),
        F.when(c("c_acctbal") > 0, txt(F.lit(6300000) + c("c_acctbal"))).otherwise("[ND]").alias(f"coordonnee_lambert_ordonnee{e}"),
    )
    out = market.enterprises(raw)
    x, y = point_text("centroid")
    return out.select("establishment_number", "name", "address", x.alias("lon"), y.alias("lat"))


_PLON, _PLAT = lambert_sql("(600500.0e0 + 1000 * n_nationkey)", "6500500.0e0")


@query(f"""
SELECT CAST(c_nationkey AS VARCHAR) || '_' || CAST(c_custkey AS VARCHAR) || '_' || substr(replace('RUE ' || c_mktsegment, ' ', ''), 1, 6) || '_' ||
  CASE WHEN c_nationkey > 3 THEN substr(c_name, 1, 12) ELSE '' END AS id, 'L''' || n_name || ' D''' || c_mktsegment AS city_name,
  CASE WHEN n_regionkey <> 4 THEN round({_PLON}, 3) END AS cx, CASE WHEN n_regionkey <> 4 THEN round({_PLAT}, 3) END AS cy
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def d_postal_codes(t: Tables):
    named = t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey"))
    raw = named.select(
        txt("c_nationkey").alias("code_commune_insee"), txt("c_custkey").alias("code_postal"),
        F.concat(F.lit("L "), "n_name", F.lit(" D "), "c_mktsegment").alias("nom_de_la_commune"),
        F.concat(F.lit("RUE "), "c_mktsegment").alias("libelle_d_acheminement"), F.when(c("c_nationkey") > 3, c("c_name")).alias("ligne_5"),
    )
    x = F.lit(600000.0) + c("n_nationkey") * 1000
    k = F.lit(1000.0)
    communes = t.nation.filter("n_regionkey <> 4").select(
        txt("n_nationkey").alias("insee_com"), F.array(F.array(quad(x, F.lit(6500000.0), k, k))).alias("geom")
    )
    p = land.postal_codes(raw, communes)
    cx, cy = point_text("city_centroid", 3)
    return p.select("id", "city_name", cx.alias("cx"), cy.alias("cy"))


# Springs come before surfaces, surfaces before courses: ids shared by brand and size meet.
@query("""
WITH i AS (SELECT p_brand || '_' || p_size AS k, CAST(p_size AS DOUBLE) AS y, p_partkey, p_type FROM part WHERE p_type IN ('SMALL', 'LARGE', 'PROMO')),
f AS (SELECT *, CASE p_type WHEN 'SMALL' THEN 0 WHEN 'LARGE' THEN 1 ELSE 2 END AS rank FROM i),
g AS (SELECT k, min(rank) AS rank, max(y) AS y FROM f GROUP BY k)
SELECT k || '_fra_D017' AS id, CASE rank WHEN 0 THEN 'source' WHEN 1 THEN 'etang' ELSE 'ruisseau' END AS nature,
  CASE rank WHEN 0 THEN 'nom ' || k WHEN 2 THEN 'cours' END AS name,
  CASE rank WHEN 0 THEN y WHEN 1 THEN y + 1 ELSE y + 1.5 END AS cx, CASE rank WHEN 1 THEN y + 1 ELSE y END AS cy FROM g
""")
def d_water_items(t: Tables):
    y = c("p_size").cast("double")
    base = t.part.select(
        F.concat("p_brand", F.lit("_"), txt("p_size")).alias("id"), F.lit("D017").alias("department"), F.lit(4326).alias("srid"), "p_type",
        y.alias("y"),
    )
    two = F.lit(2.0)
    far = quad(c("y") + 50, c("y"), two, two)
    layers = {
        "detail": base.filter("p_type = 'SMALL'").select(
            "id", F.lit("source").alias("nature"), F.concat(F.lit("nom "), "id").alias("toponyme"), "department", "srid",
            F.array(pt(c("y"), c("y"))).alias("geom"),
        ),
        "surface": base.filter("p_type = 'LARGE'").select(
            "id", F.lit("etang").alias("nature"), F.lit(None).cast("string").alias("nom_p_eau"), "department", "srid",
            F.array(F.array(quad(c("y"), c("y"), two, two)), F.array(far)).alias("geom"),
        ),
        "course": base.filter("p_type = 'PROMO'").select(
            "id", F.lit("ruisseau").alias("nature"), F.lit("cours").alias("nom_c_eau"), "department", "srid",
            F.array(F.array(pt(c("y"), c("y")), pt(c("y") + 3, c("y")))).alias("geom"),
        ),
    }
    w = hydrography.water_items(layers)
    return w.select("id", "nature", F.element_at("name", F.lit("fra")).alias("name"), c("centroid.x").alias("cx"), c("centroid.y").alias("cy"))


@query("""
SELECT reference_name, count(*) AS n_parts, round(sum(cx), 3) AS sx, round(sum(cy), 3) AS sy FROM (
  SELECT p_brand AS reference_name, CAST(p_size AS DOUBLE) + 1 AS cx, CAST(p_partkey % 70 AS DOUBLE) + 1 AS cy FROM part
  UNION ALL SELECT p_brand, CAST(p_size AS DOUBLE) + 20.5, CAST(p_partkey % 70 AS DOUBLE) + 0.5 FROM part WHERE p_type <> 'PROMO') GROUP BY 1
""")
def d_buildings(t: Tables):
    """Two parts per building; a bow tie as second part is dropped."""
    x, y = c("p_size").cast("double"), (c("p_partkey") % 70).cast("double")
    one, two = F.lit(1.0), F.lit(2.0)
    second = F.when(c("p_type") == "PROMO", quad(x + 20, y, one, one, bow=True)).otherwise(quad(x + 20, y, one, one))
    raw = t.wide("part", "p_partkey", "p_brand", "p_type", "p_size").select(
        c("p_brand").alias("id"), c("p_type").alias("usage1"), F.lit(4326).alias("srid"), F.array(F.array(quad(x, y, two, two)), F.array(second)).alias("geom")
    )
    b = hydrography.buildings(raw)
    return b.groupBy("reference_name").agg(
        F.count(F.lit(1)).alias("n_parts"), F.round(F.sum("centroid.x"), 3).alias("sx"), F.round(F.sum("centroid.y"), 3).alias("sy")
    )


@query("""
WITH p AS (SELECT o_orderkey AS id, CAST(o_orderkey % 61 AS DOUBLE) / 2 AS x, CAST(o_custkey % 41 AS DOUBLE) / 2 AS y FROM orders),
t AS (SELECT n_name, CAST(n_nationkey % 5 AS DOUBLE) * 6 AS x, CAST(n_nationkey // 5 AS DOUBLE) * 4 AS y FROM nation WHERE n_regionkey <> 2)
SELECT CAST(p.id AS VARCHAR) AS id, round(p.x + 0.1, 6) AS cx, round(p.y + 0.1, 6) AS cy, min(t.n_name) AS city_name
FROM p LEFT JOIN t ON p.x + 0.1 BETWEEN t.x AND t.x + 6 AND p.y + 0.1 BETWEEN t.y AND t.y + 4 GROUP BY ALL
""")
def d_farm_parcels(t: Tables):
    x, y = (c("o_orderkey") % 61).cast("double") / 2, (c("o_custkey") % 41).cast("double") / 2
    side = F.lit(0.2)
    raw = t.wide("orders", "o_orderkey", "o_custkey", "o_orderpriority").select(
        txt("o_orderkey").alias("id_parcel"), c("o_orderpriority").alias("code_cultu"), F.lit(4326).alias("srid"),
        F.array(F.array(quad(x, y, side, side))).alias("geom"),
    )
    cx, cy = (c("n_nationkey") % 5).cast("double") * 6, F.floor(c("n_nationkey") / 5).cast("double") * 4
    cities = t.nation.filter("n_regionkey <> 2").select(
        c("n_name").alias("nom_com"), F.array(F.array(quad(cx, cy, F.lit(6.0), F.lit(4.0)))).alias("geom")
    )
    p = land.farm_parcels(raw, cities, cell=2.0)
    px, py = point_text("centroid")
    return p.select("id", px.alias("cx"), py.alias("cy"), "city_name")


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_type IN ('SMALL', 'LARGE') THEN p_size % 10 END AS class,
  CASE WHEN p_type IN ('SMALL', 'LARGE') THEN CASE p_size % 10 WHEN 1 THEN 50e0 WHEN 2 THEN 100e0 WHEN 3 THEN 150e0 WHEN 4 THEN 200e0 WHEN 5 THEN 300e0 WHEN 9 THEN 0e0 END END AS high,
  CASE WHEN p_brand = 'Brand#1' THEN NULL ELSE CAST(p_size AS DOUBLE) + 1 END AS cx,
  CASE WHEN p_type IN ('SMALL', 'LARGE') THEN 'millimeter' ELSE 'centimeter' END AS unit,
  CASE WHEN p_type NOT IN ('SMALL', 'LARGE') THEN CAST(p_size AS DOUBLE) END AS depth FROM part
""")
def d_soil(t: Tables):
    x, two = c("p_size").cast("double"), F.lit(2.0)
    r = F.when(c("p_brand") == "Brand#1", quad(x, x, two, two, bow=True)).otherwise(quad(x, x, two, two))
    base = t.wide("part", "p_partkey", "p_brand", "p_type", "p_size").select("p_partkey", "p_size", "p_type", F.array(F.array(r)).alias("geom"))
    w = land.soil_water(base.filter("p_type in ('SMALL', 'LARGE')").select(c("p_partkey").alias("reserve_id"), txt(c("p_size") % 10).alias("classe"), "geom"))
    d = land.soil_depths(base.filter("p_type not in ('SMALL', 'LARGE')").select(c("p_partkey").alias("prof_id"), txt("p_size").alias("pr_cl"), "geom"))
    w = w.select(
        "id", c("available_water_reference_value").cast("bigint").alias("class"), c("available_water_max_value").cast("double").alias("high"),
        c("centroid.x").alias("cx"), c("available_water_unit").alias("unit"), F.lit(None).cast("double").alias("depth"),
    )
    d = d.select(
        "id", F.lit(None).cast("bigint").alias("class"), F.lit(None).cast("double").alias("high"), c("centroid.x").alias("cx"),
        c("soil_depth_unit").alias("unit"), c("soil_depth_value").cast("double").alias("depth"),
    )
    return w.unionByName(d)


_ZLON, _ZLAT = lambert_sql("(500000.0e0 + 100 * p_partkey + 500)", "6600500.0e0")


@query(f"""
SELECT p_brand || p_partkey AS id, p_name AS name, CASE WHEN p_size < 25 THEN 'sic' ELSE 'zps' END AS nature, round({_ZLON}, 3) AS cx, round({_ZLAT}, 3) AS cy, NULL AS updated_on FROM part
UNION ALL SELECT CAST(n_nationkey AS VARCHAR), n_name, 'water', n_nationkey + 1.0, 2.0, '2020-05-' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') FROM nation
""")
def d_protected_zones(t: Tables):
    k = F.lit(1000.0)
    x = F.lit(500000.0) + c("p_partkey") * 100
    base = t.part.select(
        F.concat("p_brand", txt("p_partkey")).alias("sitecode"), c("p_name").alias("sitename"), "p_size",
        F.array(F.array(quad(x, F.lit(6600000.0), k, k))).alias("geom"),
    )
    n = land.natural_zones({"sic": base.filter("p_size < 25"), "zps": base.filter("p_size >= 25")})
    two = F.lit(2.0)
    day = F.concat(F.lit("2020-05-"), F.lpad(txt(c("n_nationkey") + 1), 2, "0"))
    w = land.water_zones(t.nation.select(
        c("n_nationkey").alias("gid"), c("n_name").alias("nomdeaac_1"), day.alias("datemajaac"), F.lit("a").alias("auteuraac"),
        F.lit("z").alias("nomcircadm"), F.array(F.array(quad(c("n_nationkey").cast("double"), F.lit(1.0), two, two))).alias("geom"),
    ))
    cx, cy = point_text("centroid", 3)
    n = n.select("id", "name", "nature", cx.alias("cx"), cy.alias("cy"), F.lit(None).cast("string").alias("updated_on"))
    return n.unionByName(w.select("id", "name", F.lit("water").alias("nature"), cx.alias("cx"), cy.alias("cy"), txt("updated_on").alias("updated_on")))


@query("""
WITH r AS (SELECT p_type || ' X' AS nom, CAST(p_size AS VARCHAR) AS permis, p_name AS importe, p_brand AS ref, CASE WHEN p_size > 25 THEN 'A' || p_size END AS amm FROM part)
SELECT nom AS name, permis, string_agg(DISTINCT importe, ' | ' ORDER BY importe) AS names, string_agg(DISTINCT ref, ' | ' ORDER BY ref) AS other_names_fra,
  lower(regexp_replace(regexp_replace(coalesce(amm, permis) || ' ' || nom, '[^a-zA-Z0-9]', '_', 'g'), '[^a-zA-Z0-9]$', '')) AS reference_name
FROM r GROUP BY nom, permis, amm
""")
def d_trade_permits(t: Tables):
    raw = t.part.select(
        F.concat("p_type", F.lit(" X")).alias("nom_du_produit"), txt("p_size").alias("n_permis"),
        F.concat(F.lit("\t "), "p_name", F.lit(" ")).alias("nom_du_produit_importe"), F.concat("p_brand", F.lit(" ")).alias("produit_de_reference_francais"),
        F.lit("H").alias("detenteur_pcp"), F.when(c("p_size") > 25, F.concat(F.lit("A"), txt("p_size"))).alias("n_amm_de_reference_francais"),
    )
    p = protection.permits(raw)
    return p.select(
        c("nom_du_produit").alias("name"), c("n_permis").alias("permis"), F.array_join("other_names", " | ").alias("names"), "other_names_fra", "reference_name"
    )


@query("""
WITH base AS (SELECT p_partkey, p_name, p_size, p_retailprice AS v, p_size + 100.0 AS x1, p_size + 200.0 AS x2, p_size + 400.0 AS x3,
  p_retailprice AS y1, p_retailprice * 0.6 AS y2, p_retailprice * 0.45 AS y3 FROM part),
l AS (SELECT *, round(x3 * 1.4, 0) AS x4 FROM base),
m AS (SELECT *, (ln(x1) + ln(x2) + ln(x3)) / 3 AS mx, (ln(y1) + ln(y2) + ln(y3)) / 3 AS my FROM l),
a AS (SELECT *, ((ln(x1)-mx)*(ln(y1)-my) + (ln(x2)-mx)*(ln(y2)-my) + (ln(x3)-mx)*(ln(y3)-my)) / ((ln(x1)-mx)*(ln(x1)-mx) + (ln(x2)-mx)*(ln(x2)-mx) + (ln(x3)-mx)*(ln(x3)-mx)) AS s FROM m),
e AS (
  SELECT 'E' || p_partkey || '_a' AS id, y1 AS amount, 0 AS low, x1 AS high FROM a UNION ALL SELECT 'E' || p_partkey || '_b', y2, x1, x2 FROM a
  UNION ALL SELECT 'E' || p_partkey || '_c', y3, x2, x3 FROM a
  UNION ALL SELECT 'E' || p_partkey || '_d', round(round(exp(my - s * mx) * pow(x4, s), 4), 2), x3, x4 FROM a)
SELECT id, round(amount, 1) AS amount, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high, '2021-03-01' AS started_on FROM e
UNION ALL SELECT CASE WHEN p_size < 25 THEN 'FE' ELSE 'SE' END || p_partkey, round(v, 1), NULL, NULL, '2020-02-01' FROM base
""")
def d_input_prices(t: Tables):
    """Cost files and equipment segments; the fourth segment continues the fitted curve."""
    def num(col):
        return txt(col.cast("decimal(14,4)"))

    cost = t.part.select(
        txt("p_partkey").alias("n"), c("p_name").alias("name"), c("p_brand").alias("article"), num(c("p_retailprice")).alias("price"),
        F.lit("euro").alias("currency"), F.lit("bag").alias("packaging"), F.lit("01/02/2020").alias("date"), "p_size",
    )
    null = F.lit(None).cast("string")
    x, y = c("p_size"), c("p_retailprice")
    equipment = t.part.select(
        txt("p_partkey").alias("n"), c("p_name").alias("equipment"), num(y).alias("segment_1_cost"), num(y * 0.6).alias("segment_2_cost"),
        num(y * 0.45).alias("segment_3_cost"), txt(x + 100).alias("segment_1_threshold"), txt(x + 200).alias("segment_2_threshold"),
        txt(x + 400).alias("segment_3_threshold"), F.lit("hour").alias("unit"), F.lit("01/03/2021").alias("date"), null.alias("main_indicator"),
        null.alias("indicator_unit"), null.alias("minimal_value"), null.alias("maximal_value"), null.alias("working_flow_value"), null.alias("working_flow_unit"),
    )
    p = prices.prices({
        "fertilizer_costs": cost.filter("p_size < 25"), "seed_costs": cost.filter("p_size >= 25"), "equipment_costs": equipment,
    })
    return p.select(
        "id", F.round(c("unit_pretax_amount").cast("double"), 1).alias("amount"), c("threshold_min_value").cast("double").alias("low"),
        c("threshold_max_value").cast("double").alias("high"), txt("started_on").alias("started_on"),
    )


@query("""
WITH z AS (SELECT n_name AS department, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey),
li AS (SELECT 'farmer_price' AS nature, r_name AS zone, year(o_orderdate) AS y, month(o_orderdate) AS m, o_totalprice AS p
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT z.department AS department_zone, CAST(make_date(y, m, 1) AS VARCHAR) AS started_on, count(*) AS n,
  CAST(sum(CAST(CAST(p AS DECIMAL(14,2)) AS DECIMAL(8,2))) AS DOUBLE) AS total FROM li JOIN z ON upper(li.zone) = z.region GROUP BY ALL
""")
def d_production_prices(t: Tables):
    regions = t.nation.join(t.region, c("n_regionkey") == c("r_regionkey"))
    zones = regions.select(c("n_name").alias("department"), c("r_name").alias("region"))
    sold = t.orders.join(t.customer, c("o_custkey") == c("c_custkey")).join(regions, c("c_nationkey") == c("n_nationkey"))
    price = F.replace(money("o_totalprice"), F.lit("."), F.lit(","))
    raw = sold.select(
        txt(F.year("o_orderdate")).alias("year"), txt(F.month("o_orderdate")).alias("month"), F.lower("r_name").alias("zone"),
        F.lit("Colza").alias("production_label"), F.lit("brassica").alias("specie"), F.lit("0").alias("waiting_price"), price.alias("final_price"),
        F.lit("ton").alias("price_unit"), F.lit("grain").alias("product_output_specie"), F.lit("2020").alias("campaign"),
    )
    p = productions.production_prices({"crop_prices": raw}, zones)
    return p.groupBy("department_zone", txt("started_on").alias("started_on")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("final_price").cast("double").alias("total")
    )


@query("""
SELECT z.department AS department_zone, count(*) AS n, CAST(sum(CAST(p_retailprice AS DECIMAL(8,2))) AS DOUBLE) AS total, min(p_name) AS production
FROM part JOIN (SELECT r_name AS region, n_name AS department FROM nation JOIN region ON n_regionkey = r_regionkey) z
ON z.region = CASE p_type WHEN 'SMALL' THEN 'ASIA' WHEN 'LARGE' THEN 'EUROPE' ELSE 'AFRICA' END GROUP BY 1
""")
def d_yields(t: Tables):
    zones = t.nation.join(t.region, c("n_regionkey") == c("r_regionkey")).select(c("n_name").alias("department"), c("r_name").alias("region"))
    zone = F.when(c("p_type") == "SMALL", "ASIA").when(c("p_type") == "LARGE", "EUROPE").otherwise("AFRICA")
    raw = t.part.select(
        zone.alias("zone"), c("p_brand").alias("specie"), c("p_name").alias("production"),
        F.replace(money("p_retailprice"), F.lit("."), F.lit(",")).alias("yield_value"), F.lit("quintal").alias("yield_unit"), F.lit("2020").alias("campaign"),
    )
    y = productions.yields(raw, zones)
    return y.groupBy("department_zone").agg(
        F.count(F.lit(1)).alias("n"), F.sum("yield_value").cast("double").alias("total"), min_text(c("production")).alias("production")
    )


@query("""
SELECT p_type || p_partkey AS reference_name, CASE p_type WHEN 'SMALL' THEN 'crop' WHEN 'LARGE' THEN 'animal' ELSE 'auxiliary' END || '_productions_' || p_type || p_partkey AS translation_id,
  CASE WHEN p_size > 10 THEN p_size * 12 END AS life_months, CASE p_type WHEN 'SMALL' THEN 'spring' END AS season, '2019-02-01' AS started_on
FROM part WHERE p_type IN ('SMALL', 'LARGE', 'PROMO')
""")
def d_productions(t: Tables):
    from agrimill.functions.dates import months_of

    null = F.lit(None).cast("string")
    base = t.part.select(
        F.concat("p_type", txt("p_partkey")).alias("reference_name"), F.lit("fam").alias("activity_family"), null.alias("specie"), null.alias("usage"),
        F.lit("01/02/19").alias("started_on"), F.lit("31/12/2029").alias("stopped_on"), F.when(c("p_size") > 10, txt("p_size")).alias("life_duration"),
        F.lit("spring").alias("season"), null.alias("agroedi_crop_code"), "p_type",
    )
    p = productions.productions({
        "crop_productions": base.filter("p_type = 'SMALL'"), "animal_productions": base.filter("p_type = 'LARGE'"),
        "auxiliary_productions": base.filter("p_type = 'PROMO'"),
    })
    return p.select(
        "reference_name", "translation_id", months_of(c("life_duration")).cast("bigint").alias("life_months"), "season", txt("started_on").alias("started_on")
    )


@query("""
SELECT p_type || '_' || p_partkey AS reference_name, CASE p_type WHEN 'SMALL' THEN 'article' WHEN 'LARGE' THEN 'article' WHEN 'PROMO' THEN 'equipment' ELSE 'zone' END AS family,
  CASE p_type WHEN 'SMALL' THEN '{' || concat_ws(',', CASE WHEN p_size > 9 THEN '"nitrogen_concentration":"' || p_size || 'percent"' END,
       CASE WHEN p_size > 30 THEN '"copper_concentration":"' || p_size || 'percent"' END) || '}'
     WHEN 'LARGE' THEN CASE WHEN p_size > 20 THEN '{"' || replace(p_name, ' ', '_') || '":"' || p_size || 'kilogram"}' ELSE '{}' END ELSE '{}' END AS indicators,
  CASE WHEN p_brand = 'Brand#7' THEN lower(p_name) || ',tag' END AS tags FROM part WHERE p_type IN ('SMALL', 'LARGE', 'PROMO', 'MEDIUM')
""")
def d_variants(t: Tables):
    null = F.lit(None).cast("string")
    base = t.part.select(
        F.concat("p_type", F.lit("_"), txt("p_partkey")).alias("reference_name"), F.lit("cat").alias("category"), F.lit("nat").alias("nature"),
        F.lit("unity").alias("default_unit"), null.alias("target_specie"), F.lit("p.svg").alias("pictogram"), F.lit("sub").alias("sub_family"),
        *[
            (F.when(c("p_size") > low, txt("p_size")) if low is not None else null).alias(m)
            for m, low in {**{m: None for m in variants.FERTILIZER_MEASURES}, "nitrogen_concentration": 9, "copper_concentration": 30}.items()
        ],
        F.when(c("p_size") > 20, F.replace("p_name", F.lit(" "), F.lit("_"))).alias("indicator_1_name"), txt("p_size").alias("indicator_1_value"),
        F.lit("kilogram").alias("indicator_1_unit"), "p_type",
    )
    aliases = t.part.filter("p_brand = 'Brand#7'").select(
        F.concat("p_type", F.lit("_"), txt("p_partkey")).alias("reference_name"), F.array(F.concat(F.lit(" "), F.upper("p_name")), F.lit("TAG ")).alias("tags")
    )
    v = variants.variants({
        "fertilizers": base.filter("p_type = 'SMALL'"), "farm_products": base.filter("p_type = 'LARGE'"), "equipments": base.filter("p_type = 'PROMO'"),
        "zones": base.filter("p_type = 'MEDIUM'"),
    }, aliases)
    return v.select("reference_name", "family", F.to_json("indicators").alias("indicators"), F.array_join("name_tags", ",").alias("tags"))


@query("""
WITH c AS (SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations WHERE turn >= 1),
h AS (SELECT conv_id, 'fam_' || role || '_bio_' || conv_id AS wid FROM conversations WHERE turn = 0)
SELECT h.wid || '_' || role || '_1' AS reference_name, h.wid AS technical_workflow_id, role AS name, 'per_year' AS frequency, CASE WHEN turn % 2 = 0 THEN '3' ELSE '0' END AS period
FROM c JOIN h USING (conv_id) WHERE prev IS NULL OR prev <> role
""")
def d_workflow_procedures(t: Tables):
    """Conversations as workbooks: the first turn is the header line, a new speaker starts a procedure."""
    def cell(col, value):
        return F.struct(F.lit(col).alias("col"), value.alias("value"))

    head = F.array(cell("A", F.lit("fam")), cell("B", c("role")), cell("C", F.lit("bio")), cell("E", F.lit("2020-03-01")))
    line = F.array(
        cell("A", F.lit("1")), cell("B", c("role")), cell("E", F.when(c("turn") % 2 == 0, "3")), cell("F", F.lit("proc")), cell("D", F.lit(" "))
    )
    row = F.when(c("turn") == 0, 2).otherwise(c("turn") + 3)
    cells = t.conversations.select(txt("conv_id").alias("sheet"), row.alias("row"), F.explode(F.when(c("turn") == 0, head).otherwise(line)).alias("x"))
    p = workflows.procedures(cells.select("sheet", "row", "x.*"))
    return p.select("reference_name", "technical_workflow_id", F.element_at("name", F.lit("fra")).alias("name"), "frequency", "period")


@query("""
SELECT CAST(conv_id AS VARCHAR) AS activity_family, count(*) AS n, CAST(sum(CAST((length(text) + 0.5) AS DECIMAL(8,2))) AS DOUBLE) AS quantity FROM conversations WHERE role <> 'system' GROUP BY 1
""")
def d_budgets(t: Tables):
    def cell(col, value):
        return F.struct(F.lit(col).alias("col"), value.alias("value"))

    line = F.array(cell("A", F.nullif("role", F.lit("system"))), cell("C", F.lit("v")), cell("I", F.concat(txt(F.length("text")), F.lit(",5"))))
    cells = t.conversations.select(txt("conv_id").alias("sheet"), (c("turn") + 2).alias("row"), F.explode(line).alias("x")).select("sheet", "row", "x.*")
    b = workflows.budgets(cells)
    return b.groupBy("activity_family").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").cast("double").alias("quantity"))


@query("""
SELECT s_name AS id, n_name AS specie_name_fra, '2020-01-' || lpad(CAST(s_nationkey + 1 AS VARCHAR), 2, '0') AS registration_date FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey < 3
""")
def d_seed_varieties(t: Tables):
    raw = t.supplier.select(
        F.concat(F.lit(" "), "s_name", F.lit(" ")).alias("code_gnis"), txt("s_nationkey").alias("id_espece"), c("s_name").alias("variete"),
        F.concat(F.lit("202001"), F.lpad(txt(c("s_nationkey") + 1), 2, "0")).alias("date_d_inscription"),
    )
    species = t.nation.filter("n_regionkey < 3").select(txt("n_nationkey").alias("id"), c("n_name").alias("name"), F.lower("n_name").alias("specie"))
    s = registers.seed_varieties(raw, species)
    return s.select("id", "specie_name_fra", txt("registration_date").alias("registration_date"))


@query("""
SELECT s_name AS short_name, 'code ' || n_name AS custom_code, CASE WHEN s_nationkey > 5 THEN 'wine,table' END AS utilities, true AS fr_validated FROM
  supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_regionkey = 1
UNION ALL SELECT * FROM (VALUES ('Couderc', '3309', 'wine', false), ('Riparia', '9960', 'wine', false), ('Binova', '9985', 'wine', false), ('Borner', '9986', 'wine', false))
""")
def d_vine_varieties(t: Tables):
    raw = t.supplier.select(
        txt("s_suppkey").alias("id"), c("s_name").alias("name"), F.lit("red").alias("color"), F.lit("grape").alias("category"),
        F.when(c("s_nationkey") > 5, "wine, table").alias("utilities"),
    )
    customs = t.supplier.join(t.nation.filter("n_regionkey = 1"), c("s_nationkey") == c("n_nationkey")).select(
        F.concat(F.lit("code "), "n_name").alias("custom_code"), c("s_name").alias("short_name"), F.upper("s_name").alias("long_name")
    )
    v = registers.vine_varieties(raw, customs)
    return v.select("short_name", "custom_code", F.array_join("utilities", ",").alias("utilities"), "fr_validated")


@query("""
SELECT c_custkey + 10 AS id, replace(c_name, '#', '') AS product, c_mktsegment AS fr_sign FROM customer
UNION ALL SELECT * FROM (VALUES (1, 'VSIG', 'Vin de France -'), (2, 'VSIG rouge', 'Vin de France -'), (3, 'VSIG blanc', 'Vin de France -'), (4, 'VSIG rosé', 'Vin de France -'))
""")
def d_quality_signs(t: Tables):
    raw = t.customer.select(
        txt(c("c_custkey") + 10).alias("id_produit"), F.lit("1").alias("ida"), F.lit("z").alias("aire_geographique"), c("c_mktsegment").alias("signe_fr"),
        F.lit("").alias("signe_ue"), F.replace("c_name", F.lit("#"), F.lit("\\")).alias("produit"), F.lit("r").alias("reference"),
    )
    s = registers.signs(raw)
    return s.select(c("id").cast("bigint").alias("id"), F.element_at("product_human_name", F.lit("fra")).alias("product"), "fr_sign")


@query("""
SELECT 'units_' || p_name || p_partkey AS id, p_name AS fra, CAST(CAST(p_retailprice AS DECIMAL(25,10)) AS DOUBLE) AS factor, CASE WHEN p_size > 20 THEN CAST(p_size AS DOUBLE) END AS b FROM part
""")
def d_units(t: Tables):
    raw = t.part.select(
        F.concat("p_name", txt("p_partkey")).alias("reference_name"), F.lit("mass").alias("dimension"), F.lit("kg").alias("symbol"),
        money("p_retailprice").alias("a"), F.lit(None).cast("string").alias("d"), F.when(c("p_size") > 20, txt("p_size")).alias("b"),
        c("p_name").alias("fra"), c("p_name").alias("eng"),
    )
    u = units.units(raw)
    tr = units.unit_translations({"units": raw})
    return u.join(tr, u["translation_id"] == tr["id"]).select("id", "fra", c("a").cast("double").alias("factor"), c("b").cast("double").alias("b"))


@query("""
SELECT 'L' || c_custkey AS code, CASE WHEN c_nationkey = 3 THEN '' ELSE c_name END AS label, CASE WHEN c_nationkey < 5 THEN '' ELSE 'fr_a,' || lower(c_mktsegment) END AS items, 'legal' AS kind FROM customer
UNION ALL SELECT s_name, NULL, 'read,write', 'role' FROM supplier
UNION ALL SELECT p_partkey || '-vitis', p_name, '', 'stage' FROM part WHERE p_type = 'SMALL'
UNION ALL SELECT p_partkey || '-' || p_brand, p_name, '', 'stage' FROM part WHERE p_type <> 'SMALL'
UNION ALL SELECT CAST(n_nationkey AS VARCHAR), n_name, '', 'account' FROM nation
UNION ALL SELECT 'taxonomy_' || n_name, r_name, '', 'taxon' FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def d_registers(t: Tables):
    """Legal positions, roles, growth stages, accounts and taxonomy as one listing."""
    null = F.lit(None).cast("string")
    legal = registers.legal_positions(t.customer.select(
        F.concat(F.lit("L"), txt("c_custkey")).alias("code"), F.when(c("c_nationkey") != 3, c("c_name")).alias("name"), F.lit("n").alias("nature"),
        F.lit("fra").alias("country"), F.lit("1").alias("insee_code"),
        F.when(c("c_nationkey") >= 5, F.concat(F.lit("fr_a, "), F.lower("c_mktsegment"))).alias("fiscal_positions"),
    ))
    roles = registers.user_roles(t.supplier.select(c("s_name").alias("reference_name"), F.lit("read, write").alias("accesses")))
    vine = t.part.filter("p_type = 'SMALL'").select(
        txt("p_partkey").alias("bbch_code"), null.alias("biaggiolini"), null.alias("eichhorn_lorenz"), null.alias("chasselas_date"),
        c("p_name").alias("label_fr"), null.alias("description_fr"),
    )
    crops = t.part.filter("p_type <> 'SMALL'").select(txt("p_partkey").alias("bbch"), c("p_name").alias("label"), c("p_brand").alias("variety"))
    stages = registers.stages(vine, crops)
    accounts = registers.accounts(t.nation.select(
        txt("n_nationkey").alias("n"), c("n_name").alias("name"), null.alias("previous_name"), null.alias("fr_pcga"), null.alias("fr_pcg82"),
        c("n_name").alias("label_fr"),
    ))
    taxa = registers.taxonomy(t.nation.join(t.region, c("n_regionkey") == c("r_regionkey")).select(
        c("n_name").alias("reference_name"), c("r_name").alias("parent"), F.lit("species").alias("taxonomic_rank")
    ))

    def listed(df, code, label, items, kind):
        return df.select(code.alias("code"), label.alias("label"), items.alias("items"), F.lit(kind).alias("kind"))

    def fra(col):
        return F.element_at(col, F.lit("fra"))

    none = F.lit("")
    parts = [
        listed(legal, c("code"), fra("name"), F.array_join("fiscal_positions", ","), "legal"),
        listed(roles, c("reference_name"), null, F.array_join("accesses", ","), "role"),
        listed(stages, c("id"), fra("label"), none, "stage"), listed(accounts, txt("id"), fra("name"), none, "account"),
        listed(taxa, c("translation_id"), c("parent"), none, "taxon"),
    ]
    from agrimill.operators.reshape import union_families

    return union_families(parts)


@query("""
SELECT p_partkey AS product_id, min(l_quantity) AS dose FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type IN ('SMALL', 'LARGE') GROUP BY 1 ORDER BY 1
""")
def d_smallest_doses(t: Tables):
    unit = F.when(c("p_type") == "SMALL", "liter_per_hectare").when(c("p_type") == "LARGE", "liter").otherwise("kilogram")
    usages = t.lineitem.join(t.part, c("l_partkey") == c("p_partkey")).select(
        c("p_partkey").alias("product_id"), c("l_quantity").alias("dose_quantity"), unit.alias("dose_unit")
    )
    return compact.smallest_doses(usages)


def catalogue(t: Tables):
    """Catalogue records held as XML text, parsed into the catalogue's own layout."""
    from agrimill.sources.documents import parse_xml

    s = txt("p_size")
    usage = F.concat(
        F.lit('<usage date-decision="05/06/'), F.when(c("p_size") < 10, "0016").otherwise("2018"), F.lit('"><id>u'), txt("p_partkey"),
        F.lit('</id><etat-usage>'), F.when(c("p_size") < 20, "Retrait").otherwise("Autorisé"), F.lit('</etat-usage><identifiant-usage lib-court="'), s,
        F.lit('">'), "p_type", F.lit("*Trt Part.Aer.*"), "p_name", F.lit("</identifiant-usage><date-fin-utilisation>0"),
        txt(c("p_size") % 9 + 1), F.lit('/10/2019</date-fin-utilisation><dose-retenue unite="L/ha">'), s,
        F.lit(".5</dose-retenue><condition-emploi>bouillie : "), s, F.lit(" L/ha, fin</condition-emploi><ZNT-aquatique>5.0</ZNT-aquatique></usage>"),
    )
    body = F.concat(
        F.lit("<PPP><numero-AMM> "), F.when(c("p_brand") == "Brand#1", "N/A").otherwise(txt("p_partkey")), F.lit("</numero-AMM><nom-produit>"), "p_name",
        F.lit("</nom-produit><fonctions><ref>Fongicide</ref></fonctions><etat-produit>"), F.when(c("p_size") < 20, "RETIRE").otherwise("AUTORISE"),
        F.lit("</etat-produit><date-premiere-autorisation>01/02/2003</date-premiere-autorisation><mentions-autorisees><ref>"),
        F.when(c("p_size") > 40, "Mention abeille").otherwise("autre"), F.lit("</ref></mentions-autorisees><classement-CLP><phrases-risque><ref lib-court=\"H"),
        F.when(c("p_size") % 3 == 0, "317").when(c("p_size") % 3 == 1, "361d").otherwise("999"),
        F.lit('">x</ref></phrases-risque></classement-CLP><classement-DSD><phrases-risque><ref lib-court="R36">y</ref><ref lib-court="Xi">z</ref></phrases-risque></classement-DSD><usages>'),
        usage, F.lit("</usages><type-produit>PPP</type-produit></PPP>"),
    )
    records = t.wide("part", "p_partkey", "p_brand", "p_type", "p_size", "p_name").select(body.alias("body"), F.lit("PPP").alias("record_tag"))
    return parse_xml(records, "body", protection.CATALOGUE_SCHEMA)


@query("""
SELECT p_partkey AS id, CAST(p_partkey AS VARCHAR) || '_' || replace(lower(p_name), ' ', '_') AS reference_name,
  CASE WHEN p_size < 20 THEN 'withdrawn' ELSE 'authorized' END AS state, CASE WHEN p_size % 3 = 0 THEN 48 ELSE 24 END AS hours,
  CASE WHEN p_size % 3 = 1 THEN '1,3' ELSE '1' END AS categories, CASE WHEN p_size < 20 THEN '2019-10-0' || (p_size % 9 + 1) END AS stopped_on,
  CASE WHEN p_size > 40 THEN '{"bee_usage":true}' END AS mentions, 'Fongicide' AS natures, '2003-02-01' AS started_on
FROM part WHERE p_brand <> 'Brand#1'
""")
def d_protection_products(t: Tables):
    p = protection.products(catalogue(t))
    hours = F.extract(F.lit("DAY"), "in_field_reentry_delay") * 24 + F.extract(F.lit("HOUR"), "in_field_reentry_delay")
    return p.select(
        c("id").cast("bigint").alias("id"), "reference_name", "state", hours.cast("bigint").alias("hours"),
        F.array_join(c("mix_category_codes").cast("array<string>"), ",").alias("categories"), txt("stopped_on").alias("stopped_on"),
        F.to_json("allowed_mentions").alias("mentions"), F.array_join("natures", ",").alias("natures"), txt("started_on").alias("started_on"),
    )


@query("""
SELECT 'u' || p_partkey AS id, p_partkey AS product_id, upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS crop, upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS target,
  p_size + 0.5e0 AS dose, 'liter_per_hectare' AS dose_unit, CASE WHEN p_size < 20 THEN 'withdrawn' ELSE 'authorized' END AS state,
  CASE WHEN p_size < 10 THEN '2016-06-05' ELSE '2018-06-05' END AS decided, CAST(p_size AS VARCHAR) AS volume, 'L/ha' AS volume_unit,
  CASE WHEN p_size BETWEEN 20 AND 30 THEN 7 END AS frequency_days, CASE p_type WHEN 'SMALL' THEN 's1,s2' WHEN 'LARGE' THEN 'large_v' ELSE 'plant' END AS species
FROM part WHERE p_brand <> 'Brand#1'
""")
def d_protection_usages(t: Tables):
    u = protection.usages(catalogue(t))
    extract = t.part.filter("p_size between 20 and 30").select(
        txt("p_partkey").alias("numero_amm"), F.concat("p_type", F.lit("*Trt Part.Aer.*"), "p_name").alias("identifiant_usage"),
        F.lit(None).cast("string").alias("stade_cultural_min_bbch"), F.lit(None).cast("string").alias("tade_cultural_max_bbch"),
        F.lit(None).cast("string").alias("nombre_max_d_application"), F.concat(F.lit("bouillie : "), txt("p_size"), F.lit(" L/ha, fin")).alias("condition_emploi"),
        F.lit("7").alias("intervalle_minimum_entre_applications_jour"), F.lit("Autorisé").alias("etat_usage"),
    )
    u = protection.with_spray_volume(protection.with_frequency(u, extract))
    label = F.create_map(F.lit("fra"), F.concat(F.substring("p_type", 1, 1), F.lower(F.substr("p_type", F.lit(2)))))
    kinds = t.part.select("p_type", label.alias("label")).dropDuplicates(["p_type"])
    sets = kinds.filter("p_type = 'SMALL'").select("label", F.lit("s1, s2").alias("name"))
    varieties = kinds.filter("p_type = 'LARGE'").select("label", F.lit("large_v").alias("name"))
    exceptions = kinds.filter("p_type = 'nothing'").select(F.element_at("label", F.lit("fra")).alias("crop_label"), F.lit("x").alias("species"))
    u = protection.with_species(u, sets, varieties, exceptions)
    return u.select(
        "id", c("product_id").cast("bigint").alias("product_id"), F.element_at("crop", F.lit("fra")).alias("crop"), c("target_name_label_fra").alias("target"),
        c("dose_quantity").cast("double").alias("dose"), "dose_unit", "state", txt("decision_date").alias("decided"),
        c("extract_spray_volume_max_quantity").alias("volume"), c("extract_spray_volume_max_unit").alias("volume_unit"),
        F.extract(F.lit("DAY"), "applications_frequency").cast("bigint").alias("frequency_days"), F.array_join("species", ",").alias("species"),
    )


@query("""
SELECT p_partkey AS product_id, 'H' || CASE p_size % 3 WHEN 0 THEN '317' WHEN 1 THEN '361d' ELSE '999' END AS risk_code, 'x' AS risk_phrase FROM part WHERE p_brand <> 'Brand#1'
UNION ALL SELECT p_partkey, 'R36', 'y' FROM part WHERE p_brand <> 'Brand#1'
""")
def d_protection_risks(t: Tables):
    return protection.risks(catalogue(t)).select(c("product_id").cast("bigint").alias("product_id"), "risk_code", "risk_phrase")


def book(t: Tables, head, line):
    """Conversations as workbooks: the first turn is row 2, the others follow from row 4 on."""
    row = F.when(c("turn") == 0, 2).otherwise(c("turn") + 3)
    cells = F.explode(F.when(c("turn") == 0, head).otherwise(line)).alias("x")
    return t.conversations.select(txt("conv_id").alias("sheet"), row.alias("row"), cells).select("sheet", "row", "x.*")


def cell(col, value):
    return F.struct(F.lit(col).alias("col"), value.cast("string").alias("value"))


@query("""
SELECT CAST(c.conv_id AS VARCHAR) AS technical_sequence_id, c.turn AS year_start, c.turn + 1 AS year_stop, 'plant_' || h.role || '_' || c.role AS technical_workflow_id
FROM conversations c JOIN conversations h ON h.conv_id = c.conv_id AND h.turn = 0 WHERE c.turn >= 1 AND c.role <> 'assistant'
""")
def d_sequence_steps(t: Tables):
    head = F.array(cell("A", F.lit("plant")), cell("B", c("role")))
    line = F.array(cell("A", F.when(c("role") != "assistant", c("turn"))), cell("B", c("turn") + 1), cell("C", c("role")))
    s = workflows.sequence_steps(book(t, head, line))
    return s.select(
        "technical_sequence_id", c("year_start").cast("bigint").alias("year_start"), c("year_stop").cast("bigint").alias("year_stop"), "technical_workflow_id"
    )


@query("""
WITH l AS (SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations)
SELECT 'model' AS kind, replace(role || ',' || conv_id, ',', '_') AS reference_name, 1.5e0 AS amount FROM l WHERE prev IS NULL OR prev <> role
UNION ALL SELECT 'item', replace(role || ',' || conv_id, ',', '_') || '_tool_' || turn, CASE WHEN role = 'user' THEN turn + 0.5e0 ELSE 0e0 END FROM l
""")
def d_intervention_models(t: Tables):
    line = F.array(
        cell("A", c("turn")), cell("B", F.lit("n")), cell("C", F.lit("p")), cell("D", F.concat("role", F.lit(","), txt("conv_id"))), cell("E", F.lit("tool")),
        cell("F", c("turn")), cell("H", F.when(c("role") == "user", F.concat(txt("turn"), F.lit(".5")))), cell("J", F.lit("1.5")),
    )
    cells = t.conversations.select(txt("conv_id").alias("sheet"), (c("turn") + 2).alias("row"), F.explode(line).alias("x")).select("sheet", "row", "x.*")
    m = workflows.models(cells).select(F.lit("model").alias("kind"), "reference_name", c("working_flow").cast("double").alias("amount"))
    i = workflows.model_items(cells).select(F.lit("item").alias("kind"), "reference_name", c("indicator_value").cast("double").alias("amount"))
    return m.unionByName(i)


@query("""
SELECT c_custkey AS reference_id, c_name AS reference_label, c_mktsegment AS value, 'code' AS kind FROM customer
UNION ALL SELECT NULL, p_name, CAST(p_partkey AS VARCHAR), 'crop' FROM part
""")
def d_exchange_codes(t: Tables):
    codes = registers.edi_codes(t.customer.select(
        F.lit("1").alias("repository_id"), txt("c_custkey").alias("reference_id"), F.lit("c").alias("reference_code"), c("c_name").alias("reference_label"),
        F.lit("s").alias("scope"), c("c_mktsegment").alias("value"),
    ))
    crops = registers.edi_crops(t.part.select(txt("p_partkey").alias("agroedi_code"), c("p_name").alias("agroedi_name"), c("p_type").alias("production")))
    codes = codes.select(c("reference_id").cast("bigint").alias("reference_id"), "reference_label", "value", F.lit("code").alias("kind"))
    return codes.unionByName(crops.select(
        F.lit(None).cast("bigint").alias("reference_id"), c("agroedi_name").alias("reference_label"), c("agroedi_code").alias("value"), F.lit("crop").alias("kind")
    ))


@query("""
SELECT 'parts_' || p_partkey AS id, upper(p_name) AS fra, p_name AS eng FROM part
UNION ALL SELECT 'nations_' || n_nationkey, n_name, n_name FROM nation
""")
def d_translations(t: Tables):
    """Shared translations: the parts scope is rebuilt, the nations scope stays."""
    from agrimill.operators.keyed import translations

    def labelled(df, key, fra, eng):
        return df.select(txt(key).alias("reference_name"), fra.alias("fra"), eng.alias("eng"))

    nations = translations(labelled(t.nation, "n_nationkey", c("n_name"), c("n_name")), "nations")
    old = translations(labelled(t.part, "p_partkey", c("p_name"), c("p_name")), "parts")
    table = registers.translations(None, {"nations": nations}).unionByName(registers.translations(None, {"parts": old}))
    new = translations(labelled(t.part, "p_partkey", F.upper("p_name"), c("p_name")), "parts")
    return registers.translations(table, {"parts": new}).select("id", "fra", "eng")


@query("""
SELECT 'crop' || p_partkey AS code, p_type = 'SMALL' AS is_seed, 2017 + p_size % 9 AS year, p_brand AS category FROM part
""")
def d_subsidy_codes(t: Tables):
    raw = t.part.select(
        F.concat(F.lit("crop"), txt("p_partkey")).alias("cap_code"), c("p_name").alias("cap_label"), c("p_type").alias("production"),
        F.lit(None).cast("string").alias("cap_precision"), c("p_brand").alias("cap_category"), F.when(c("p_type") == "SMALL", "1").alias("is_seed"),
        txt(F.lit(2017) + c("p_size") % 9).alias("year"),
    )
    s = productions.subsidy_codes(raw)
    return s.select(c("cap_code").alias("code"), "is_seed", c("year").cast("bigint").alias("year"), c("cap_category").alias("category"))
