"""Geometry: points and quadrilaterals are derived from the tables' own keys and values."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from agrimill.functions import geometry as geo
from agrimill.operators import geometry as ops
from agrimill.session import shared_path
from driver_queries.registry import Tables, query


def pt(x, y):
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def quad(x, y, w, h, bow=False):
    """Closed ring of an axis-aligned quadrilateral; ``bow`` swaps two corners."""
    a, b, c, d = pt(x, y), pt(x + w, y), pt(x + w, y + h), pt(x, y + h)
    return F.array(a, b, d, c, a) if bow else F.array(a, b, c, d, a)


@query("""
WITH p AS (SELECT c_custkey, CAST(c_custkey % 60 - 30 AS DOUBLE) AS x, c_acctbal / 200 AS y FROM customer)
SELECT c_custkey, round(x, 6) AS x, round(y, 6) AS y FROM p
WHERE (x - -0.5) * (x - -0.5) + (y - 44.8) * (y - 44.8) <= 100 OR (x - 1.6) * (x - 1.6) + (y - 45.4) * (y - 45.4) <= 4
""")
def q_within_distance(t: Tables):
    p = t.customer.select("c_custkey", geo.point(F.col("c_custkey") % 60 - 30, F.col("c_acctbal") / 200).alias("centroid"))
    near = ops.within_any(p, "centroid", [(-0.5, 44.8, 10.0), (1.6, 45.4, 2.0)])
    return near.select("c_custkey", F.round("centroid.x", 6).alias("x"), F.round("centroid.y", 6).alias("y"))


def lambert_sql(x: str, y: str) -> tuple[str, str]:
    dx, dy = f"({x} - {geo.LAMBERT_XS}e0)", f"({geo.LAMBERT_YS}e0 - {y})"
    lon = f"degrees(atan2({dx}, {dy}) / {geo.LAMBERT_N}) + {geo.LAMBERT_LON0}"
    iso = f"(ln(sqrt({dx} * {dx} + {dy} * {dy}) / {geo.LAMBERT_C}e0) / -{geo.LAMBERT_N}e0)"
    lat = f"(2 * atan(exp({iso})) - pi() / 2)"
    for _ in range(6):
        lat = f"(2 * atan(exp({iso} + {geo.GRS80_E} * atanh({geo.GRS80_E} * sin({lat})))) - pi() / 2)"
    return lon, f"degrees({lat})"


LAMBERT_X = "(100000 + (o_orderkey % 1100) * 1000 + 0.25)"
LAMBERT_Y = "(6050000 + o_totalprice * 2)"
_LON, _LAT = lambert_sql("x", "y")


@query(f"""
WITH p AS (SELECT o_orderkey, {LAMBERT_X} AS x, {LAMBERT_Y} AS y FROM orders)
SELECT o_orderkey, round({_LON}, 6) AS lon, round({_LAT}, 6) AS lat FROM p
""")
def q_lambert_inverse(t: Tables):
    p = t.orders.select("o_orderkey", F.expr(LAMBERT_X).cast("double").alias("x"), F.expr(LAMBERT_Y).alias("y"))
    w = p.select("o_orderkey", geo.to_wgs84(F.col("x"), F.col("y"), geo.LAMBERT93).alias("p"))
    return w.select("o_orderkey", F.round("p.x", 6).alias("lon"), F.round("p.y", 6).alias("lat"))


def utm_sql() -> str:
    """Inverse by the meridian arc, another method than the one under test; the two agree to about 1e-9 degrees."""
    a, f, k0 = geo.GRS80_A, geo.GRS80_F, geo.UTM_K0
    e2 = f * (2 - f)
    e1 = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    ep2 = e2 / (1 - e2)
    zones = " ".join(f"WHEN {z} THEN {lon}" for z, (lon, _) in geo.UTM_ZONES.items())
    north = " ".join(f"WHEN {z} THEN {n}" for z, (_, n) in geo.UTM_ZONES.items())
    mu_den = a * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256)
    return f"""
WITH p AS (SELECT c_custkey, 400000.5 + (c_custkey % 200) * 1000 AS x, CASE WHEN c_nationkey % 5 IN (2, 4) THEN 7000000 ELSE 1000000 END + c_acctbal * 20 AS y,
                  CASE c_nationkey % 5 WHEN 0 THEN 5490 WHEN 1 THEN 2972 WHEN 2 THEN 2975 WHEN 3 THEN 4467 ELSE 4471 END AS srid FROM customer),
m AS (SELECT *, CASE srid {zones} END AS lon0, ((y - CASE srid {north} END) / {k0}) / {mu_den} AS mu, (x - 500000) AS e FROM p),
f AS (SELECT *, mu + {3 * e1 / 2 - 27 * e1**3 / 32} * sin(2 * mu) + {21 * e1**2 / 16 - 55 * e1**4 / 32} * sin(4 * mu)
      + {151 * e1**3 / 96} * sin(6 * mu) + {1097 * e1**4 / 512} * sin(8 * mu) AS p1 FROM m),
g AS (SELECT *, {ep2} * cos(p1) * cos(p1) AS c1, tan(p1) * tan(p1) AS t1, {a} / sqrt(1 - {e2} * sin(p1) * sin(p1)) AS n1,
      {a * (1 - e2)} / pow(1 - {e2} * sin(p1) * sin(p1), 1.5) AS r1 FROM f),
h AS (SELECT *, e / (n1 * {k0}) AS d FROM g)
SELECT c_custkey, round(degrees(p1 - (n1 * tan(p1) / r1) * (d * d / 2 - (5 + 3 * t1 + 10 * c1 - 4 * c1 * c1 - 9 * {ep2}) * pow(d, 4) / 24
       + (61 + 90 * t1 + 298 * c1 + 45 * t1 * t1 - 252 * {ep2} - 3 * c1 * c1) * pow(d, 6) / 720)), 4) AS lat,
       round(lon0 + degrees((d - (1 + 2 * t1 + c1) * pow(d, 3) / 6
       + (5 - 2 * c1 + 28 * t1 - 3 * c1 * c1 + 8 * {ep2} + 24 * t1 * t1) * pow(d, 5) / 120) / cos(p1)), 4) AS lon
FROM h
"""


@query(utm_sql())
def q_utm_inverse(t: Tables):
    zone = F.element_at(F.array(*[F.lit(z) for z in (5490, 2972, 2975, 4467, 4471)]), F.col("c_nationkey") % 5 + 1)
    base = F.when((F.col("c_nationkey") % 5).isin(2, 4), 7000000).otherwise(1000000)
    p = t.customer.select(
        "c_custkey", (F.lit(400000.5) + F.col("c_custkey") % 200 * 1000).alias("x"),
        (base + F.col("c_acctbal") * 20).alias("y"), zone.alias("srid"),
    )
    w = p.select("c_custkey", geo.to_wgs84(F.col("x"), F.col("y"), F.col("srid")).alias("p"))
    return w.select("c_custkey", F.round("p.x", 4).alias("lon"), F.round("p.y", 4).alias("lat"))


# A 4 x 3 quadrilateral with a 1 x 1 hole in its corner, and a second part of 2 x 2.
@query("""
WITH q AS (SELECT o_orderkey, CAST(o_orderkey % 360 AS DOUBLE) AS x, o_totalprice / 10000 AS y FROM orders)
SELECT o_orderkey, CAST(part AS BIGINT) AS part,
       round(CASE part WHEN 0 THEN (12 * (x + 2) - (x + 0.5)) / 11 ELSE x + 11 END, 6) AS cx,
       round(CASE part WHEN 0 THEN (12 * (y + 1.5) - (y + 0.5)) / 11 ELSE y + 1 END, 6) AS cy,
       round((12 * (x + 2) - (x + 0.5) + 4 * (x + 11)) / 15, 6) AS all_x,
       round((12 * (y + 1.5) - (y + 0.5) + 4 * (y + 1)) / 15, 6) AS all_y
FROM q CROSS JOIN (SELECT unnest([0, 1]) AS part)
""")
def q_centroid(t: Tables):
    x, y = (F.col("o_orderkey") % 360).cast("double"), F.col("o_totalprice") / 10000
    shape = F.array(
        F.array(quad(x, y, F.lit(4.0), F.lit(3.0)), quad(x, y, F.lit(1.0), F.lit(1.0))),
        F.array(quad(x + 10, y, F.lit(2.0), F.lit(2.0))),
    )
    g = t.wide("orders", "o_orderkey", "o_totalprice").select("o_orderkey", shape.alias("shape"))
    g = g.withColumn("whole", geo.centroid_multipolygon(F.col("shape")))
    parts = ops.dump(g, "shape").withColumn("shape", geo.multi(F.col("shape")))
    parts = parts.withColumn("c", geo.centroid_multipolygon(F.col("shape")))
    return parts.select(
        "o_orderkey", F.col("part").cast("bigint").alias("part"), F.round("c.x", 6).alias("cx"), F.round("c.y", 6).alias("cy"),
        F.round("whole.x", 6).alias("all_x"), F.round("whole.y", 6).alias("all_y"),
    )


PIP_SQL = """
WITH pts AS (SELECT o_orderkey, CAST(o_orderkey % 97 AS DOUBLE) / 4 AS x, CAST(o_custkey % 89 AS DOUBLE) / 4 AS y FROM orders),
quads AS (SELECT p_partkey, CAST(p_partkey % 20 AS DOUBLE) AS x, CAST((p_partkey // 20) % 20 AS DOUBLE) AS y, p_size / 40.0 AS w FROM part)
SELECT q.p_partkey AS zone, count(*) AS n_points, min(o_orderkey) AS first_point
FROM pts JOIN quads q ON pts.x BETWEEN q.x AND q.x + q.w AND pts.y BETWEEN q.y AND q.y + q.w GROUP BY 1
"""


def pip_inputs(t: Tables):
    pts = t.wide("orders", "o_orderkey", "o_custkey").select(
        "o_orderkey", geo.point((F.col("o_orderkey") % 97).cast("double") / 4, (F.col("o_custkey") % 89).cast("double") / 4).alias("centroid")
    )
    x, y = (F.col("p_partkey") % 20).cast("double"), (F.floor(F.col("p_partkey") / 20) % 20).cast("double")
    w = F.col("p_size") / 40
    parts = t.wide("part", "p_partkey", "p_size")
    return pts, parts.select(F.col("p_partkey").alias("zone"), F.array(F.array(quad(x, y, w, w))).alias("shape"))


def pip_totals():
    return [F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first")]


@query(PIP_SQL)
def q_pip_join(t: Tables):
    pts, quads = pip_inputs(t)
    hits = ops.point_in_polygon_join(pts, quads, "centroid", "shape", cell=0.25, totals=pip_totals())
    return hits.groupBy("zone").agg(F.sum("n").alias("n_points"), F.min("first").alias("first_point"))


@query(PIP_SQL)
def q_pip_join_salted(t: Tables):
    """Same join with crowded cells split by salt, and only two grid levels."""
    pts, quads = pip_inputs(t)
    hits = ops.point_in_polygon_join(pts, quads, "centroid", "shape", cell=0.25, levels=[0, 1], hot_rows=200, salts=4, totals=pip_totals())
    return hits.groupBy("zone").agg(F.sum("n").alias("n_points"), F.min("first").alias("first_point"))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false ELSE o_totalprice > 100000 END AS valid FROM orders
""")
def q_validity(t: Tables):
    """Proper quadrilaterals, bow ties, and quadrilaterals that may have no area."""
    x, y = (F.col("o_orderkey") % 360).cast("double"), F.lit(1.0)
    w = F.when((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") <= 100000), 0.0).otherwise(2.0)
    ring = F.when(F.col("o_orderstatus") == "O", quad(x, y, w, w, bow=True)).otherwise(quad(x, y, w, w))
    g = t.wide("orders", "o_orderkey", "o_orderstatus", "o_totalprice").select("o_orderkey", F.array(F.array(ring)).alias("shape"))
    return ops.flag_valid(g, "shape").select("o_orderkey", "valid")


@query("""
SELECT 'valid' AS kind, count(*) AS n, min(p_partkey) AS first_id FROM part WHERE p_size % 3 <> 0
UNION ALL SELECT 'quarantined', count(*), min(p_partkey) FROM part WHERE p_size % 3 = 0
""")
def q_quarantine(t: Tables):
    """Rows with an invalid shape set aside from the rest."""
    x, y, w = (F.col("p_partkey") % 50).cast("double"), F.col("p_size").cast("double"), F.lit(2.0)
    ring = F.when(F.col("p_size") % 3 == 0, quad(x, y, w, w, bow=True)).otherwise(quad(x, y, w, w))
    good, bad = ops.split_valid(t.part.select("p_partkey", F.array(F.array(ring)).alias("shape")), "shape")

    def counted(df, kind):
        return df.agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first_id")).withColumn("kind", F.lit(kind))

    return counted(good, "valid").unionByName(counted(bad, "quarantined"))


@query("""
WITH i AS (SELECT p_partkey, CAST(p_partkey % 50 AS DOUBLE) AS x, CAST(p_size AS DOUBLE) AS y, p_type FROM part)
SELECT CAST(p_partkey AS VARCHAR) || '_fra_D0' || substr(p_type, 1, 1) AS id,
       CASE p_type WHEN 'SMALL' THEN 'edge' WHEN 'LARGE' THEN 'green_zone' ELSE 'electric_pole' END AS nature,
       CASE p_type WHEN 'SMALL' THEN x + 1.5 WHEN 'LARGE' THEN x + 1 ELSE x END AS cx, CASE p_type WHEN 'LARGE' THEN y + 1 ELSE y END AS cy
FROM i WHERE p_type IN ('SMALL', 'LARGE', 'PROMO')
""")
def q_item_layers(t: Tables):
    """Tagged layers of lines, shapes and points; items without a geometry are dropped."""
    x, y = (F.col("p_partkey") % 50).cast("double"), F.col("p_size").cast("double")
    z = F.struct(x.alias("x"), y.alias("y"), F.lit(9.0).alias("z"))
    base = t.part.select("p_partkey", "p_type", x.alias("x"), y.alias("y"), z.alias("z"))
    layer = F.concat(F.lit("D0"), F.substring("p_type", 1, 1))
    ident = F.concat(F.col("p_partkey").cast("string"), F.lit("_fra_"), layer).alias("id")
    cx, cy = F.col("x"), F.col("y")
    edges = base.filter("p_type = 'SMALL'").select(
        ident, F.lit("edge").alias("nature"), F.array(F.array(pt(cx, cy), pt(cx + 3, cy))).alias("lines")
    )
    zones = base.filter("p_type = 'LARGE'").select(
        ident, F.lit("green_zone").alias("nature"), F.array(F.array(quad(cx, cy, F.lit(2.0), F.lit(2.0)))).alias("shape")
    )
    poles = base.filter("p_type = 'PROMO'").select(ident, F.lit("electric_pole").alias("nature"), geo.force2d(F.col("z"), 0).alias("point"))
    nothing = base.filter("p_type in ('MEDIUM', 'ECONOMY', 'STANDARD')").select(ident, F.lit("none").alias("nature"))
    from agrimill.operators.reshape import union_families

    items = ops.item_centroid(union_families([edges, zones, poles, nothing]))
    return items.select("id", "nature", F.col("centroid.x").alias("cx"), F.col("centroid.y").alias("cy"))


_NLON, _NLAT = lambert_sql("(600000.0 + 1000 * n_nationkey + 500)", "(6500000.0 + 500)")


@query(f"""
WITH n AS (SELECT n_nationkey, round({_NLON}, 3) AS x, round({_NLAT}, 3) AS y FROM nation WHERE n_regionkey <> 4)
SELECT c_custkey, x AS cx, y AS cy FROM customer LEFT JOIN n ON c_nationkey = n_nationkey
""")
def q_attach_shape(t: Tables):
    """Commune squares of one kilometre in Lambert-93, reprojected and put on rows by code."""
    x = F.lit(600000.0) + F.col("n_nationkey") * 1000
    shapes = t.nation.filter("n_regionkey <> 4").select(
        F.col("n_nationkey").alias("insee"), F.array(F.array(quad(x, F.lit(6500000.0), F.lit(1000.0), F.lit(1000.0)))).alias("geom")
    )
    rows = t.customer.select("c_custkey", F.col("c_nationkey").alias("code"))
    out = ops.attach_shape(rows, shapes, "code", "insee", "geom", geo.LAMBERT93)
    return out.select("c_custkey", F.round("city_centroid.x", 3).alias("cx"), F.round("city_centroid.y", 3).alias("cy"))


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_size < 20 THEN '0' ELSE p_type END AS section, CAST(p_size AS DOUBLE) AS contenance,
       CAST(p_partkey % 50 AS DOUBLE) + 1 AS cx, CAST(p_size AS DOUBLE) + 1 AS cy FROM part
""")
def q_features(t: Tables):
    """GeoJSON features held as text: polygons and multi-polygons, some properties missing."""
    x, y = (F.col("p_partkey") % 50).cast("double"), F.col("p_size").cast("double")
    ring = F.transform(quad(x, y, F.lit(2.0), F.lit(2.0)), lambda p: F.array(p["x"], p["y"]))
    poly = F.to_json(F.array(ring))
    geom = F.when(F.col("p_type") == "SMALL", F.concat(F.lit('{"type":"MultiPolygon","coordinates":['), poly, F.lit("]}"))).otherwise(
        F.concat(F.lit('{"type":"Polygon","coordinates":'), poly, F.lit("}"))
    )
    props = F.to_json(F.struct(
        F.col("p_partkey").cast("string").alias("id"), F.when(F.col("p_size") >= 20, F.col("p_type")).alias("section"),
        F.col("p_size").alias("contenance"),
    ))
    body = F.concat(F.lit('{"type":"Feature","geometry":'), geom, F.lit(',"properties":'), props, F.lit("}"))
    from agrimill.sources.documents import parse_features

    out = ops.with_centroid(parse_features(t.wide("part", "p_partkey", "p_size", "p_type").select(body.alias("body")), "body"), "shape")
    return out.select("id", "section", "contenance", F.col("centroid.x").alias("cx"), F.col("centroid.y").alias("cy"))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_nationkey < 5 THEN '0' ELSE c_mktsegment END AS section, CAST(c_nationkey AS DOUBLE) AS contenance,
  '[[[' || c_nationkey || '.0,1.0],[3.0,4.0]]]' AS corners FROM customer
""")
def q_feature_files(t: Tables):
    """GeoJSON files of collections of up to 500 features, members after or before the type, read in pieces."""
    props = F.to_json(F.struct(
        F.col("c_custkey").cast("string").alias("id"), F.when(F.col("c_nationkey") >= 5, F.col("c_mktsegment")).alias("section"),
        F.col("c_nationkey").alias("contenance"),
    ))
    ring = F.concat(F.lit("[[["), F.col("c_nationkey").cast("string"), F.lit(".0,1.0],[3.0, 4.0]]]"))
    members = F.concat(F.lit('"geometry": {"type": "Polygon", "coordinates": '), ring, F.lit('}, "properties": '), props)
    late = F.col("c_custkey") % 1000 < 500
    feature = F.concat(F.lit("{"), F.when(late, F.concat(members, F.lit(', "type": "Feature"'))).otherwise(F.concat(F.lit('"type": "Feature", '), members)), F.lit("}"))
    # Keys are unique, so a collection is bounded.
    group = F.floor(F.col("c_custkey") / 500)
    listed = t.customer.groupBy(late.alias("late"), group.alias("g")).agg(F.array_join(F.collect_list(feature), ",\n").alias("all"))
    folder = shared_path(t.spark, "features")
    document = F.concat(F.lit('{"type": "FeatureCollection",\n"features": [\n'), F.col("all"), F.lit("\n]}"))
    listed.select("late", document.alias("value")).write.partitionBy("late").text(folder)
    from agrimill.sources.documents import read_geojson

    corners = F.to_json(F.transform(F.get(F.col("shape"), F.lit(0)), lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"]))))
    return read_geojson(t.spark, folder).select("id", "section", "contenance", corners.alias("corners"))


@query("""
SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN 2 ELSE 1 END AS n_parts, CAST(p_size AS DOUBLE) + CASE WHEN p_type = 'SMALL' THEN 3.5 ELSE 1.5 END AS cx, 2154 AS srid FROM part
""")
def q_ingest_geometry(t: Tables):
    """Line geometry held as GeoJSON text, single lines wrapped as multi lines."""
    from agrimill.sources.documents import ingest_geometry

    x = F.col("p_size")

    def line(start):
        return F.to_json(F.array(F.array(x + start, F.lit(0)), F.array(x + start + 3, F.lit(0))))

    many = F.concat(F.lit('{"type":"MultiLineString","coordinates":['), line(0), F.lit(","), line(4), F.lit("]}"))
    one = F.concat(F.lit('{"type":"LineString","coordinates":'), line(0), F.lit("}"))
    raw = t.part.select("p_partkey", F.when(F.col("p_type") == "SMALL", many).otherwise(one).alias("geom"))
    g = ingest_geometry(raw, "geom", 2, 2154)
    return g.select("p_partkey", F.size("geom").alias("n_parts"), geo.centroid_multiline(F.col("geom"))["x"].alias("cx"), "srid")
