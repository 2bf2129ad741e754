"""Geometry against analytic shapes, forward projections and brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from agrimill.functions import geometry as geo
from agrimill.operators import geometry as ops
from agrimill.specs import LINE, MULTILINE, MULTIPOLYGON, POINT, POLYGON
from tests.conftest import ring, rows


def floats(value):
    if isinstance(value, (list, tuple)):
        return type(value)(floats(v) for v in value)
    return float(value) if isinstance(value, int) else value


def shape(spark, value, kind=MULTIPOLYGON):
    return spark.createDataFrame([(floats(value),)], f"g {kind}")


def centre(df, f):
    p = df.select(f(F.col("g")).alias("c")).collect()[0]["c"]
    return None if p is None else (p["x"], p["y"])


def test_lambert_origin_and_round_trip(spark):
    p = spark.range(1).select(geo.to_wgs84(F.lit(700000.0), F.lit(6600000.0), 2154).alias("p")).collect()[0]["p"]
    assert (p["x"], p["y"]) == (pytest.approx(3.0, abs=1e-9), pytest.approx(46.5, abs=1e-9))

    def forward(lon, lat):
        phi = math.radians(lat)
        iso = math.atanh(math.sin(phi)) - geo.GRS80_E * math.atanh(geo.GRS80_E * math.sin(phi))
        r = geo.LAMBERT_C * math.exp(-geo.LAMBERT_N * iso)
        g = geo.LAMBERT_N * math.radians(lon - geo.LAMBERT_LON0)
        return geo.LAMBERT_XS + r * math.sin(g), geo.LAMBERT_YS - r * math.cos(g)

    pts = [(-4.5, 48.4), (7.75, 48.58), (2.35, 48.85), (9.4, 42.7)]
    df = spark.createDataFrame([(*forward(*p), *p) for p in pts], "x double, y double, lon double, lat double")
    for r in df.select(geo.lambert93_to_wgs84(F.col("x"), F.col("y")).alias("p"), "lon", "lat").collect():
        assert (r["p"]["x"], r["p"]["y"]) == (pytest.approx(r["lon"], abs=1e-9), pytest.approx(r["lat"], abs=1e-9))


def utm_forward(lon, lat, lon0, north):
    """Krüger forward series, kept apart from the code under test."""
    f = geo.GRS80_F
    n = f / (2 - f)
    a_bar = geo.GRS80_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
             61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280]
    phi, lam, e = math.radians(lat), math.radians(lon - lon0), geo.GRS80_E
    t = math.sinh(math.atanh(math.sin(phi)) - e * math.atanh(e * math.sin(phi)))
    xi, eta = math.atan2(t, math.cos(lam)), math.atanh(math.sin(lam) / math.hypot(1, t))
    x = eta + sum(a * math.cos(2 * j * xi) * math.sinh(2 * j * eta) for j, a in enumerate(alpha, 1))
    y = xi + sum(a * math.sin(2 * j * xi) * math.cosh(2 * j * eta) for j, a in enumerate(alpha, 1))
    return 500000 + 0.9996 * a_bar * x, north + 0.9996 * a_bar * y


def test_utm_zones_round_trip_with_srid_column(spark):
    spots = {5490: (-61.5, 16.2), 2972: (-52.3, 4.9), 2975: (55.5, -21.1), 4467: (-56.2, 46.8), 4471: (45.2, -12.8)}
    data = [(*utm_forward(*ll, *geo.UTM_ZONES[z]), z, *ll) for z, ll in spots.items()] + [(2.0, 48.0, 4326, 2.0, 48.0)]
    df = spark.createDataFrame(data, "x double, y double, srid int, lon double, lat double")
    for r in df.select(geo.to_wgs84(F.col("x"), F.col("y"), F.col("srid")).alias("p"), "lon", "lat").collect():
        assert (r["p"]["x"], r["p"]["y"]) == (pytest.approx(r["lon"], abs=1e-8), pytest.approx(r["lat"], abs=1e-8))


def test_unknown_srid(spark):
    with pytest.raises(ValueError, match="unsupported SRID"):
        geo.to_wgs84(F.lit(1.0), F.lit(2.0), 1234)
    with pytest.raises(Exception, match="unsupported SRID: 99"):
        spark.range(1).select(geo.to_wgs84(F.lit(1.0), F.lit(2.0), F.lit(99))).collect()


def test_missing_coordinate_gives_null(spark):
    assert spark.range(1).select(geo.to_wgs84(F.lit(None).cast("double"), F.lit(2.0), 2154)).collect()[0][0] is None


def test_centroids(spark):
    hole = [[ring(0, 0, 4, 4), ring(0, 0, 2, 2)]]
    assert centre(shape(spark, hole), geo.centroid_multipolygon) == (pytest.approx(28 / 12), pytest.approx(28 / 12))
    turned = [[ring(0, 0, 4, 4)[::-1], ring(0, 0, 2, 2)]]
    assert centre(shape(spark, turned), geo.centroid_multipolygon) == (pytest.approx(28 / 12), pytest.approx(28 / 12))
    triangle = [[[(0, 0), (6, 0), (0, 3), (0, 0)]]]
    assert centre(shape(spark, triangle), geo.centroid_multipolygon) == (pytest.approx(2), pytest.approx(1))
    two = [[ring(0, 0, 2, 2)], [ring(10, 0, 1, 1)]]
    assert centre(shape(spark, two), geo.centroid_multipolygon) == (pytest.approx((4 * 1 + 10.5) / 5), pytest.approx((4 * 1 + 0.5) / 5))
    assert centre(shape(spark, [[(0, 0), (2, 0), (2, 6)]], MULTILINE), geo.centroid_multiline) == (pytest.approx(14 / 8), pytest.approx(18 / 8))
    assert centre(shape(spark, [ring(1, 1, 2, 2)], POLYGON), geo.centroid_polygon) == (2.0, 2.0)
    flat = [[[(0, 0), (1, 1), (0, 0), (0, 0)]]]
    assert centre(shape(spark, flat), geo.centroid_multipolygon) is None


def test_centroid_far_from_origin_is_precise(spark):
    g = [[ring(1e7, 1e7, 1e-3, 1e-3)]]
    x, y = centre(shape(spark, g), geo.centroid_multipolygon)
    assert abs(x - (1e7 + 5e-4)) < 1e-8 and abs(y - (1e7 + 5e-4)) < 1e-8


SHAPES = [
    ([[ring(0, 0, 1, 1)]], True), ([[[(0, 0), (1, 1), (1, 0), (0, 1), (0, 0)]]], False), ([[[(0, 0), (1, 0), (1, 1)]]], False),
    ([[[(0, 0), (1, 0), (1, 1), (0, 1)]]], False), ([[[(0, 0), (1, 1), (2, 2), (0, 0)]]], False), ([], False), (None, False),
    ([[[(0, 0), (float("nan"), 0), (1, 1), (0, 0)]]], False), ([[ring(0, 0, 4, 4), ring(1, 1, 1, 1)]], True),
    # Holes outside the shell, inside another hole, and touching it in one point.
    ([[ring(0, 0, 4, 4), ring(5, 5, 1, 1)]], False), ([[ring(0, 0, 9, 9), ring(1, 1, 5, 5), ring(2, 2, 1, 1)]], False),
    ([[ring(0, 0, 4, 4), [(0, 2), (1, 1), (1, 3), (0, 2)]]], True), ([[ring(0, 0, 4, 4), ring(0, 1, 1, 1)]], False),
    ([[ring(0, 0, 4, 4), ring(1, 1, 1, 1), ring(2, 2, 1, 1)]], True), ([[ring(0, 0, 4, 4), ring(0, 0, 4, 4)]], False),
    # A hole whose points all lie on the shell, but which is outside of it.
    ([[[(0, 0), (4, 0), (2, 2), (4, 4), (0, 4), (0, 0)], [(4, 0), (4, 4), (2, 2), (4, 0)]]], False),
    # Rings that touch themselves in a point, run back on themselves, and repeat a point.
    ([[[(0, 0), (2, 0), (1, 1), (2, 2), (0, 2), (1, 1), (0, 0)]]], False), ([[[(0, 0), (4, 0), (4, 4), (4, 6), (4, 4), (0, 4), (0, 0)]]], False),
    ([[[(0, 0), (1, 0), (1, 0), (1, 1), (0, 1), (0, 0)]]], True),
    # Polygons apart, touching in a point, along an edge, inside each other, and inside a hole of another.
    ([[ring(0, 0, 1, 1)], [ring(3, 3, 1, 1)]], True), ([[ring(0, 0, 1, 1)], [ring(1, 1, 1, 1)]], True), ([[ring(0, 0, 1, 1)], [ring(1, 0, 1, 1)]], False),
    ([[ring(0, 0, 5, 5)], [ring(1, 1, 1, 1)]], False), ([[ring(0, 0, 9, 9), ring(2, 2, 5, 5)], [ring(3, 3, 1, 1)]], True),
]


@pytest.mark.parametrize("row_edges", [None, 0, 6])
def test_validity(spark, row_edges):
    df = spark.createDataFrame([(i, floats(g)) for i, (g, _) in enumerate(SHAPES)], f"id int, g {MULTIPOLYGON}")
    got = ops.flag_valid(df, "g", row_edges=row_edges).select("id", "valid").collect()
    assert sorted(tuple(r) for r in got) == [(i, valid) for i, (_, valid) in enumerate(SHAPES)]


def test_validity_of_one_polygon(spark):
    df = spark.createDataFrame([(1, floats([ring(0, 0, 4, 4)])), (2, floats([ring(0, 0, 4, 4), ring(5, 5, 1, 1)])), (2, None)], f"id int, valid {POLYGON}")
    for row_edges in (None, 0):
        got = ops.flag_valid(df.withColumnRenamed("valid", "g"), "g", depth=2, row_edges=row_edges).select("id", "valid").collect()
        assert sorted(tuple(r) for r in got) == [(1, True), (2, False), (2, False)]


def test_validity_of_many_edges(spark):
    n = 20_000
    coast = [(math.cos(2 * math.pi * k / n) * (1 + 0.01 * math.sin(k / 9)), math.sin(2 * math.pi * k / n) * (1 + 0.01 * math.sin(k / 9))) for k in range(n)]
    comb = [p for k in range(n // 4) for p in ((4.0 * k, 0.0), (4.0 * k + 1, 50.0), (4.0 * k + 2, 50.0), (4.0 * k + 3, 0.0))] + [(float(n), -5.0), (0.0, -5.0)]
    crossed = list(comb)
    crossed[101] = (crossed[101][0] + 9, crossed[101][1])
    closed = [r + r[:1] for r in (coast, comb, crossed)]
    df = spark.createDataFrame([(1, [[closed[0], ring(0, 0, 0.1, 0.1)]]), (2, [[closed[1]]]), (3, [[closed[2]]]), (4, [[closed[0], ring(5, 0, 1, 1)]]), (5, [[closed[0]], [ring(0, 0, 0.5, 0.5)]])], f"id int, g {MULTIPOLYGON}")
    got = ops.flag_valid(df, "g").select("id", "valid").collect()
    assert sorted(tuple(r) for r in got) == [(1, True), (2, True), (3, False), (4, False), (5, False)]


def test_points_in_polygons_of_many_edges(spark):
    rnd = random.Random(8)

    def coast(cx, cy, size, n):
        r = [(cx + size * (1 + 0.3 * rnd.random()) * math.cos(2 * math.pi * k / n), cy + size * (1 + 0.3 * rnd.random()) * math.sin(2 * math.pi * k / n)) for k in range(n)]
        return r + r[:1]

    polys = [(k, coast(rnd.uniform(0, 20), rnd.uniform(0, 20), rnd.choice([0.4, 3.0, 30.0]), rnd.choice([8, 70, 600]))) for k in range(30)]
    polys.append((30, polys[3][1]))  # equal shapes are found both
    points = [(i, rnd.uniform(-10, 30), rnd.uniform(-10, 30)) for i in range(400)] + [(500 + i, *polys[i][1][2]) for i in range(30)]
    pdf = spark.createDataFrame([(i, (x, y)) for i, x, y in points] + [(999, None)], f"pid int, p {POINT}")
    gdf = spark.createDataFrame([(k, [[r]]) for k, r in polys] + [(99, None)], f"gid int, g {MULTIPOLYGON}")
    want = sorted((i, k) for i, x, y in points for k, r in polys if brute(x, y, r))
    for part in (gdf, gdf.where("size(g[0][0]) > 65")):
        kept = {r["gid"] for r in part.collect()}
        got = sorted(tuple(r) for r in ops.point_in_polygon_join(pdf, part, "p", "g", cell=0.5).select("pid", "gid").collect())
        assert got == [w for w in want if w[1] in kept]


@pytest.mark.parametrize("x,y,inside", [
    (1.0, 1.0, True), (0.0, 2.0, True), (4.0, 4.0, True), (2.5, 2.5, False), (2.0, 2.5, True), (5.0, 1.0, False), (0.0, -0.1, False),
])
def test_covers_boundary_and_hole(spark, x, y, inside):
    g = shape(spark, [[ring(0, 0, 4, 4), ring(2, 2, 1, 1)]])
    assert g.select(geo.covers(geo.edges(F.col("g"), 3), F.lit(x), F.lit(y))).collect()[0][0] is inside


def brute(px, py, r):
    odd = False
    for (x1, y1), (x2, y2) in zip(r, r[1:]):
        if (x2 - x1) * (py - y1) == (y2 - y1) * (px - x1) and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
            return True
        if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


@pytest.mark.parametrize("options", [
    {}, {"cell": 5.0}, {"cell": 0.3, "levels": [0]}, {"cell": 0.5, "levels": [1, 3]}, {"hot_rows": 20, "salts": 3},
])
def test_point_in_polygon_join_matches_brute_force(spark, options):
    rnd = random.Random(5)
    polys = []
    for k in range(40):
        cx, cy, size = rnd.uniform(-20, 20), rnd.uniform(-20, 20), rnd.choice([0.05, 0.5, 3, 15])
        angles = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(7))
        pts = [(cx + size * rnd.uniform(0.4, 1) * math.cos(a), cy + size * rnd.uniform(0.4, 1) * math.sin(a)) for a in angles]
        polys.append((k, pts + pts[:1]))
    points = [(i, rnd.uniform(-25, 25), rnd.uniform(-25, 25)) for i in range(150)]
    points += [(1000 + i, *polys[i][1][0]) for i in range(10)] + [(2000 + i, 3.0, 3.0) for i in range(50)]
    pdf = spark.createDataFrame([(i, (x, y)) for i, x, y in points], f"pid int, p {POINT}")
    gdf = spark.createDataFrame([(k, [[r]]) for k, r in polys], f"gid int, g {MULTIPOLYGON}")
    got = {tuple(r) for r in ops.point_in_polygon_join(pdf, gdf, "p", "g", **{"cell": 1.0, **options}).select("pid", "gid").collect()}
    want = {(i, k) for i, x, y in points for k, r in polys if brute(x, y, r)}
    assert got == want


@pytest.mark.parametrize("options", [{}, {"cell": 0.5, "levels": [1, 3], "hot_rows": 20, "salts": 3}])
def test_totals_of_bundled_points_match_brute_force(spark, options):
    rnd = random.Random(6)
    polys = []
    for k in range(40):
        cx, cy, size = rnd.uniform(-20, 20), rnd.uniform(-20, 20), rnd.choice([0.05, 0.5, 3, 15])
        angles = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(70 if k == 7 else 7))
        pts = [(cx + size * rnd.uniform(0.4, 1) * math.cos(a), cy + size * rnd.uniform(0.4, 1) * math.sin(a)) for a in angles]
        polys.append((k, pts + pts[:1]))
    polys += [(50 + i, ring(i, i, 4, 3)) for i in range(-5, 5)] + [(50, ring(0, 0, 9, 9))]
    points = [(i, rnd.uniform(-25, 25), rnd.uniform(-25, 25)) for i in range(400)] + [(500 + i, rnd.gauss(3, 0.1), rnd.gauss(3, 0.1)) for i in range(200)]
    points += [(1000 + i, *polys[i][1][0]) for i in range(10)] + [(2000 + i, 3.0, 3.0) for i in range(50)] + [(3000 + i, i % 9 - 0.0, i % 7 + 0.5) for i in range(63)]
    pdf = spark.createDataFrame([(i, (x, y)) for i, x, y in points] + [(9999, None), (9998, (None, 3.0))], f"pid int, p {POINT}")
    gdf = spark.createDataFrame([(k, [[r]]) for k, r in polys] + [(99, None), (98, [])], f"gid int, g {MULTIPOLYGON}")
    totals = [F.count(F.lit(1)).alias("n"), F.min("pid").alias("first")]
    hits = ops.point_in_polygon_join(pdf, gdf, "p", "g", **{"cell": 1.0, **options}, totals=totals)
    assert hits.columns == ["gid", "n", "first"]
    got = {r["gid"]: (r["n"], r["first"]) for r in hits.groupBy("gid").agg(F.sum("n").alias("n"), F.min("first").alias("first")).collect()}
    inside = {}
    for k, r in polys:
        inside.setdefault(k, []).extend(i for i, x, y in points if brute(x, y, r))
    assert got == {k: (len(v), min(v)) for k, v in inside.items() if v}
    none = ops.point_in_polygon_join(pdf, gdf.where("gid < 0"), "p", "g", cell=90.0, totals=totals)
    assert none.columns == hits.columns and none.isEmpty()
    assert ops.point_in_polygon_join(pdf.where("pid < 0"), gdf.where("gid <> 7"), "p", "g", cell=90.0, totals=totals).isEmpty()


def test_bundles_of_points_are_no_pairs(spark):
    from driver_queries.spatial import pip_totals

    # 20,000 points that are all different, and 30 polygons around most of them.
    pts = spark.range(20_000).select(F.col("id").alias("o_orderkey"), geo.point(F.col("id") * 0.00731 % 10, F.col("id") * 0.01937 % 10).alias("p"))
    quads = spark.createDataFrame([(k, [[ring(0.01 * k, 0.02 * k, 9, 9)]]) for k in range(30)], f"zone int, g {MULTIPOLYGON}")
    hits = ops.point_in_polygon_join(pts, quads, "p", "g", cell=1.0, totals=pip_totals())
    pairs = ops.point_in_polygon_join(pts, quads, "p", "g", cell=1.0)
    assert rows(hits.groupBy("zone").agg(F.sum("n"), F.min("first"))) == rows(pairs.groupBy("zone").agg(F.count(F.lit(1)), F.min("o_orderkey")))
    assert hits.count() < pairs.count() / 10


def test_join_is_an_equi_join(spark):
    pdf = spark.createDataFrame([(1, (0.0, 0.0))], f"pid int, p {POINT}")
    gdf = spark.createDataFrame([(1, [[ring(0, 0, 1, 1)]])], f"gid int, g {MULTIPOLYGON}")
    plan = ops.point_in_polygon_join(pdf, gdf, "p", "g")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_join_skips_missing_geometry(spark):
    pdf = spark.createDataFrame([(1, (0.5, 0.5)), (2, None), (3, (None, 1.0))], f"pid int, p {POINT}")
    gdf = spark.createDataFrame([(1, [[ring(0, 0, 1, 1)]]), (2, None), (3, []), (4, [[]])], f"gid int, g {MULTIPOLYGON}")
    assert rows(ops.point_in_polygon_join(pdf, gdf, "p", "g"), "pid", "gid") == [(1, 1)]


def test_dump_and_force2d(spark):
    df = spark.createDataFrame([(1, [[(0.0, 1.0, 9.0)], [(2.0, 3.0, 9.0)]])], "id int, g array<array<struct<x:double,y:double,z:double>>>")
    flat = df.select("id", geo.force2d(F.col("g"), 2).alias("g"))
    assert [(r["part"], [tuple(p) for p in r["g"]]) for r in ops.dump(flat, "g").collect()] == [(0, [(0.0, 1.0)]), (1, [(2.0, 3.0)])]


def test_item_centroid_precedence(spark):
    schema = f"id int, point {POINT}, lines {MULTILINE}, shape {MULTIPOLYGON}"
    sq, ln = [[ring(0, 0, 2, 2)]], [[(0.0, 0.0), (4.0, 0.0)]]
    bow = floats([[[(0, 0), (1, 1), (1, 0), (0, 1), (0, 0)]]])
    df = spark.createDataFrame([(1, (9.0, 9.0), ln, sq), (2, None, ln, sq), (3, None, None, sq), (4, None, None, bow), (5, None, None, None)], schema)
    got = {r["id"]: tuple(r["centroid"]) for r in ops.item_centroid(df).collect()}
    assert got == {1: (9.0, 9.0), 2: (2.0, 0.0), 3: (1.0, 1.0)}


def test_within_is_planar_and_pushes_box(spark, tmp_path):
    path = str(tmp_path / "pts")
    spark.createDataFrame([((0.0, 0.0),), ((0.3, 0.4),), ((0.4, 0.4),)], f"centroid {POINT}").write.parquet(path)
    out = ops.within_any(spark.read.parquet(path), "centroid", [(0.0, 0.0, 0.5)])
    assert rows(out.select("centroid.x", "centroid.y")) == [(0.0, 0.0), (0.3, 0.4)]
    assert "GreaterThanOrEqual(centroid.x,-0.5)" in out._jdf.queryExecution().executedPlan().toString()


def test_line_schema_is_the_inner_level():
    assert MULTILINE == f"array<{LINE}>"
