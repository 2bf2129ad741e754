"""Geometry held as nested arrays of points, as Column expressions.

Point: ``struct<x,y>``. Line and ring: array of points. Polygon: array of rings,
shell first. A multi geometry has one more array level. x is longitude.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, functions as F

WGS84 = 4326

# Ellipsoid GRS 80 shared by all supported projections.
GRS80_A = 6378137.0
GRS80_F = 1 / 298.257222101
GRS80_E = math.sqrt(2 * GRS80_F - GRS80_F * GRS80_F)

# Projection Lambert-93 (EPSG 2154).
LAMBERT93 = 2154
LAMBERT_N = 0.7256077650532670
LAMBERT_C = 11754255.426096
LAMBERT_XS = 700000.0
LAMBERT_YS = 12655612.049876
LAMBERT_LON0 = 3.0

# UTM zones by EPSG code: central meridian in degrees, false northing.
UTM_ZONES = {
    5490: (-63.0, 0.0),
    2972: (-51.0, 0.0),
    2975: (57.0, 10000000.0),
    4467: (-57.0, 0.0),
    4471: (45.0, 10000000.0),
}
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0


def point(x: Column, y: Column) -> Column:
    """Point from longitude and latitude; NULL when one of them is."""
    return F.when(x.isNotNull() & y.isNotNull(), F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))


def _xy(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


# ---- reprojection -----------------------------------------------------------


def lambert93_to_wgs84(x: Column, y: Column, steps: int = 6) -> Column:
    """Inverse Lambert conformal conic; latitude by a fixed number of fixed-point steps."""
    dx = x - F.lit(LAMBERT_XS)
    dy = F.lit(LAMBERT_YS) - y
    lon = F.degrees(F.atan2(dx, dy) / LAMBERT_N) + LAMBERT_LON0
    iso = F.log(F.sqrt(dx * dx + dy * dy) / LAMBERT_C) * (-1 / LAMBERT_N)
    half_pi = math.pi / 2
    lat = F.atan(F.exp(iso)) * 2 - half_pi
    for _ in range(steps):
        lat = F.atan(F.exp(iso + F.atanh(F.sin(lat) * GRS80_E) * GRS80_E)) * 2 - half_pi
    return _xy(lon, F.degrees(lat))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def utm_to_wgs84(x: Column, y: Column, lon0: Column, false_northing: Column) -> Column:
    """Inverse transverse Mercator by the Krüger series, to the fourth order."""
    n = GRS80_F / (2 - GRS80_F)
    a_bar = GRS80_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
        17 * n**3 / 480 - 37 * n**4 / 840,
        4397 * n**4 / 161280,
    )
    delta = (
        2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45,
        7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
        56 * n**3 / 15 - 136 * n**4 / 35,
        4279 * n**4 / 630,
    )

    def conformal(p: Column) -> Column:
        xi, eta = p["xi"], p["eta"]
        for j, b in enumerate(beta, 1):
            xi = xi - F.sin(p["xi"] * (2 * j)) * F.cosh(p["eta"] * (2 * j)) * b
            eta = eta - F.cos(p["xi"] * (2 * j)) * F.sinh(p["eta"] * (2 * j)) * b
        return F.struct(xi.alias("xi"), eta.alias("eta"))

    def sphere(p: Column) -> Column:
        return F.struct(
            F.asin(F.sin(p["xi"]) / F.cosh(p["eta"])).alias("chi"),
            (lon0 + F.degrees(F.atan2(F.sinh(p["eta"]), F.cos(p["xi"])))).alias("lon"),
        )

    def ellipsoid(p: Column) -> Column:
        lat = p["chi"]
        for j, d in enumerate(delta, 1):
            lat = lat + F.sin(p["chi"] * (2 * j)) * d
        return _xy(p["lon"], F.degrees(lat))

    plane = F.struct(
        ((y - false_northing) / (UTM_K0 * a_bar)).alias("xi"),
        ((x - F.lit(UTM_FALSE_EASTING)) / (UTM_K0 * a_bar)).alias("eta"),
    )
    return _let(plane, lambda p: _let(conformal(p), lambda q: _let(sphere(q), ellipsoid)))


def to_wgs84(x: Column, y: Column, srid: Column | int) -> Column:
    """Planar coordinates to a WGS 84 point.

    ``srid`` is one code, or a column when shards of several zones are read
    together. NULL coordinates give NULL; an unsupported code fails the job.
    """
    if isinstance(srid, int):
        if srid == WGS84:
            out = _xy(x, y)
        elif srid == LAMBERT93:
            out = lambert93_to_wgs84(x, y)
        elif srid in UTM_ZONES:
            lon0, north = UTM_ZONES[srid]
            out = utm_to_wgs84(x, y, F.lit(lon0), F.lit(north))
        else:
            raise ValueError(f"unsupported SRID: {srid}")
        return F.when(x.isNotNull() & y.isNotNull(), out)
    lon0 = F.try_element_at(F.create_map(*[F.lit(v) for k, z in UTM_ZONES.items() for v in (k, z[0])]), srid.cast("int"))
    north = F.try_element_at(F.create_map(*[F.lit(v) for k, z in UTM_ZONES.items() for v in (k, z[1])]), srid.cast("int"))
    out = (
        F.when(srid == WGS84, _xy(x, y))
        .when(srid == LAMBERT93, lambert93_to_wgs84(x, y))
        .when(srid.isin(*UTM_ZONES), utm_to_wgs84(x, y, lon0, north))
    )
    missing = F.raise_error(F.concat(F.lit("unsupported SRID: "), F.coalesce(srid.cast("string"), F.lit("NULL"))))
    return F.when(x.isNotNull() & y.isNotNull(), out.otherwise(missing.cast("struct<x:double,y:double>")))


def map_points(geom: Column, depth: int, f: Callable[[Column], Column]) -> Column:
    """Apply ``f`` to every point; depth 0 is a point, 3 a multi-polygon."""
    if depth == 0:
        return f(geom)
    return F.transform(geom, lambda g: map_points(g, depth - 1, f))


def reproject(geom: Column, depth: int, srid: Column | int) -> Column:
    """Whole geometry to WGS 84."""
    return map_points(geom, depth, lambda p: to_wgs84(p["x"], p["y"], srid))


def force2d(geom: Column, depth: int) -> Column:
    """Keep x and y of every point."""
    return map_points(geom, depth, lambda p: _xy(p["x"], p["y"]))


def from_coordinates(coords: Column, depth: int) -> Column:
    """GeoJSON coordinate arrays (``[x, y, ...]`` at the innermost level) to points."""
    return map_points(coords, depth, lambda c: _xy(F.get(c, 0), F.get(c, 1)))


def multi(geom: Column) -> Column:
    """Single geometry as a multi geometry of one part."""
    return F.when(geom.isNotNull(), F.array(geom))


# ---- measures ---------------------------------------------------------------


def _zero() -> Column:
    return F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))


def _moved(points: Column, origin: Column) -> Column:
    return F.transform(points, lambda p: _xy(p["x"] - origin["x"], p["y"] - origin["y"]))


def _edge_terms(points: Column, f: Callable[[Column, Column], Column]) -> Column:
    """``f(p, q)`` for each pair of neighbours; nothing for fewer than two points."""
    n = F.greatest(F.size(points) - 1, F.lit(0))
    return F.zip_with(F.slice(points, F.lit(1), n), F.slice(points, F.lit(2), n), f)


def _sum_terms(terms: Column) -> Column:
    """Weights ``w`` and weighted positions summed to ``a``, ``mx``, ``my``."""
    return F.aggregate(
        terms,
        _zero(),
        lambda acc, t: F.struct(
            (acc["a"] + t["w"]).alias("a"), (acc["mx"] + t["x"] * t["w"]).alias("mx"), (acc["my"] + t["y"] * t["w"]).alias("my")
        ),
    )


def _ring_sums(ring: Column, origin: Column) -> Column:
    """Twice the signed area of a closed ring, and three times its first moments.

    The walk starts at the origin: the edge from there to the first vertex has
    no area, so it adds nothing.
    """
    start = F.struct(*[F.lit(0.0).alias(n) for n in ("a", "mx", "my", "px", "py")])

    def step(acc: Column, p: Column) -> Column:
        qx, qy = p["x"] - origin["x"], p["y"] - origin["y"]
        cross = acc["px"] * qy - qx * acc["py"]
        return F.struct(
            (acc["a"] + cross).alias("a"), (acc["mx"] + (acc["px"] + qx) * cross).alias("mx"),
            (acc["my"] + (acc["py"] + qy) * cross).alias("my"), qx.alias("px"), qy.alias("py"),
        )

    return F.aggregate(ring, start, step)


def _line_sums(line: Column, origin: Column) -> Column:
    """Length of a line and its length-weighted sums."""
    terms = _edge_terms(
        _moved(line, origin),
        lambda p, q: F.struct(
            F.hypot(q["x"] - p["x"], q["y"] - p["y"]).alias("w"),
            ((p["x"] + q["x"]) / 2).alias("x"), ((p["y"] + q["y"]) / 2).alias("y"),
        ),
    )
    return _sum_terms(terms)


def _total(sums: Column) -> Column:
    return F.aggregate(
        sums,
        _zero(),
        lambda acc, s: F.struct(
            (acc["a"] + s["a"]).alias("a"), (acc["mx"] + s["mx"]).alias("mx"), (acc["my"] + s["my"]).alias("my")
        ),
    )


def _signed_by_role(s: Column, i: Column) -> Column:
    """Ring sums turned so that the shell (first ring) counts positive and holes negative."""
    return _let(
        F.signum(s["a"]) * F.when(i == 0, 1.0).otherwise(-1.0),
        lambda w: F.struct((s["a"] * w).alias("a"), (s["mx"] * w).alias("mx"), (s["my"] * w).alias("my")),
    )


def centroid_multipolygon(geom: Column) -> Column:
    """Area-weighted centroid; NULL without area. Sums start at the first vertex for precision."""

    def around(o: Column) -> Column:
        rings = F.transform(geom, lambda poly: F.transform(F.transform(poly, lambda r: _ring_sums(r, o)), _signed_by_role))
        return _let(
            _total(F.flatten(rings)),
            lambda s: F.when(s["a"] != 0, _xy(o["x"] + s["mx"] / (s["a"] * 3), o["y"] + s["my"] / (s["a"] * 3))),
        )

    return _let(F.get(F.get(F.get(geom, 0), 0), 0), around)


def centroid_multiline(geom: Column) -> Column:
    """Length-weighted centroid; NULL for zero length."""

    def around(o: Column) -> Column:
        return _let(
            _total(F.transform(geom, lambda line: _line_sums(line, o))),
            lambda s: F.when(s["a"] > 0, _xy(o["x"] + s["mx"] / s["a"], o["y"] + s["my"] / s["a"])),
        )

    return _let(F.get(F.get(geom, 0), 0), around)


def centroid_polygon(geom: Column) -> Column:
    return centroid_multipolygon(F.array(geom))


def twice_area(ring: Column) -> Column:
    """Twice the signed area of a ring, summed from its first vertex."""
    return _let(F.get(ring, 0), lambda o: _ring_sums(ring, o)["a"])


def bbox(geom: Column, depth: int) -> Column:
    """``struct<minx, miny, maxx, maxy>`` over every point."""
    points = geom
    for _ in range(depth - 1):
        points = F.flatten(points)
    xs = F.transform(points, lambda p: p["x"])
    ys = F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"),
        F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"),
    )


# ---- tests ------------------------------------------------------------------


def within(geom_x: Column, geom_y: Column, x: float, y: float, distance: float) -> Column:
    """Point within a planar distance, in degrees, of a fixed point.

    The box conjuncts come first and compare bare columns, so Parquet can skip
    row groups by their minimum and maximum.
    """
    box = (
        (geom_x >= x - distance) & (geom_x <= x + distance) & (geom_y >= y - distance) & (geom_y <= y + distance)
    )
    dx, dy = geom_x - F.lit(x), geom_y - F.lit(y)
    return box & (dx * dx + dy * dy <= distance * distance)


def edges(geom: Column, depth: int) -> Column:
    """All edges of all rings or lines as ``struct<x1, y1, x2, y2>``."""
    rings = geom
    for _ in range(depth - 2):
        rings = F.flatten(rings)

    def edge(p: Column, q: Column) -> Column:
        return F.struct(p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2"))

    return F.flatten(F.transform(rings, lambda r: _edge_terms(r, edge)))


def covers(edge_array: Column, x: Column, y: Column) -> Column:
    """Point inside, or on the boundary of, the area whose edges are given (even-odd rule)."""

    def crossed(e: Column) -> Column:
        return ((e["y1"] > y) != (e["y2"] > y)) & (
            x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]
        )

    odd = F.size(F.filter(edge_array, lambda e: F.coalesce(crossed(e), F.lit(False)))) % 2 == 1
    return odd | F.exists(edge_array, lambda e: on_edge(e, x, y))


def on_edge(e: Column, x: Column, y: Column) -> Column:
    """Point on the edge: between its ends on both axes, and on its line."""
    between_y = ((y >= e["y1"]) & (y <= e["y2"])) | ((y >= e["y2"]) & (y <= e["y1"]))
    between_x = ((x >= e["x1"]) & (x <= e["x2"])) | ((x >= e["x2"]) & (x <= e["x1"]))
    side = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
    return between_y & between_x & (side == 0)


def edge_meets_box(e: Column, low_x: Column, low_y: Column, high_x: Column, high_y: Column) -> Column:
    """Whether an edge may meet a box; a little widened, so that `covers` says the same of all points of a box that none meets."""
    dx, dy, tiny = e["x2"] - e["x1"], e["y2"] - e["y1"], F.lit(1e-12)
    wide, high = tiny * (F.abs(e["x1"]) + F.abs(e["x2"])), tiny * (F.abs(e["y1"]) + F.abs(e["y2"]))
    near = (
        (F.least(e["x1"], e["x2"]) - wide <= high_x) & (F.greatest(e["x1"], e["x2"]) + wide >= low_x)
        & (F.least(e["y1"], e["y2"]) - high <= high_y) & (F.greatest(e["y1"], e["y2"]) + high >= low_y)
    )
    corners = [(dx * (y - e["y1"]), dy * (x - e["x1"])) for x in (low_x, high_x) for y in (low_y, high_y)]
    sides = [(a - b, tiny * (F.abs(a) + F.abs(b)) + F.abs(dy) * wide + F.abs(dx) * high) for a, b in corners]
    left = reduce(lambda p, q: p & q, [side > slack for side, slack in sides])
    right = reduce(lambda p, q: p & q, [side < -slack for side, slack in sides])
    return near & ~left & ~right


def _turn(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def numbered_edges(geom: Column) -> Column:
    """Edges of a multi-polygon that have a length, each with what tells where it stands.

    ``poly`` and ``ring`` count from 0 (ring 0 is the shell), ``i`` is the place in a ring of ``n`` such edges, ``g`` the
    place among all; then come the ends and the box.
    """

    def ends(p: Column, q: Column) -> Column:
        return F.struct(p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2"))

    def of_ring(ring: Column, poly: Column, number: Column) -> Column:
        solid = F.filter(_edge_terms(ring, ends), lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))
        return _let(solid, lambda es: F.transform(es, lambda e, i: F.struct(
            poly.alias("poly"), number.alias("ring"), i.alias("i"), F.size(es).alias("n"), e.alias("e"),
        )))

    flat = F.flatten(F.transform(geom, lambda rings, poly: F.flatten(F.transform(rings, lambda ring, r: of_ring(ring, poly, r)))))

    def boxed(x: Column, g: Column) -> Column:
        e = x["e"]
        return F.struct(
            g.alias("g"), *[x[c].alias(c) for c in ("poly", "ring", "i", "n")], *[e[c].alias(c) for c in ("x1", "y1", "x2", "y2")],
            F.least(e["x1"], e["x2"]).alias("lx"), F.greatest(e["x1"], e["x2"]).alias("hx"),
            F.least(e["y1"], e["y2"]).alias("ly"), F.greatest(e["y1"], e["y2"]).alias("hy"),
        )

    return F.transform(flat, boxed)


def edge_count(geom: Column, depth: int = 3) -> Column:
    """Points of all rings: no fewer than there are edges."""
    rings = F.flatten(geom) if depth == 3 else geom
    return F.aggregate(rings, F.lit(0), lambda n, r: n + F.size(r))


def boxes_meet(e: Callable[[str], Column], f: Callable[[str], Column]) -> Column:
    return (e("lx") <= f("hx")) & (f("lx") <= e("hx")) & (e("ly") <= f("hy")) & (f("ly") <= e("hy"))


def edges_clash(e: Callable[[str], Column], f: Callable[[str], Column], touch_counts: bool = True) -> Column:
    """Whether two edges of one shape, ``e`` before ``f``, make it invalid; fields are looked up by name.

    Edges may not cross inside, nor run along each other; edges of one ring that are not neighbours may not even touch.
    Without ``touch_counts`` it is whether edges of different rings touch.
    """
    turn = [
        F.signum((b - ax) * (y - ay) - (c - ay) * (x - ax))
        for ax, ay, b, c, ends in ((e("x1"), e("y1"), e("x2"), e("y2"), f), (f("x1"), f("y1"), f("x2"), f("y2"), e))
        for x, y in ((ends("x1"), ends("y1")), (ends("x2"), ends("y2")))
    ]
    crossing = (turn[0] * turn[1] < 0) & (turn[2] * turn[3] < 0)
    shared_x = F.least(e("hx"), f("hx")) - F.greatest(e("lx"), f("lx"))
    shared_y = F.least(e("hy"), f("hy")) - F.greatest(e("ly"), f("ly"))
    along = (turn[0] == 0) & (turn[1] == 0) & ((shared_x > 0) | (shared_y > 0))

    def on(side: Column, box: Callable[[str], Column], x: Column, y: Column) -> Column:
        return (side == 0) & (x >= box("lx")) & (x <= box("hx")) & (y >= box("ly")) & (y <= box("hy"))

    touching = (
        on(turn[0], e, f("x1"), f("y1")) | on(turn[1], e, f("x2"), f("y2")) | on(turn[2], f, e("x1"), e("y1")) | on(turn[3], f, e("x2"), e("y2"))
    )
    neighbours = (f("i") == e("i") + 1) | ((e("i") == 0) & (f("i") == e("n") - 1))
    same_ring = (e("poly") == f("poly")) & (e("ring") == f("ring"))
    return crossing | along | (same_ring & ~neighbours & touching) if touch_counts else ~same_ring & touching


def crosses_ray(x1: Column, y1: Column, x2: Column, y2: Column, x: Column, y: Column) -> Column:
    """Whether an edge crosses the ray that leaves a point to the right; false for a level edge."""
    at = (x2 - x1) * (y - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1
    return F.coalesce(((y1 > y) != (y2 > y)) & (x < at), F.lit(False))


def marks(e: Callable[[str], Column]) -> list[tuple[Column, Column]]:
    """The points of an edge whose place among other rings is looked at: where it begins, and its middle."""
    return [(e("x1"), e("y1")), ((e("x1") + e("x2")) / 2, (e("y1") + e("y2")) / 2)]


def _misplaced(edge_array: Column) -> Column:
    """A hole that is not inside its shell or is inside another hole, or a shell inside another polygon.

    Of a hole's points, rays cross the other rings of the polygon an odd number of times; of a shell's points, they cross
    other polygons an even number of times. Points on those rings say nothing.
    """

    def stray(e: Column) -> Column:
        def against(f: Column) -> Column:
            inner = (f["poly"] == e["poly"]) & (f["ring"] != e["ring"])
            return F.when(e["ring"] > 0, inner).otherwise(f["poly"] != e["poly"])

        def odd_one(others: Column) -> Column:
            verdict = F.lit(False)
            for x, y in marks(e.getItem):
                crossed = F.size(F.filter(others, lambda f: crosses_ray(f["x1"], f["y1"], f["x2"], f["y2"], x, y))) % 2 == 1
                verdict = verdict | ((crossed != (e["ring"] > 0)) & ~F.exists(others, lambda f: on_edge(f, x, y)))
            return verdict

        return _let(F.filter(edge_array, against), odd_one)

    several = F.exists(edge_array, lambda e: (e["ring"] > 0) | (e["poly"] > 0))
    return several & F.exists(edge_array, stray)


def _finite(p: Column) -> Column:
    def ok(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))

    return ok(p["x"]) & ok(p["y"])


def ring_is_valid(ring: Column) -> Column:
    def closed(first: Column) -> Column:
        last = F.element_at(ring, -1)
        return (first["x"] == last["x"]) & (first["y"] == last["y"]) & (_ring_sums(ring, first)["a"] != 0)

    return (F.size(ring) >= 4) & F.forall(ring, _finite) & _let(F.get(ring, 0), closed)


def rings_are_valid(geom: Column, depth: int = 3) -> Column:
    """Every polygon has rings, and they are closed, of four points at least, finite and with area."""
    multi_geom = geom if depth == 3 else F.array(geom)
    return F.coalesce(
        (F.size(multi_geom) > 0) & F.forall(multi_geom, lambda poly: (F.size(poly) > 0) & F.forall(poly, ring_is_valid)), F.lit(False)
    )


def polygon_is_valid(geom: Column, depth: int = 3) -> Column:
    """Proper rings that neither cross, run along each other nor touch themselves, holes inside their shell and apart,
    polygons apart from each other.

    Narrower than a full OGC check in one point: two rings that touch in several places, and so cut the interior in two,
    are not found. Every pair of edges is looked at; `operators.geometry.flag_valid` is for shapes of many edges.
    """
    multi_geom = geom if depth == 3 else F.array(geom)

    def clash(all_edges: Column) -> Column:
        pairs = F.exists(
            all_edges,
            lambda e: F.exists(all_edges, lambda f: (f["g"] > e["g"]) & boxes_meet(e.getItem, f.getItem) & edges_clash(e.getItem, f.getItem)),
        )
        return pairs | _misplaced(all_edges)

    return F.when(rings_are_valid(multi_geom), ~_let(numbered_edges(multi_geom), clash)).otherwise(False)


def lines_are_valid(geom: Column) -> Column:
    """Every line has two points at least and finite coordinates."""
    return F.coalesce(
        (F.size(geom) > 0) & F.forall(geom, lambda line: (F.size(line) >= 2) & F.forall(line, _finite)), F.lit(False)
    )


def point_is_valid(geom: Column) -> Column:
    return F.coalesce(geom.isNotNull() & _finite(geom), F.lit(False))
