"""Spatial operators on DataFrames."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from agrimill.functions import geometry as geo
from agrimill.operators.joins import salted_join
from agrimill.operators.keyed import first_wins, spare_name
from agrimill.session import stored

# Cell sizes grow by this factor from one level to the next, up to the whole globe.
LEVEL_FACTOR = 4.0
GLOBE_DEGREES = 360.0
# Shapes of more points are taken apart to be validated; their strips are so many times as high as the mean edge.
ROW_EDGES, STRIP_EDGES = 64, 8
# Cells of bundled points get smaller, down to so many levels below the base cell, until they hold so many different points on average.
BUNDLE_POINTS, FINER_LEVELS = 4, 12


def dump(df: DataFrame, col: str, part: str = "part") -> DataFrame:
    """One row per part of a multi geometry, with the part index kept.

    The outer form plus a test on its result: the inner form would make the
    optimizer compute the geometry once more, only to test its size.
    """
    parts = df.select(*[c for c in df.columns if c != col], F.posexplode_outer(col).alias(part, col))
    return parts.filter(F.col(part).isNotNull())


def with_centroid(df: DataFrame, shape: str, name: str = "centroid", only_valid: bool = True) -> DataFrame:
    """Adds the centroid of a multi-polygon column, NULL where the shape is invalid."""
    value = geo.centroid_multipolygon(F.col(shape))
    if not only_valid:
        return df.withColumn(name, value)
    ok = spare_name(df, "_valid")
    return flag_valid(df, shape, ok).withColumn(name, F.when(F.col(ok), value)).drop(ok)


def item_centroid(
    df: DataFrame, point: str = "point", lines: str = "lines", shape: str = "shape", name: str = "centroid"
) -> DataFrame:
    """Centroid with the precedence point, lines, shape; rows left without one are dropped."""
    value = F.coalesce(
        F.when(geo.point_is_valid(F.col(point)), F.col(point)),
        F.when(geo.lines_are_valid(F.col(lines)), geo.centroid_multiline(F.col(lines))),
        F.when(geo.polygon_is_valid(F.col(shape)), geo.centroid_multipolygon(F.col(shape))),
    )
    return df.withColumn(name, value).filter(F.col(name).isNotNull())


def flag_valid(df: DataFrame, shape: str, name: str = "valid", depth: int = 3, row_edges: int | None = ROW_EDGES) -> DataFrame:
    """Adds the validity of a shape as a column; the rules are those of `geo.polygon_is_valid`.

    Shapes of at most ``row_edges`` points are looked at within their row. Larger ones are taken apart: their edges meet
    in grid cells, by an equi-join, and only their verdicts, by a hash of the shape, come back. With ``row_edges`` None no
    shape is taken apart. One job looks first whether there are large shapes at all; only then is the input read twice.
    """
    if row_edges is None:
        return df.withColumn(name, geo.polygon_is_valid(F.col(shape), depth))
    large = F.coalesce(geo.edge_count(F.col(shape), depth) > row_edges, F.lit(False))
    if df.where(large).select(F.lit(1)).isEmpty():
        return df.withColumn(name, geo.polygon_is_valid(F.col(shape), depth))
    keys = [spare_name(df, "_ha"), spare_name(df, "_hb")]
    small = df.where(~large).withColumn(name, geo.polygon_is_valid(F.col(shape), depth))
    hashed = df.where(large).withColumns({keys[0]: F.xxhash64(shape), keys[1]: F.xxhash64(F.lit(7), shape)})
    bad = invalid_shapes(hashed.select(F.col(keys[0]).alias("ha"), F.col(keys[1]).alias("hb"), (F.col(shape) if depth == 3 else F.array(shape)).alias("shape")))
    bad = bad.select(F.col("ha").alias(keys[0]), F.col("hb").alias(keys[1]), F.lit(False).alias(name))
    judged = hashed.drop(name).join(bad, keys, "left").withColumn(name, F.coalesce(name, F.lit(True)))
    return small.unionByName(judged.select(*small.columns))


def invalid_shapes(shapes: DataFrame) -> DataFrame:
    """The keys (ha, hb) of those multi-polygons (column ``shape``) that are invalid.

    Edges are filed in the cells they pass, which are half as wide as a shape's mean edge; edges of a cell are compared.
    Where rings stand is told by rays along level strips from few points: as rings do not cross, one of each ring, and the
    middles of edges that touch another ring. Equal shapes are looked at once. A shape of very many edges is spread over as
    many tasks as its cells hash to. What meets in a cell grows with the square of the edges there: shapes of many long
    edges side by side (20,000 spikes on a disc) take minutes where others of that size take seconds.
    """
    one = shapes.dropDuplicates(["ha", "hb"])
    proper = geo.rings_are_valid(F.col("shape"))
    broken = one.where(~proper).select("ha", "hb")
    edges = one.where(proper).select("ha", "hb", geo.numbered_edges(F.col("shape")).alias("_all"))

    def over(start, merge):
        return F.aggregate("_all", F.lit(start), merge)

    edges = edges.select(
        "ha", "hb",
        (over(0.0, lambda t, e: t + F.greatest(e["hx"] - e["lx"], e["hy"] - e["ly"])) / F.size("_all") / 2).alias("side"),
        (over(0.0, lambda t, e: t + e["hy"] - e["ly"]) / F.size("_all") * STRIP_EDGES).alias("height"),
        over(math.inf, lambda t, e: F.least(t, e["ly"])).alias("miny"),
        F.exists("_all", lambda e: (e["ring"] > 0) | (e["poly"] > 0)).alias("several"),
        "_all",
    )
    # Not in one step: beside a generator, other expressions are evaluated for every row it makes.
    edges = stored(edges.select("ha", "hb", "side", "height", "miny", "several", F.explode("_all").alias("e")).select("*", "e.*").drop("e"), "edges")
    meeting = stored(_meeting(edges), "meeting")
    clashing = meeting.where("clash").select("ha", "hb")
    return broken.union(clashing).union(_misplaced(edges, meeting.where("not clash"))).distinct()


def _meeting(edges: DataFrame) -> DataFrame:
    """Pairs of edges that clash, or that touch though they are of different rings: ha, hb, clash, and their places g and h."""
    side, slope = F.col("side"), (F.col("y2") - F.col("y1")) / F.nullif(F.col("x2") - F.col("x1"), F.lit(0.0))

    def column_cells(cx: Column) -> Column:
        """Cells of one grid column: the stretch of the edge over it, a little widened against rounding."""
        ends = [F.col("y1") + (x - F.col("x1")) * slope for x in (F.greatest(F.col("lx"), cx * side), F.least(F.col("hx"), (cx + 1) * side))]
        slack = side * 1e-9 + F.abs(F.col("y1")) * 1e-12
        low = F.greatest(F.col("ly"), F.coalesce(F.least(*ends), F.col("ly"))) - slack
        high = F.least(F.col("hy"), F.coalesce(F.greatest(*ends), F.col("hy"))) + slack
        return F.transform(F.sequence(F.floor(low / side), F.floor(high / side)), lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))

    cells = F.flatten(F.transform(F.sequence(F.floor(F.col("lx") / side), F.floor(F.col("hx") / side)), column_cells))
    fields = ["g", "poly", "ring", "i", "n", "x1", "y1", "x2", "y2", "lx", "hx", "ly", "hy"]
    filed = edges.select("ha", "hb", F.explode(cells).alias("cell"), *fields).select("ha", "hb", "cell.cx", "cell.cy", *fields)
    other = filed.select("ha", "hb", "cx", "cy", *[F.col(c).alias(f"{c}_") for c in fields])
    e, f = F.col, lambda c: F.col(f"{c}_")
    met = filed.join(other, ["ha", "hb", "cx", "cy"]).where((f("g") > e("g")) & geo.boxes_meet(e, f))
    clash = geo.edges_clash(e, f)
    return met.where(clash | geo.edges_clash(e, f, touch_counts=False)).select("ha", "hb", "g", F.col("g_").alias("h"), clash.alias("clash")).distinct()


def _misplaced(edges: DataFrame, touching: DataFrame) -> DataFrame:
    """Keys of shapes with a ring where none may be, by rays of some of its points along the strip each lies in."""
    several = edges.where("several")

    def strip(y: Column) -> Column:
        return F.floor((y - F.col("miny")) / F.nullif(F.col("height"), F.lit(0.0)))

    touched = touching.select("ha", "hb", F.explode(F.array("g", "h")).alias("g")).distinct()
    chosen = several.where("i = 0").unionByName(several.join(touched, ["ha", "hb", "g"])).distinct()
    points = F.explode(F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in geo.marks(F.col)]))
    points = chosen.select("ha", "hb", F.col("poly").alias("p"), F.col("ring").alias("r"), "miny", "height", points.alias("at"))
    points = points.select("ha", "hb", "p", "r", "at.x", "at.y", strip(F.col("at.y")).alias("strip")).distinct()
    lines = several.select("ha", "hb", "poly", "ring", "x1", "y1", "x2", "y2", F.explode(F.sequence(strip(F.col("ly")), strip(F.col("hy")))).alias("strip"))
    against = F.when(F.col("r") > 0, (F.col("poly") == F.col("p")) & (F.col("ring") != F.col("r"))).otherwise(F.col("poly") != F.col("p"))
    ends = [F.col(c) for c in ("x1", "y1", "x2", "y2")]
    crossed = F.coalesce(against & geo.crosses_ray(*ends, F.col("x"), F.col("y")), F.lit(False))
    on = F.coalesce(against & geo.on_edge(dict(zip(("x1", "y1", "x2", "y2"), ends)), F.col("x"), F.col("y")), F.lit(False))
    seen = points.join(lines, ["ha", "hb", "strip"], "left").groupBy("ha", "hb", "p", "r", "x", "y").agg(F.sum(crossed.cast("int")).alias("n"), F.max(on).alias("on"))
    return seen.where(~F.col("on") & ((F.col("n") % 2 == 1) != (F.col("r") > 0))).select("ha", "hb").distinct()


def split_valid(df: DataFrame, shape: str, depth: int = 3) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows); each is a plan of its own over the same input."""
    name = spare_name(df, "_valid")
    flagged = flag_valid(df, shape, name, depth)
    return flagged.filter(F.col(name)).drop(name), flagged.filter(~F.col(name)).drop(name)


def attach_shape(df: DataFrame, shapes: DataFrame, code: str, shape_code: str, geom: str, srid: int) -> DataFrame:
    """Commune shape and centroid onto rows by code; rows without a shape keep NULL.

    Of several shapes of one code the one with the smallest hash is taken, so no row is doubled.
    """
    one = first_wins(shapes.select(shape_code, geom), [shape_code], [F.xxhash64(geom)])
    found = one.select(
        F.col(shape_code).alias(code), geo.reproject(F.col(geom), 3, srid).alias("city_shape")
    ).withColumn("city_centroid", geo.centroid_multipolygon(F.col("city_shape")))
    return df.join(found, code, "left")


def _levels(base: float) -> int:
    """Number of cell sizes from the base cell up to one that spans the globe."""
    n, size = 1, base
    while size < GLOBE_DEGREES:
        n, size = n + 1, size * LEVEL_FACTOR
    return n


def _cell_key(x: Column, y: Column, level: Column, base: float) -> Column:
    size = F.lit(base) * F.pow(F.lit(LEVEL_FACTOR), level)
    return F.struct(
        level.cast("int").alias("level"), F.floor(x / size).alias("cx"), F.floor(y / size).alias("cy")
    )


def point_in_polygon_join(
    points: DataFrame,
    polygons: DataFrame,
    point: str,
    shape: str,
    *,
    depth: int = 3,
    cell: float = 0.02,
    levels: Sequence[int] | None = None,
    hot_rows: int | None = None,
    salts: int = 32,
    totals: Sequence[Column] | None = None,
) -> DataFrame:
    """Points joined to the polygons that cover them, boundary included.

    Each polygon is filed under the grid level whose cell is no smaller than its
    box, so it lies in four cells at most however large it is. A point is looked
    up in its one cell of each level that polygons use, which one job finds out
    first. That makes the join an equi-join on the cell, with the box as an extra
    condition. Polygons of few points are tested there and then. For larger ones,
    points in the box go on to an index of edges: a shape's edges are filed by
    level strips, and a point meets only those of its own strip, by a second
    equi-join, which also spreads a polygon that most points fall into. Hot cells
    are split by adaptive execution, or, with ``hot_rows`` set, by salting the
    cells that hold more points than that.

    ``levels`` lists the grid levels to use, any of about eight by default. Fewer
    levels mean fewer look-ups per point; a polygon then goes to the next larger
    level listed, or to several cells of the largest one, so the result is the same.

    With ``totals``, aggregates of points that are named, there are rows for bundles
    of points instead: columns of the polygon but its shape, and the totals of a
    bundle it covers. A covered point is in one bundle of its polygon, so totals of
    totals are those of all points. See ``_bundles_in_polygons``.
    """
    all_levels = list(range(_levels(cell))) if levels is None else sorted(levels)
    # NaN instead of NULL: nothing compares with it, and the join infers no null
    # filters that would compute costly geometry a second time further down.
    nan = F.lit(float("nan"))
    bounds = ("minx", "miny", "maxx", "maxy")
    box = F.transform(
        F.array(geo.bbox(F.col(shape), depth)), lambda b: F.struct(*[F.coalesce(b[n], nan).alias(n) for n in bounds])
    )[0]
    extent = F.greatest(F.col("_box.maxx") - F.col("_box.minx"), F.col("_box.maxy") - F.col("_box.miny"))
    level = F.greatest(
        F.lit(0), F.ceil(F.log(F.greatest(extent, F.lit(1e-12)) / cell) / F.log(F.lit(LEVEL_FACTOR)) - 1e-9)
    )
    level = F.coalesce(*[F.when(level <= n, F.lit(n)) for n in all_levels], F.lit(all_levels[-1]))
    size = F.lit(cell) * F.pow(F.lit(LEVEL_FACTOR), F.col("_level"))

    def span(low: str, high: str) -> Column:
        return F.sequence(F.floor(F.col(low) / size), F.floor(F.col(high) / size))

    large = F.coalesce(geo.edge_count(F.col(shape), depth) > ROW_EDGES, F.lit(False))
    boxed = polygons.withColumn("_box", box).withColumn("_level", level.cast("int")).withColumn("_large", large)
    used = boxed.select("_large", "_level").distinct().collect()  # two rows for each level at most
    px, py = F.coalesce(F.col(f"{point}.x"), nan), F.coalesce(F.col(f"{point}.y"), nan)
    looked_up = points.withColumn("_px", px).withColumn("_py", py)
    if totals is not None:
        placed = looked_up.where(~F.isnan("_px") & ~F.isnan("_py"))
        small = boxed.where("not _large").withColumn("_edges", geo.edges(F.col(shape), depth)).drop("_large", shape)
        few = _bundles_in_polygons(placed, small, [r["_level"] for r in used if not r["_large"]], all_levels, cell, totals, hot_rows, salts)
        if not any(r["_large"] for r in used):
            return few
        same = placed.groupBy(F.struct(F.col("_px").alias("x"), F.col("_py").alias("y")).alias("_point")).agg(*totals)
        many = point_in_polygon_join(
            same, boxed.where("_large").select(*polygons.columns), "_point", shape, depth=depth, cell=cell, levels=levels, hot_rows=hot_rows, salts=salts
        )
        return few.unionByName(many.drop("_point", shape))
    in_box = (
        (F.col("_px") >= F.col("_box.minx")) & (F.col("_px") <= F.col("_box.maxx"))
        & (F.col("_py") >= F.col("_box.miny")) & (F.col("_py") <= F.col("_box.maxy"))
    )

    def met(kind: DataFrame, at: list[int], extra: Column) -> DataFrame:
        """Points with the polygons that share a cell of the levels given."""
        filed = (
            kind.withColumn("_cx", F.explode_outer(span("_box.minx", "_box.maxx")))
            .withColumn("_cy", F.explode_outer(span("_box.miny", "_box.maxy")))
            .withColumn("_cell", F.struct(F.col("_level").alias("level"), F.col("_cx").alias("cx"), F.col("_cy").alias("cy")))
            .drop("_level", "_cx", "_cy", "_large")
        )
        cells = F.array(*[_cell_key(F.col("_px"), F.col("_py"), F.lit(n), cell) for n in at])
        return salted_join(looked_up.withColumn("_cell", F.explode(cells)), filed, ["_cell"], "inner", hot_rows=hot_rows, salts=salts, extra=in_box & extra)

    helpers = ["_box", "_edges", "_cell", "_px", "_py"]
    edges = geo.edges(F.col(shape), depth)
    levels_of = {kind: sorted(r["_level"] for r in used if r["_large"] == kind) for kind in (False, True)}
    covered = geo.covers(F.col("_edges"), F.col("_px"), F.col("_py"))
    few = met(boxed.where("not _large").withColumn("_edges", edges), levels_of[False] or all_levels[:1], covered).drop(*helpers)
    if not levels_of[True]:
        return few
    keyed = boxed.where("_large").withColumns({"_ha": F.xxhash64(shape), "_hb": F.xxhash64(F.lit(7), shape)}).withColumn("_height", _strip_height(edges))
    height, strip = F.col("_height"), lambda y: F.coalesce(F.floor((y - F.col("_box.miny")) / F.nullif(height, F.lit(0.0))), F.lit(0))
    index = keyed.dropDuplicates(["_ha", "_hb"]).select("_ha", "_hb", "_box", "_height", F.explode(edges).alias("e"))
    index = index.select("_ha", "_hb", "e", F.explode(F.sequence(strip(F.least("e.y1", "e.y2")), strip(F.greatest("e.y1", "e.y2")))).alias("_strip"))
    index = index.groupBy("_ha", "_hb", "_strip").agg(F.collect_list("e").alias("_edges"))
    candidates = met(keyed, levels_of[True], F.lit(True)).withColumn("_strip", strip(F.col("_py")))
    many = candidates.join(index, ["_ha", "_hb", "_strip"]).where(covered).drop(*helpers, "_ha", "_hb", "_strip", "_height")
    return many if not levels_of[False] else few.unionByName(many)


def _bundles_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    filed: Sequence[int],
    all_levels: Sequence[int],
    cell: float,
    totals: Sequence[Column],
    hot_rows: int | None,
    salts: int,
) -> DataFrame:
    """Polygons with the totals of the bundles of points that they cover.

    A bundle is what lies in one grid cell, with the box of its points. Polygons meet the bundles of their level by an
    equi-join on the cell. A bundle whose box no edge meets is covered as a whole or not at all. One that an edge meets is
    looked at again by its smaller cells, and what is left of the smallest cells by its points. So a polygon meets bundles
    along its outline, not all points inside. One job finds how small cells have to be for few different points in each.

    ``points``: _px, _py and what totals are made of; ``polygons``: _box, _level, _edges and what is kept.
    """
    kept = [c for c in polygons.columns if c not in ("_box", "_level", "_edges")]

    def grid(x: Column, n: int) -> Column:
        return F.floor(x / F.lit(cell * LEVEL_FACTOR**n))

    def cells(n: int) -> list[Column]:
        return [grid(F.col("_px"), n).alias("_cx"), grid(F.col("_py"), n).alias("_cy")]

    usable = [*all_levels[::-1], *range(all_levels[0] - 1, all_levels[0] - 1 - FINER_LEVELS, -1)]
    different = points.agg(F.approx_count_distinct(F.xxhash64("_px", "_py")), *[F.approx_count_distinct(F.xxhash64(*cells(n))) for n in usable]).first()
    finest = next((n for n, filled in zip(usable, different[1:]) if different[0] <= BUNDLE_POINTS * filled), usable[-1])
    top = max([finest, *filed])
    # Measured once: every level reads the stored ones.
    polygons = stored(polygons.withColumn("_level", F.greatest("_level", F.lit(finest))), "polygons")
    begun = {max(n, finest) for n in filed}

    box = ("minx", "miny", "maxx", "maxy")
    ends = {"minx": F.min("_px"), "miny": F.min("_py"), "maxx": F.max("_px"), "maxy": F.max("_py")}
    low_x, low_y, high_x, high_y = (F.col(f"_{c}") for c in box)
    meet = (low_x <= F.col("_box.maxx")) & (high_x >= F.col("_box.minx")) & (low_y <= F.col("_box.maxy")) & (high_y >= F.col("_box.miny"))
    one = (low_x == high_x) & (low_y == high_y)
    cut = ~one & F.coalesce(F.exists("_edges", lambda e: geo.edge_meets_box(e, low_x, low_y, high_x, high_y)), F.lit(True))
    shared = F.struct(
        F.greatest("_box.minx", low_x).alias("minx"), F.greatest("_box.miny", low_y).alias("miny"),
        F.least("_box.maxx", high_x).alias("maxx"), F.least("_box.maxy", high_y).alias("maxy"),
    )
    covered, waiting = [], None
    for n in [n for n in usable if finest <= n <= top]:
        if n in begun:
            new = polygons.where(F.col("_level") == n).select(*kept, "_edges", "_box")
            waiting = new if waiting is None else waiting.drop("_cx", "_cy").unionByName(new)
        if waiting is None:
            continue
        met = waiting.select(*kept, "_edges", "_box", F.explode(F.sequence(grid(F.col("_box.minx"), n), grid(F.col("_box.maxx"), n))).alias("_cx"))
        met = met.select("*", F.explode(F.sequence(grid(F.col("_box.miny"), n), grid(F.col("_box.maxy"), n))).alias("_cy"))
        bundles = points.groupBy(*cells(n)).agg(*[ends[c].alias(f"_{c}") for c in box], *totals)
        met = salted_join(met, bundles, ["_cx", "_cy"], "inner", hot_rows=hot_rows, salts=salts, extra=meet).withColumn("_cut", cut)
        met = met.where(F.col("_cut") | geo.covers(F.col("_edges"), low_x, low_y)).withColumn("_box", shared).drop(*[f"_{c}" for c in box])
        met = stored(met.withColumn("_edges", F.when(F.col("_cut"), F.col("_edges"))), "bundles")
        names = [c for c in met.columns if c not in (*kept, "_edges", "_box", "_cx", "_cy", "_cut")]
        covered.append(met.where("not _cut").select(*kept, *names))
        waiting = met.where("_cut").select(*kept, "_edges", "_box", "_cx", "_cy")
    if waiting is None:  # there are no polygons
        waiting = polygons.select(*kept, "_edges", "_box", F.lit(0).cast("long").alias("_cx"), F.lit(0).cast("long").alias("_cy"))
    single = points.groupBy("_px", "_py").agg(*totals).select("*", *cells(finest))
    in_box = F.col("_px").between(F.col("_box.minx"), F.col("_box.maxx")) & F.col("_py").between(F.col("_box.miny"), F.col("_box.maxy"))
    last = salted_join(waiting, single, ["_cx", "_cy"], "inner", hot_rows=hot_rows, salts=salts, extra=in_box & geo.covers(F.col("_edges"), F.col("_px"), F.col("_py")))
    return reduce(DataFrame.unionByName, [*covered, last.drop("_edges", "_box", "_cx", "_cy", "_px", "_py")])


def _strip_height(edges: Column) -> Column:
    """Height of the strips that a shape's edges are filed by: some times the mean height of its edges."""
    total = F.aggregate(edges, F.lit(0.0), lambda t, e: t + F.abs(e["y2"] - e["y1"]))
    return total / F.nullif(F.size(edges), F.lit(0)) * STRIP_EDGES


def within_any(df: DataFrame, geom: str, circles: Sequence[tuple[float, float, float]]) -> DataFrame:
    """Rows whose point lies within one of the fixed circles ``(x, y, distance)``."""
    x, y = F.col(f"{geom}.x"), F.col(f"{geom}.y")
    return df.filter(reduce(lambda a, b: a | b, [geo.within(x, y, *c) for c in circles]))
