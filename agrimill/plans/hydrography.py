"""Water items, buildings and area items of all zones and departments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from agrimill.functions import geometry as geo, labels, text
from agrimill.operators import geometry as ops, keyed
from agrimill.operators.reshape import union_families
from agrimill.specs import LABEL, MULTILINE, MULTIPOLYGON, POINT, TableSpec

_ITEM = f"id string, name {LABEL}, nature string, point {POINT}, shape {MULTIPOLYGON}, lines {MULTILINE}, centroid {POINT}"
BUILDINGS = TableSpec(
    "hydrography", "registered_cadastral_buildings",
    f"id bigint, reference_name string, nature string, shape {MULTIPOLYGON}, centroid {POINT}",
    pk=("id",), not_null=("shape",),
)
AREA_ITEMS = TableSpec("hydrography", "registered_area_items", _ITEM, pk=("id",))
WATER_ITEMS = TableSpec("hydrography", "registered_hydrographic_items", _ITEM, pk=("id",))
SPECS = [BUILDINGS, AREA_ITEMS, WATER_ITEMS]

# Depth of the multi geometry of each kind: points, lines, polygons.
DEPTH = {"point": 1, "lines": 2, "shape": 3}


def _layer(df: DataFrame, kind: str, rank: int, name: Column, nature: Column, all_parts: bool) -> DataFrame:
    """Parts of one layer in WGS 84; an item keeps its first part unless ``all_parts``.

    Parts of an item share its id, so a table keyed by id can hold only one; the
    first is cut out of the array before anything is shuffled.
    """
    depth = DEPTH[kind]
    flat = geo.reproject(geo.force2d(F.col("geom"), depth), depth, F.col("srid"))
    item = text.join_skip_null("id", F.lit("_fra_"), "department")
    rows = df.select(
        (F.lit(rank)).alias("_rank"), item.alias("id"), labels.label_or_null(name).alias("name"), nature.alias("nature"), flat.alias(kind)
    )
    if all_parts:
        rows = ops.dump(rows, kind, part="_part").withColumn("id", F.concat("id", F.lit("_"), F.col("_part").cast("string")))
        rows = rows.drop("_part")
    else:
        rows = rows.withColumn(kind, F.get(F.col(kind), 0)).filter(F.col(kind).isNotNull())
    return rows if kind == "point" else rows.withColumn(kind, geo.multi(F.col(kind)))


def _items(layers: list[DataFrame], spec: TableSpec) -> DataFrame:
    every = union_families(layers)
    one = keyed.first_wins(every, ["id"], ["_rank"]).drop("_rank")
    return spec.align(ops.item_centroid(one))


def water_items(layers: Mapping[str, DataFrame], all_parts: bool = False) -> DataFrame:
    """Springs and wells, water surfaces, watercourses: in that order the first of an id wins.

    Layers have id, nature, geom, department, srid and a name: ``detail``
    (toponyme), ``surface`` (nom_p_eau), ``course`` (nom_c_eau).
    """
    nature = F.col("nature")
    return _items(
        [
            _layer(layers["detail"], "point", 0, F.col("toponyme"), nature, all_parts),
            _layer(layers["surface"], "shape", 1, F.col("nom_p_eau"), nature, all_parts),
            _layer(layers["course"], "lines", 2, F.col("nom_c_eau"), nature, all_parts),
        ],
        WATER_ITEMS,
    )


def area_items(layers: Mapping[str, DataFrame], all_parts: bool = False) -> DataFrame:
    """Hedges, green zones and pylons, for metropolitan departments (``D0…``) only."""
    metro = {k: df.filter(F.startswith("department", F.lit("D0"))) for k, df in layers.items()}
    return _items(
        [
            _layer(metro["hedge"], "lines", 0, F.lit("haie"), F.lit("edge"), all_parts),
            _layer(metro["green_zone"], "shape", 1, F.col("nature"), F.lit("green_zone"), all_parts),
            _layer(metro["pylon"], "point", 2, F.lit("pylone"), F.lit("electric_pole"), all_parts),
        ],
        AREA_ITEMS,
    )


def buildings(raw: DataFrame) -> DataFrame:
    """Building parts with an id each; shapes without a valid centroid are dropped."""
    flat = raw.select(
        F.col("id").alias("reference_name"), F.col("usage1").alias("nature"),
        geo.reproject(geo.force2d(F.col("geom"), 3), 3, F.col("srid")).alias("shape"),
    )
    parts = ops.dump(flat, "shape").withColumn("shape", geo.multi(F.col("shape")))
    kept = ops.with_centroid(parts, "shape").filter(F.col("centroid").isNotNull())
    return BUILDINGS.align(keyed.surrogate_hash(kept, "id", ["reference_name", "nature", "part", "shape"]).drop("part"))
