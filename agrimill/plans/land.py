"""Land registry, farm parcels, protected zones, soil, postal codes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from agrimill.functions import dates, geometry as geo, lookups, text
from agrimill.operators import geometry as ops, keyed
from agrimill.operators.reshape import union_families
from agrimill.session import stored
from agrimill.specs import MULTIPOLYGON, POINT, POLYGON, TableSpec

SALES = TableSpec(
    "cadastral_prices", "registered_cadastral_prices",
    "id bigint, mutation_id string, mutation_date date, mutation_reference string, mutation_nature string, "
    "cadastral_price decimal(14,2), cadastral_parcel_id string, building_nature string, building_area int, "
    f"cadastral_parcel_area int, address string, postal_code string, city string, department string, centroid {POINT}",
    pk=("id",),
)
PARCELS = TableSpec(
    "cadastre", "registered_cadastral_parcels",
    "id string, town_insee_code string, section_prefix string, section string, work_number string, "
    f"net_surface_area int, shape {MULTIPOLYGON}, centroid {POINT}",
    pk=("id",), not_null=("shape",),
)
FARM_PARCELS = TableSpec(
    "graphic_parcels", "registered_graphic_parcels",
    f"id string, cap_crop_code string, city_name string, shape {POLYGON}, centroid {POINT}",
    not_null=("id", "shape"),
)
POSTAL_CODES = TableSpec(
    "postal_codes", "registered_postal_codes",
    "id string, country string, code string, city_name string, postal_code string, city_delivery_name string, "
    f"city_delivery_detail string, city_centroid {POINT}, city_shape {MULTIPOLYGON}",
    pk=("id",), not_null=("country", "code", "city_name", "postal_code"),
)
NATURAL_ZONES = TableSpec(
    "protected_natural_zones", "registered_natural_zones",
    f"id string, name string, nature string, shape {MULTIPOLYGON}, centroid {POINT}",
    not_null=("id", "nature", "shape"),
)
WATER_ZONES = TableSpec(
    "protected_water_zones", "registered_protected_water_zones",
    "id string, administrative_zone string, creator_name string, name string, updated_on date, "
    f"shape {MULTIPOLYGON}, centroid {POINT}",
    not_null=("id", "shape"),
)
SOIL_DEPTHS = TableSpec(
    "soil", "registered_soil_depths",
    f"id string, soil_depth_value decimal(19,4), soil_depth_unit string, shape {MULTIPOLYGON}, centroid {POINT}",
    pk=("id",), not_null=("shape",),
)
SOIL_WATER = TableSpec(
    "soil", "registered_soil_available_water_capacities",
    "id string, available_water_reference_value int, available_water_min_value decimal(19,4), "
    "available_water_max_value decimal(19,4), available_water_unit string, available_water_label string, "
    f"shape {MULTIPOLYGON}, centroid {POINT}",
    pk=("id",), not_null=("shape",),
)
SPECS = [SALES, PARCELS, FARM_PARCELS, POSTAL_CODES, NATURAL_ZONES, WATER_ZONES, SOIL_DEPTHS, SOIL_WATER]


def sales(raw: DataFrame) -> DataFrame:
    """Land sales of all years read together.

    Ids are unique within one load and fixed once the table is written. The
    location is (longitude, latitude).
    """
    c = F.col
    out = raw.select(
        F.monotonically_increasing_id().alias("id"),
        c("id_mutation").alias("mutation_id"), c("date_mutation").cast("date").alias("mutation_date"),
        c("numero_disposition").alias("mutation_reference"), c("nature_mutation").alias("mutation_nature"),
        c("valeur_fonciere").cast("decimal(14,2)").alias("cadastral_price"), c("id_parcelle").alias("cadastral_parcel_id"),
        c("type_local").alias("building_nature"), c("surface_reelle_bati").cast("int").alias("building_area"),
        c("surface_terrain").cast("int").alias("cadastral_parcel_area"),
        text.join_skip_null("adresse_numero", "adresse_nom_voie").alias("address"), c("code_postal").alias("postal_code"),
        c("nom_commune").alias("city"), c("code_departement").alias("department"),
        geo.point(c("longitude"), c("latitude")).alias("centroid"),
    )
    return SALES.align(out)


def parcels(features: DataFrame) -> DataFrame:
    """Parcels from GeoJSON features: first feature of an id, then valid shapes, with centroid."""
    rows = features.select(
        "id", F.col("commune").alias("town_insee_code"), F.col("prefixe").alias("section_prefix"), "section",
        F.col("numero").alias("work_number"), F.col("contenance").cast("int").alias("net_surface_area"), "shape",
    )
    one = keyed.first_wins(rows, ["id"], ["town_insee_code", "section_prefix", "section", "work_number"])
    valid, _ = ops.split_valid(one, "shape")
    return PARCELS.align(ops.with_centroid(valid, "shape", only_valid=False))


def farm_parcels(raw: DataFrame, cities: DataFrame, cell: float = 0.05) -> DataFrame:
    """Farm parcels, one row per part, with the name of the commune around their centroid.

    ``raw``: id_parcel, code_cultu, geom (multi-polygon), srid. ``cities``:
    nom_com, geom in WGS 84. A parcel on a border takes the first name in
    alphabetical order; parts of one id share their name.
    """
    flat = raw.select(
        F.col("id_parcel").alias("id"), F.col("code_cultu").alias("cap_crop_code"),
        geo.reproject(geo.force2d(F.col("geom"), 3), 3, F.col("srid")).alias("shape"),
    )
    parts = ops.dump(flat, "shape").drop("part")
    # Reprojected and measured once; both the search for communes and the output read the stored parts.
    parts = stored(parts.withColumn("centroid", geo.centroid_polygon(F.col("shape"))), "farm-parcels")
    towns = cities.select(F.col("nom_com").alias("city_name"), F.col("geom").alias("_town"))
    hits = ops.point_in_polygon_join(parts.select("id", "centroid"), towns, "centroid", "_town", cell=cell)
    named = hits.groupBy("id").agg(F.min("city_name").alias("city_name"))
    return FARM_PARCELS.align(parts.join(named, "id", "left"))


def postal_codes(raw: DataFrame, communes: DataFrame) -> DataFrame:
    """Postal codes with the commune's shape (Lambert-93 in, WGS 84 out) and centroid."""

    def head(col: str, n: int):
        return F.substring(F.replace(F.col(col), F.lit(" "), F.lit("")), 1, n)

    rows = raw.select(
        text.join_skip_null(
            "code_commune_insee", F.lit("_"), "code_postal", F.lit("_"), head("libelle_d_acheminement", 6), F.lit("_"),
            head("ligne_5", 12),
        ).alias("id"),
        F.lit("FR").alias("country"), F.col("code_commune_insee").alias("code"),
        text.elide_articles(F.col("nom_de_la_commune")).alias("city_name"), F.col("code_postal").alias("postal_code"),
        F.col("libelle_d_acheminement").alias("city_delivery_name"), F.col("ligne_5").alias("city_delivery_detail"),
    )
    return POSTAL_CODES.align(ops.attach_shape(rows, communes, "code", "insee_com", "geom", geo.LAMBERT93))


def natural_zones(zones: Mapping[str, DataFrame]) -> DataFrame:
    """Zones of several kinds (``sic``, ``zps``) in Lambert-93 as one table."""
    rows = union_families([
        df.select(
            F.col("sitecode").alias("id"), F.col("sitename").alias("name"), F.lit(kind).alias("nature"),
            geo.reproject(F.col("geom"), 3, geo.LAMBERT93).alias("shape"),
        )
        for kind, df in zones.items()
    ])
    return NATURAL_ZONES.align(ops.with_centroid(rows, "shape"))


def water_zones(raw: DataFrame) -> DataFrame:
    rows = raw.select(
        F.col("gid").cast("string").alias("id"), F.col("nomcircadm").alias("administrative_zone"),
        F.col("auteuraac").alias("creator_name"), F.col("nomdeaac_1").alias("name"),
        dates.iso_day(F.col("datemajaac")).alias("updated_on"), F.col("geom").alias("shape"),
    )
    return WATER_ZONES.align(ops.with_centroid(rows, "shape"))


def soil_depths(raw: DataFrame) -> DataFrame:
    rows = raw.select(
        F.col("prof_id").cast("string").alias("id"), F.col("pr_cl").cast("decimal(19,4)").alias("soil_depth_value"),
        F.lit("centimeter").alias("soil_depth_unit"), F.col("geom").alias("shape"),
    )
    return SOIL_DEPTHS.align(ops.with_centroid(rows, "shape"))


def soil_water(raw: DataFrame) -> DataFrame:
    """Water capacity classes decoded to minimum, maximum and label; unknown classes stay NULL."""
    rows = raw.select(
        F.col("reserve_id").cast("string").alias("id"), F.col("classe").cast("int").alias("available_water_reference_value"),
        F.lit("millimeter").alias("available_water_unit"), F.col("geom").alias("shape"),
    )
    classes = [(k, *v) for k, v in lookups.WATER_CLASSES.items()]
    schema = (
        "available_water_reference_value int, available_water_min_value double, available_water_max_value double, "
        "available_water_label string"
    )
    decoded = lookups.enrich(rows, classes, schema, "available_water_reference_value")
    return SOIL_WATER.align(ops.with_centroid(decoded, "shape"))
