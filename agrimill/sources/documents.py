"""JSON, GeoJSON and XML sources.

Each source has a file reader and, where records may already sit in a column, a
parser over that column. Both give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from agrimill.functions.geometry import from_coordinates

FEATURE_PROPERTIES = "id string, commune string, prefixe string, section string, numero string, contenance double"


def _fields(ddl: str) -> str:
    return ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in StructType.fromDDL(ddl).fields)


def _nested(depth: int) -> str:
    return "array<" * (depth + 1) + "double" + ">" * (depth + 1)


def feature_rows(features: DataFrame, properties: str = FEATURE_PROPERTIES, defaults: str = "0") -> DataFrame:
    """Feature column (``geometry`` kept as JSON text) to typed rows with multi-polygon shapes.

    Missing text properties become the default ``'0'``, missing numbers 0.
    Polygons are wrapped as multi-polygons of one part.
    """
    kind = F.get_json_object("geometry", "$.type")
    coords = F.get_json_object("geometry", "$.coordinates")
    one = from_coordinates(F.from_json(coords, _nested(2)), 2)
    many = from_coordinates(F.from_json(coords, _nested(3)), 3)
    shape = F.when(kind == "Polygon", F.array(one)).when(kind == "MultiPolygon", many)
    out: list[Column] = []
    for f in StructType.fromDDL(properties).fields:
        value = F.col(f"properties.{f.name}")
        missing = F.lit(defaults) if f.dataType.simpleString() == "string" else F.lit(0).cast(f.dataType)
        out.append(F.coalesce(value, missing).alias(f.name))
    return features.select(*out, shape.alias("shape"))


def parse_features(df: DataFrame, col: str, properties: str = FEATURE_PROPERTIES) -> DataFrame:
    """JSON text column holding one feature per row."""
    schema = f"geometry string, properties struct<{_fields(properties)}>"
    return feature_rows(df.select(F.from_json(F.col(col), schema).alias("f")).select("f.*"), properties)


# What ends a piece of a collection that is read in pieces: the value of every feature's ``type``.
FEATURE_MARK = '"Feature"'


def scan_features(spark: SparkSession, path: str | Sequence[str], properties: str = FEATURE_PROPERTIES) -> DataFrame:
    """Features of collections of any size, read in pieces by many tasks: ``geometry`` as JSON text, ``properties``.

    Files are cut at the ``"Feature"`` of each feature's type, so Spark splits them like lines of text and no task holds
    a collection. The members of a feature stand either all after its type, where the parser stops at the feature's end,
    or all before it; single values such as an id may stand on either side. Empty collections, and several collections
    in one file, are read too. What cannot be read in pieces fails the load rather than losing a feature: geometry and
    properties on two sides of the type, an inner value that is ``"Feature"``, a missing geometry or properties member
    (null is a value), broken JSON, a property of another type than declared. ``read_geojson(whole=True)`` takes such
    files.
    """
    schema = f"geometry string, properties struct<{_fields(properties)}>"
    pieces = spark.read.option("lineSep", FEATURE_MARK).text(path)
    piece = F.col("value")
    # Members after the type: the piece goes on with a comma and ends where the next feature's type is due, or the file.
    follows = piece.rlike(r"^\s*,")
    ends_well = piece.rlike(r"\{[^{}]*\"type\"\s*:\s*$") | piece.rlike(r"\}\s*$")
    # Members before the type: they fill the end of the piece before, behind the feature closed there or the list's start.
    head = F.regexp_extract(piece, r"^\s*(?:\}\s*,\s*|(?:\}\s*\][\s\S]*?)?\{[\s\S]*?\"features\"\s*:\s*\[\s*)(\{[\s\S]*\"type\"\s*:\s*)$", 1)
    nothing = piece.rlike(r"^\s*(\}\s*\]|\{[\s\S]*\"features\"\s*:\s*\[\s*\])") | piece.rlike(r"^\s*$")
    text = (
        F.when(follows & ends_well, F.concat(F.lit('{"type":' + FEATURE_MARK), piece))
        .when(~follows & (head != ""), F.concat(head, F.lit("0}")))
        .when(~follows & nothing, F.lit(None))
        .otherwise(F.raise_error(F.concat(F.lit("not a feature collection that can be read in pieces: "), F.substring(piece, 1, 200))))
    )
    parsed = pieces.select(follows.alias("_follows"), text.alias("_text")).where("_text is not null")
    parsed = parsed.withColumn("_f", F.from_json("_text", schema, {"mode": "FAILFAST"}))
    lacking = F.col("_f.geometry").isNull() | F.col("_f.properties").isNull()
    names = F.map_keys(F.from_json("_text", "map<string,string>", {"mode": "FAILFAST"}))
    here = F.array_contains(names, "geometry").cast("int") + F.array_contains(names, "properties").cast("int")
    # Before a type there may be no members, when they come after it; else a feature has both members on one side.
    there = F.when(lacking, here).otherwise(2)
    state = F.when(there == 2, True).when((there == 0) & ~F.col("_follows"), False)
    state = F.coalesce(state, F.raise_error(F.concat(F.lit("feature without geometry or properties on one side of its type: "), F.substring("_text", 1, 200))))
    return parsed.where(state).select("_f.geometry", "_f.properties")


def read_geojson(
    spark: SparkSession, path: str | Sequence[str], properties: str = FEATURE_PROPERTIES, by_line: bool = False, whole: bool = False
) -> DataFrame:
    """Feature collections, read in pieces (see ``scan_features``); ``by_line`` reads one feature per line.

    With ``whole`` a collection is parsed as one document in one task, whatever the order of its members.
    """
    feature = f"geometry string, properties struct<{_fields(properties)}>"
    if by_line:
        return feature_rows(spark.read.schema(feature).json(path), properties)
    if not whole:
        return feature_rows(scan_features(spark, path, properties), properties)
    schema = f"features array<struct<geometry:string,properties:struct<{_fields(properties)}>>>"
    document = spark.read.schema(schema).option("multiLine", True).json(path)
    return feature_rows(document.select(F.explode("features").alias("f")).select("f.*"), properties)


MARKET_PAYLOAD = (
    "memberStateCode string, beginDate string, endDate string, productName string, "
    "marketName string, stageName string, unit string, price string"
)


def parse_market_payload(df: DataFrame, col: str, code: str) -> DataFrame:
    """JSON text column holding an array of price objects, one row per object."""
    schema = f"array<struct<{_fields(MARKET_PAYLOAD)}>>"
    # Outer explode and a test after it: the inner form would parse the text twice.
    items = df.select(F.col(code).alias("product_code"), F.explode_outer(F.from_json(F.col(col), schema)).alias("p"))
    return items.filter(F.col("p").isNotNull()).select("product_code", "p.*")


def read_market_payload(spark: SparkSession, path: str, code_pattern: str = r"([A-Z]+)\.json") -> DataFrame:
    """Landed payload files; the product code is taken from the file name."""
    return (
        spark.read.schema(MARKET_PAYLOAD).option("multiLine", True).json(path)
        .withColumn("product_code", F.regexp_extract(F.input_file_name(), code_pattern, 1))
    )


def read_xml_catalogue(spark: SparkSession, path: str | Sequence[str], row_tags: Sequence[str], schema: str) -> DataFrame:
    """Records of several tags as one table; ``record_tag`` says which one.

    The reader splits a large file at the record tag, so one catalogue is read
    by many tasks.
    """
    frames = [
        spark.read.format("xml").option("rowTag", tag).schema(schema).load(path).withColumn("record_tag", F.lit(tag))
        for tag in row_tags
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def parse_xml(df: DataFrame, col: str, schema: str) -> DataFrame:
    """XML text column holding one record per row."""
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.from_xml(F.col(col), schema).alias("_record")).select(*rest, "_record.*")


def ingest_geometry(df: DataFrame, col: str, depth: int, srid: int) -> DataFrame:
    """GeoJSON geometry text column to nested points, with its SRID as a column.

    ``depth`` is that of the multi form; single lines and polygons are wrapped.
    """
    kind = F.get_json_object(col, "$.type")
    coords = F.get_json_object(col, "$.coordinates")
    geom = from_coordinates(F.from_json(coords, _nested(depth)), depth)
    if depth >= 2:
        single = F.array(from_coordinates(F.from_json(coords, _nested(depth - 1)), depth - 1))
        geom = F.when(F.startswith(kind, F.lit("Multi")), geom).otherwise(single)
    return df.withColumn(col, geom).withColumn("srid", F.lit(srid))


def nomenclature(df: DataFrame) -> DataFrame:
    """(name, locale, label) rows to one label map per name."""
    pairs = F.array_sort(F.collect_list(F.struct("locale", "label")))
    one = df.groupBy("name", "locale").agg(F.min("label").alias("label"))
    return one.groupBy("name").agg(F.map_from_entries(pairs).alias("label"))
