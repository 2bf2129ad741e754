"""Weather stations and hourly measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from agrimill.functions import dates, geometry as geo, text
from agrimill.operators import keyed
from agrimill.operators.aggregates import min_text_as_int
from agrimill.specs import POINT, TableSpec

STATIONS = TableSpec(
    "weather", "registered_weather_stations",
    "reference_name string, country string, country_zone string, station_code string, station_name string, "
    f"elevation int, centroid {POINT}",
    pk=("reference_name",), not_null=("country", "country_zone", "station_code", "station_name"),
)
_MEASURE = "decimal(19,4)"
HOURLY = TableSpec(
    "weather", "registered_hourly_weathers",
    "station_id string, started_at timestamp_ntz, mesured_delay interval day to second, "
    f"average_temp {_MEASURE}, min_temp {_MEASURE}, max_temp {_MEASURE}, rain {_MEASURE}, max_wind_speed {_MEASURE}, "
    f"wind_direction {_MEASURE}, frozen_duration {_MEASURE}, humidity {_MEASURE}, soil_state string, pressure {_MEASURE}, "
    "weather_description string",
)
SPECS = [STATIONS, HOURLY]

# Measure column, raw column.
MEASURES = {
    "average_temp": "t", "min_temp": "tn", "max_temp": "tx", "rain": "rr1", "max_wind_speed": "fxi",
    "wind_direction": "dxi", "frozen_duration": "dg", "humidity": "u", "pressure": "pstat",
}


def stations(raw: DataFrame, numeric_elevation: bool = False) -> DataFrame:
    """One row per station, from the hourly rows of one period.

    The lowest elevation of a station's rows is taken in text order, as it is
    stored, unless ``numeric_elevation``. A station listed under several names
    or places keeps the first in order.
    """
    post = F.trim("num_poste")
    grouped = raw.groupBy("num_poste", "nom_usuel", "lat", "lon").agg(
        min_text_as_int(F.col("alti"), numeric_elevation).alias("elevation")
    )
    rows = grouped.select(
        text.join_skip_null(F.lit("FR"), post).alias("reference_name"), F.lit("FR").alias("country"),
        F.substring(post, 1, 2).alias("country_zone"), post.alias("station_code"), F.trim("nom_usuel").alias("station_name"),
        "elevation", geo.point(F.col("lon"), F.col("lat")).alias("centroid"), "num_poste", "nom_usuel", "lat", "lon",
    )
    one = keyed.first_wins(rows, ["reference_name"], ["num_poste", "nom_usuel", "lat", "lon"])
    return STATIONS.align(one.drop("num_poste", "nom_usuel", "lat", "lon"))


def hourly(raw: DataFrame) -> DataFrame:
    """Hourly measures, typed. Every row is kept: the table has no key."""
    return HOURLY.align(
        raw.select(
            text.join_skip_null(F.lit("FR"), F.trim("num_poste")).alias("station_id"),
            dates.hour_stamp(F.col("aaaammjjhh")).alias("started_at"), dates.hours_interval(F.lit(1)).alias("mesured_delay"),
            *[F.col(src).cast(_MEASURE).alias(name) for name, src in MEASURES.items()],
            F.col("sol").alias("soil_state"), F.col("ww").alias("weather_description"),
        )
    )


def write_hourly(df: DataFrame, path: str) -> None:
    """Hourly table by month, stations together inside a month.

    One output task per month and station range, so a filter on time prunes
    folders and one on station skips row groups.
    """
    month = F.date_format("started_at", "yyyy-MM")
    (
        df.withColumn("month", month)
        .repartitionByRange(F.col("month"), F.col("station_id"))
        .sortWithinPartitions("month", "station_id", "started_at")
        .write.mode("overwrite").partitionBy("month").parquet(path)
    )
