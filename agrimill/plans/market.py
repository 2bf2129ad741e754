"""Market prices and company register."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from agrimill.functions import dates, geometry as geo, lookups, numbers, text
from agrimill.operators import keyed
from agrimill.specs import POINT, TableSpec

PRICES = TableSpec(
    "eu_market_prices", "registered_eu_market_prices",
    "id string, nature string, category string, specie string, production_reference_name string, sector_code string, "
    "product_code string, product_label string, product_description string, unit_value int, unit_name string, "
    "country string, price decimal(8,2), start_date date, end_date date",
    pk=("id",),
)
ENTERPRISES = TableSpec(
    "enterprises", "registered_enterprises",
    "establishment_number string, french_main_activity_code string, name string, address string, postal_code string, "
    f"city string, country string, centroid {POINT}",
    pk=("establishment_number",), not_null=("french_main_activity_code",),
)
SPECS = [PRICES, ENTERPRISES]


def market_prices(payload: DataFrame, extended_key: bool = False, thousands: bool = False) -> DataFrame:
    """Price objects to rows keyed by product, country and first day.

    The key leaves out market and stage, so of several markets the first in
    alphabetical order stays; ``extended_key`` adds both and keeps all.
    """
    c = F.col
    start = dates.day_first(c("beginDate"))
    key = [c("product_code"), c("memberStateCode"), start.cast("string")]
    if extended_key:
        key += [F.coalesce("marketName", F.lit("")), F.coalesce("stageName", F.lit(""))]
    rows = payload.filter(c("price").isNotNull()).select(
        F.concat_ws("_", *key).alias("id"), F.lit("eu_price").alias("nature"), F.lit("Vegetal Products").alias("category"),
        lookups.decode(c("product_code"), lookups.MARKET_SPECIES).alias("specie"), F.lit("CER").alias("sector_code"),
        "product_code", F.concat_ws(" ", "productName", F.replace("marketName", F.lit("'"), F.lit(""))).alias("product_label"),
        c("stageName").alias("product_description"), F.lit(1).alias("unit_value"),
        lookups.decode(c("unit"), lookups.MARKET_UNITS, "").alias("unit_name"), c("memberStateCode").alias("country"),
        numbers.leading_price(c("price"), thousands).cast("decimal(8,2)").alias("price"), start.alias("start_date"),
        dates.day_first(c("endDate")).alias("end_date"),
    )
    return PRICES.align(keyed.first_wins(rows, ["id"], ["product_label", "product_description", "end_date", "price"]))


def enterprises(raw: DataFrame, codes: Sequence[str] = lookups.ACTIVITY_CODES, spaced_address: bool = False) -> DataFrame:
    """Establishments with a farming activity, located from Lambert-93 coordinates.

    The default ``codes`` misspell 01.25Z and so miss its establishments; ``lookups.ACTIVITY_CODES_MENDED`` has them.

    ``spaced_address`` joins the address parts that say something by a space and
    leaves NULL if none does; otherwise all parts are run together.
    """
    e = "_etablissement"
    c = F.col
    x, y = c(f"coordonnee_lambert_abscisse{e}"), c(f"coordonnee_lambert_ordonnee{e}")
    known = x.isNotNull() & (x != "[ND]")
    px, py = F.when(known, x).try_cast("double"), F.when(known, y).try_cast("double")
    if spaced_address:
        address = text.address_parts(c(f"numero_voie{e}"), c(f"type_voie{e}"), c(f"libelle_voie{e}"))
    else:
        address = text.join_skip_null(f"numero_voie{e}", f"indice_repetition{e}", f"type_voie{e}", f"libelle_voie{e}")
    rows = raw.filter(c(f"activite_principale{e}").isin(*codes)).select(
        c("siret").alias("establishment_number"), c(f"activite_principale{e}").alias("french_main_activity_code"),
        F.coalesce(c(f"enseigne1{e}"), c(f"enseigne2{e}"), c(f"enseigne3{e}"), c(f"denomination_usuelle{e}")).alias("name"),
        address.alias("address"), c(f"code_postal{e}").alias("postal_code"), c(f"libelle_commune{e}").alias("city"),
        F.lit("FR").alias("country"), geo.to_wgs84(px, py, geo.LAMBERT93).alias("centroid"),
    )
    return ENTERPRISES.align(rows)
