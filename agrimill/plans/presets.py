"""All table specs, and ready-made release flavors."""

from __future__ import annotations

from agrimill.operators.release import CREDITS_SPEC, Flavor
from agrimill.plans import hydrography, land, market, prices, productions, protection, registers, units, variants, weather, workflows

SPECS = [
    *land.SPECS, *hydrography.SPECS, *weather.SPECS, *market.SPECS, *protection.SPECS, *prices.SPECS, *productions.SPECS, *variants.SPECS,
    *units.SPECS, *workflows.SPECS, *registers.SPECS, CREDITS_SPEC,
]

# Tables with a centroid. Every flavor of an area limits the land and water ones; some limit zones and soil as well.
LAND_AND_WATER = (
    "registered_cadastral_parcels", "registered_graphic_parcels", "registered_hydrographic_items", "registered_area_items",
    "registered_cadastral_buildings",
)
LOCATED = (
    *LAND_AND_WATER, "registered_natural_zones", "registered_protected_water_zones", "registered_soil_depths",
    "registered_soil_available_water_capacities",
)
HEAVY_SOURCES = (
    "enterprises", "graphic_parcels", "cadastre", "cadastral_prices", "hydrography", "postal_codes", "weather",
)


def around(name: str, circles: tuple[tuple[float, float, float], ...], postal: str, zones: tuple[str, ...], without: tuple[str, ...] = (), located: tuple[str, ...] = LOCATED) -> Flavor:
    """Flavor of a few areas: circles for the tables in ``located``, a postal-code test, weather zones."""
    quoted = ", ".join(f"'{z}'" for z in zones)
    stations = " OR ".join(f"station_id LIKE 'FR{z}%'" for z in zones)
    filters: dict = {t: circles for t in located}
    filters.update({
        "registered_cadastral_prices": postal, "registered_postal_codes": postal,
        "registered_weather_stations": f"country = 'FR' AND country_zone IN ({quoted})", "registered_hourly_weathers": stations,
    })
    order = {"registered_cadastral_prices": ("id",), "registered_graphic_parcels": ("id",)}
    if "enterprises" not in without:
        filters["registered_enterprises"] = postal
        order["registered_enterprises"] = ("establishment_number",)
    return Flavor(name, without=without, filters=filters, order_by=order)


# Areas of the ready-made flavors.
SEVEN_AREAS = (
    (-0.78, 45.81, 0.10), (-0.06, 44.61, 0.03), (-1.14, 49.18, 0.10), (-0.20, 43.39, 0.10), (1.59, 45.43, 0.10),
    (-1.50, 47.43, 0.10), (-1.21, 43.78, 0.10),
)
SEVEN_POSTAL = "postal_code IN ('17250', '19140', '33190', '50880', '64160', '44390', '40140')"

FULL = Flavor("full")
LIGHT = Flavor("light", without=HEAVY_SOURCES)
TEST = around("test", ((-0.78, 45.81, 0.10),), "postal_code = '17250'", ("17",))
SEVEN = around("innovation", SEVEN_AREAS, SEVEN_POSTAL, ("17", "19", "33", "40", "50", "64", "44"))
GIRONDE = around("pv", ((-0.76, 44.70, 0.30),), "postal_code LIKE '33%'", ("33",), without=("enterprises",), located=LAND_AND_WATER)
LANDES = around("sydec", ((-0.35, 43.85, 0.15),), "postal_code LIKE '40%'", ("40",), without=("enterprises",), located=LAND_AND_WATER)
SOUTH_WEST = Flavor(
    "south_west", without=("enterprises",),
    filters={
        "registered_cadastral_parcels": ((-0.534765, 44.820503, 2.0),),
        "registered_cadastral_prices": "department IN ('17', '33')",
        "registered_hydrographic_items": "id LIKE '%_fra_D017' OR id LIKE '%_fra_D033'",
        "registered_area_items": "id LIKE '%2005598064_fra_D017' OR id LIKE '%32376357_fra_D017' OR id LIKE '%2229718524_fra_D017'",
        "registered_cadastral_buildings": ((-0.534765, 44.820503, 2.0),),
    },
)
PARCELS_ONLY = Flavor(
    "natais", without=(
        "agroedi", "budgets", "cadastral_prices", "cadastre", "chart_of_accounts", "enterprises", "eu_market_prices", "hydrography",
        "intervention_models", "legal_positions", "phenological_stages", "prices", "protected_water_zones", "quality_and_origin_signs",
        "seed_varieties", "soil", "technical_workflows", "technical_workflow_sequences", "vine_varieties", "weather",
    ),
    filters={"registered_graphic_parcels": ((-0.87374, 43.55297, 4.0),)},
)
VINES = Flavor("vines")  # the only source it leaves out is none of the tables here
PRESETS = {f.name: f for f in (FULL, VINES, LIGHT, TEST, SEVEN, GIRONDE, LANDES, SOUTH_WEST, PARCELS_ONLY)}
