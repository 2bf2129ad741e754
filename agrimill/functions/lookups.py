"""Decoding by fixed code tables.

A Python dict is bounded by the source code, so it is applied as a literal map
or a broadcast join. A code table that arrives as a DataFrame goes through
``operators.joins`` instead, where Spark picks the join from its measured size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# ---- fixed values -----------------------------------------------------------

# State of a product and of a usage.
PRODUCT_STATES = {"AUTORISE": "authorized", "RETIRE": "withdrawn"}
USAGE_STATES = {"Autorisé": "authorized", "Retrait": "withdrawn", "Provisoire": "provisional"}

# Allowed mentions of a product.
MENTION_FLAGS = {
    "Utilisable en agriculture biologique": "organic_usage",
    "Mention abeille": "bee_usage",
    "Liste biocontrôle": "biocontrol_usage",
}

# Mix category of a hazard code.
H_MIX_CATEGORY = {
    "H341": 2, "H351": 2, "H371": 2, "H361d": 3, "H361f": 3, "H361fd": 3, "H362": 3, "H373": 4,
    "H300": 5, "H301": 5, "H310": 5, "H311": 5, "H330": 5, "H331": 5, "H340": 5, "H350": 5,
    "H350i": 5, "H360F": 5, "H360D": 5, "H360FD": 5, "H360Fd": 5, "H360Df": 5, "H370": 5, "H372": 5,
}
R_MIX_CATEGORY = {
    "R40": 2, "R68": 2, "R68/x": 2, "R62": 3, "R63": 3, "R64": 3, "R48/20": 4, "R48/21": 4,
    "R48/22": 4, "R48/20/21": 4, "R48/20/22": 4, "R48/21/22": 4, "R48/20/21/22": 4, "T": 5, "T+": 5,
}

# Re-entry delay in hours of a hazard code; every other code is 6.
REENTRY_HOURS = {
    "H317": 48, "H334": 48, "H315": 24, "H318": 24, "H319": 24,
    "R42": 48, "R43": 48, "R36": 24, "R38": 24, "R41": 24,
}

# Species of a market product code, unit of a market price.
MARKET_SPECIES = {
    "AVO": "avena_sativa", "AVOMILL": "avena_sativa", "BLTFOUR": "triticum_aestivum",
    "BLTPAN": "triticum_aestivum", "DUR": "triticum_durum", "MAI": "zea_mays",
    "ORGBRAS": "hordeum_vulgare", "ORGFOUR": "hordeum_vulgare", "SEGPAN": "secale_cereale",
    "SEGFOUR": "secale_cereale", "TRI": "x_triticosecale",
}
MARKET_UNITS = {"TONNES": "ton"}

# Soil water class: minimum, maximum, label.
WATER_CLASSES = {
    1: (0.0, 50.0, "< 50 mm"), 2: (50.0, 100.0, "50 - 100 mm"), 3: (100.0, 150.0, "100 - 150 mm"),
    4: (150.0, 200.0, "150 - 200 mm"), 5: (200.0, 300.0, "> 200 mm"), 9: (0.0, 0.0, "--"),
}

# Farming, forestry and fishing activity codes kept from the company register.
ACTIVITY_CODES = (
    "01.11Z", "01.12Z", "01.13Z", "01.14Z", "01.15Z", "01.16Z", "01.19Z", "01.21Z", "01.22Z", "01.23Z",
    "01.24Z", "01.5Z", "01.26Z", "01.27Z", "01.28Z", "01.29Z", "01.30Z", "01.41Z", "01.42Z", "01.43Z",
    "01.44Z", "01.45Z", "01.46Z", "01.47Z", "01.49Z", "01.50Z", "01.61Z", "01.62Z", "01.63Z", "01.64Z",
    "01.70Z", "02.10Z", "02.20Z", "02.30Z", "02.40Z", "03.11Z", "03.12Z", "03.21Z", "03.22Z",
)

# The same list with the code that the one above misspells.
ACTIVITY_CODES_MENDED = tuple("01.25Z" if code == "01.5Z" else code for code in ACTIVITY_CODES)

# Dose unit label: canonical unit and factor.
DOSE_UNITS = {
    "%": ("percent", 1.0),
    "g/ha": ("gram_per_square_meter", 0.0001), "g/100 m²": ("gram_per_square_meter", 0.01),
    "g/10 m²": ("gram_per_square_meter", 0.1), "g/m²": ("gram_per_square_meter", 1.0),
    "g/100 m3": ("gram_per_hectoliter", 0.001), "g/10 m3": ("gram_per_hectoliter", 0.01),
    "g/m3": ("gram_per_hectoliter", 0.1), "g/m3 de substrat": ("gram_per_hectoliter", 0.1),
    "g/hL": ("gram_per_hectoliter", 1.0), "mg/m3": ("gram_per_hectoliter", 0.01),
    "g/L": ("gram_per_liter", 1.0), "g/L de substrat": ("gram_per_liter", 1.0),
    "kg": ("kilogram", 1.0),
    "g/kg": ("gram_per_kilogram", 1.0), "g/q": ("gram_per_kilogram", 0.01), "g/t": ("gram_per_kilogram", 0.001),
    "KG/KG VERS": ("gram_per_kilogram", 1000.0), "g/100 kg de compost": ("gram_per_kilogram", 0.01),
    "kg/q": ("gram_per_kilogram", 10.0), "kg/t": ("gram_per_kilogram", 1.0),
    "kg/100 m²": ("kilogram_per_square_meter", 0.01), "kg/10 m²": ("kilogram_per_square_meter", 0.1),
    "kg/m²": ("kilogram_per_square_meter", 1.0), "kg/ha": ("kilogram_per_square_meter", 0.0001),
    "L": ("liter", 1.0), "mL": ("milliliter", 1.0),
    "kg/hL": ("kilogram_per_hectoliter", 1.0), "kg/m3": ("kilogram_per_hectoliter", 0.1),
    "kg/L": ("kilogram_per_liter", 1.0), "kg/10 L": ("kilogram_per_liter", 0.1),
    "L/m²": ("liter_per_square_meter", 1.0), "L/10 m²": ("liter_per_square_meter", 0.1),
    "L/100 m²": ("liter_per_square_meter", 0.01), "mL/10 m²": ("liter_per_square_meter", 0.0001),
    "mL/m²": ("liter_per_square_meter", 0.001),
    "L/ha": ("liter_per_hectare", 1.0), "mL/ha": ("liter_per_hectare", 0.001), "L/ha/an": ("liter_per_hectare", 1.0),
    "mL/L": ("milliliter_per_liter", 1.0), "mL/10 L": ("milliliter_per_liter", 0.1),
    "mL/hL": ("milliliter_per_liter", 0.01), "mL/m3": ("milliliter_per_liter", 0.001),
    "unités/ha": ("unity_per_hectare", 1.0), "pièges/ha": ("unity_per_hectare", 1.0),
    "diffuseurs/ha": ("unity_per_hectare", 1.0), "diffuseurs/100 m²": ("unity_per_hectare", 100.0),
    "comprimés/ha": ("unity_per_hectare", 1.0),
    "L/L": ("centiliter_per_liter", 100.0), "L/10 L": ("centiliter_per_liter", 10.0),
    "L/hL": ("centiliter_per_liter", 1.0), "L/100 m3": ("centiliter_per_liter", 0.001),
    "L/m3": ("centiliter_per_liter", 0.1),
    "tablettes/L": ("unity_per_liter", 1.0), "batonnet/L de substrat": ("unity_per_liter", 1.0),
}

# ---- operators --------------------------------------------------------------


def _literal_map(table: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def decode(col: Column, table: Mapping, default: object = None) -> Column:
    """Value of a code, NULL (or the default) for an unknown one."""
    found = F.try_element_at(_literal_map(table), col)
    return found if default is None else F.coalesce(found, F.lit(default))


def decode_strict(col: Column, table: Mapping, what: str) -> Column:
    """Value of a code; an unknown code fails the job with a clear message.

    A missing code gives NULL, which the NOT NULL check of the table reports:
    raising on NULL would also hit rows a filter is about to drop.
    """
    kind = "int" if all(isinstance(v, int) for v in table.values()) else "string"
    unknown = F.raise_error(F.concat(F.lit(f"unknown {what}: "), col.cast("string"))).cast(kind)
    return F.when(col.isNotNull(), F.coalesce(F.try_element_at(_literal_map(table), col), unknown))


def flag_is_one(col: Column) -> Column:
    """``'1'`` is true; everything else, NULL too, is false."""
    return F.when(col == "1", True).otherwise(False)


def code_table(spark: SparkSession, rows: Sequence[tuple], schema: str, key: str) -> DataFrame:
    """Fixed rows as a DataFrame, first row of a key wins in the order given."""
    first: dict = {}
    position = [part.split()[0] for part in schema.split(",")].index(key)
    for row in rows:
        first.setdefault(row[position], row)
    return spark.createDataFrame(list(first.values()), schema)


def enrich(df: DataFrame, rows: Sequence[tuple], schema: str, on: str) -> DataFrame:
    """Left join to a fixed code table; its size is that of the Python literal."""
    return df.join(F.broadcast(code_table(df.sparkSession, rows, schema, on)), on, "left")


def with_dose_unit(df: DataFrame, label_col: str, units: Mapping = DOSE_UNITS) -> DataFrame:
    """Adds ``dose_unit`` and ``dose_unit_factor`` for a dose unit label."""
    name = F.col(label_col)
    return df.withColumns({
        "dose_unit": decode(name, {k: v[0] for k, v in units.items()}),
        "dose_unit_factor": decode(name, {k: v[1] for k, v in units.items()}).cast("float"),
    })
