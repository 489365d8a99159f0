"""Unit spellings and conversion to canonical units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Dimension, unit, canonical unit, factor, offset (none: not convertible without more context), lowest and highest plausible value.
UNITS = [
    ("temperature", "celsius", "celsius", 1.0, 0.0, -90.0, 70.0),
    ("temperature", "c", "celsius", 1.0, 0.0, -90.0, 70.0),
    ("temperature", "fahrenheit", "celsius", 0.5555555556, -17.7777777778, -130.0, 160.0),
    ("temperature", "kelvin", "celsius", 1.0, -273.15, 180.0, 350.0),
    ("speed", "km/h", "km/h", 1.0, 0.0, 0.0, 300.0),
    ("speed", "m/s", "km/h", 3.6, 0.0, 0.0, 100.0),
    ("speed", "mph", "km/h", 1.609344, 0.0, 0.0, 200.0),
    ("distance", "km", "km", 1.0, 0.0, 0.0, 10000.0),
    ("distance", "m", "km", 0.001, 0.0, 0.0, 10000000.0),
    ("distance", "mi", "km", 1.609344, 0.0, 0.0, 6214.0),
    ("concentration", "ug/m3", "ug/m3", 1.0, 0.0, 0.0, 5000.0),
    ("concentration", "ppm", "ug/m3", None, None, 0.0, 1000.0),
    ("concentration", "ppb", "ug/m3", None, None, 0.0, 1000000.0),
]
# Symbols of base units and prefixes by their English names, and short forms that have no slash.
BASES = {"metre": "m", "mile": "mi", "hour": "h", "second": "s", "gram": "g"}
PREFIXES = {"": "", "kilo": "k", "micro": "u"}
SHORT = {"ugm3": "ug/m3", "kmh": "km/h", "kph": "km/h", "mps": "m/s"}
SCHEMA = "dimension string, unit string, canonical_unit string, factor double, shift double, lowest double, highest double"


def _lookup(names: dict[str, str], c: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), c)


def _symbol(part: Column) -> Column:
    """``cubic metres``, ``m^3``, ``kilometer`` -> m3, m3, km: prefix, base and power of one side of a unit, else the text."""
    bare = F.regexp_replace(part, r"[\s^]", "")
    cubic = bare.startswith("cubic")
    word = F.regexp_extract(F.when(cubic, F.substr(bare, F.lit(6))).otherwise(bare), r"^(.*?)(\d*)$", 1)
    power = F.when(cubic, "3").otherwise(F.regexp_extract(bare, r"(\d*)$", 1))
    name = r"^(" + "|".join(p for p in PREFIXES if p) + r")?(met(?:re|er)|" + "|".join(b for b in BASES if b != "metre") + r")s?$"
    base = F.regexp_replace(F.regexp_extract(word, name, 2), "meter", "metre")
    known = F.concat(_lookup(PREFIXES, F.regexp_extract(word, name, 1)), _lookup(BASES, base))
    return F.concat(F.coalesce(known, word), power)


def unit_key(c: Column) -> Column:
    """One spelling of a unit: the symbols of its numerator and denominator, without degree sign, blanks or carets."""
    text = F.translate(F.lower(F.trim(F.coalesce(c, F.lit("")))), "\u00b2\u00b3\u00b5\u03bc\u00b0", "23uu")
    sides = F.transform(F.split(text, r"\s*(?:/|per)\s*"), _symbol)
    joined = F.array_join(sides, "/")
    return F.coalesce(_lookup(SHORT, joined), joined)


def unit_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(UNITS, SCHEMA)


def convert(df: DataFrame, value: str, unit: str, dimension: str) -> DataFrame:
    """Adds canonical_unit, converted (six places, half even), plausible; null where there is no conversion."""
    units = unit_table(df.sparkSession).filter(F.col("dimension") == dimension).withColumnRenamed("unit", "_unit").drop("dimension")
    number = F.col(value).try_cast("double")
    joined = df.withColumn("_unit", unit_key(F.col(unit))).join(F.broadcast(units), "_unit", "left")
    return (
        joined.withColumn("converted", F.bround(number * F.col("factor") + F.col("shift"), 6))
        .withColumn("plausible", number.between(F.col("lowest"), F.col("highest")))
        .drop("_unit", "factor", "shift", "lowest", "highest")
    )
