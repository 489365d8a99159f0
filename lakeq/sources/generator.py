"""Seeded synthetic tables from column names and types, for demonstrations and load tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeq.functions.scalars import semantic_type

#: Fault shares by preset: null, duplicate, type error.
PRESETS = {"none": (0.0, 0.0, 0.0), "low": (0.01, 0.005, 0.005), "moderate": (0.05, 0.02, 0.02), "high": (0.1, 0.05, 0.05), "extreme": (0.25, 0.15, 0.15)}


def _column(name: str, kind: str, seed: int) -> Column:
    u = lambda n: F.pmod(F.xxhash64(F.lit(seed), F.lit(name), "id"), F.lit(n))
    if kind == "boolean":
        return u(2) == 0
    if kind == "number":
        return (u(1_000_000) / 100.0).cast("double")
    if kind == "integer":
        return F.col("id") + 1 if name.startswith("sk_") else u(100_000) + 1
    if semantic_type(name) == "temporal":
        return F.date_add(F.lit("2012-01-01").cast("date"), u(1_300).cast("int")).cast("string")
    return F.concat(F.lit(name[:4] + "_"), F.substring(F.md5(F.concat(F.lit(f"{seed}{name}"), F.col("id").cast("string"))), 1, 8))


def generate(spark: SparkSession, columns: dict[str, str], rows: int, seed: int = 42, preset: str = "none") -> DataFrame:
    """``rows`` rows of the columns; the preset adds nulls, repeated rows and unreadable numbers, as strings."""
    nulls, copies, errors = PRESETS[preset]
    df = spark.range(rows).select("id", *[_column(n, k, seed).alias(n) for n, k in columns.items()])
    if preset == "none":
        return df.drop("id")
    share = lambda salt: F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), "id"), F.lit(1_000_000)) / 1e6
    dirty = [
        F.when(share(n + "null") < nulls, F.lit(None).cast("string")).when((share(n + "type") < errors) & F.lit(k in ("integer", "number")), "NOT_A_NUMBER").otherwise(F.col(n).cast("string")).alias(n)
        for n, k in columns.items()
    ]
    out = df.select("id", *dirty)
    return out.unionAll(out.filter(share("copy") < copies)).drop("id")
