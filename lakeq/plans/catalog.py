"""All queries outside the text subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeq.plans import core, fault_plans, problems

MODULES = [core, fault_plans, problems]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return core.gold_windowed_events(spark, d)
