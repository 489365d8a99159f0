"""Runs and descriptions: ordered steps with audits, publish gates, annotated fields, glossary, reproducible samples."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeq.functions.scalars import semantic_type, template_annotation
from lakeq.operators import audits


@dataclass(frozen=True)
class Step:
    """One step of a run: ``build`` makes its table from those before, ``checks`` name lists of violations in it."""

    name: str
    build: Callable[[dict[str, DataFrame]], DataFrame]
    checks: Callable[[dict[str, DataFrame]], dict[str, DataFrame]] | None = None


REPORT = "step string, position int, rows long, violations long, seconds double, status string, error string"


def run_steps(spark: SparkSession, steps: list[Step], save: Callable[[str, DataFrame], DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Runs steps in order; ``save`` writes a table and gives it back as read. (tables, report).

    A step is valid if it raised nothing and no check found anything; the steps after one that raised are skipped.
    """
    tables: dict[str, DataFrame] = {}
    report, broken = [], False
    for position, step in enumerate(steps, 1):
        if broken:
            report.append((step.name, position, None, None, None, "skipped", None))
            continue
        began = time.time()
        try:
            tables[step.name] = save(step.name, step.build(tables))
            n = tables[step.name].count()
            found = step.checks(tables) if step.checks else {}
            bad = audits.audit_summary(found).filter("audit = 'overall'").first()["violations"] if found else 0
            report.append((step.name, position, n, bad, time.time() - began, "valid" if not bad else "invalid", None))
        except Exception as error:  # a failed step is part of the report
            broken = True
            report.append((step.name, position, None, None, time.time() - began, "error", str(error)[:1000]))
    return tables, spark.createDataFrame(report, REPORT)


def publishable(coverage: DataFrame, least: float = 1.0) -> DataFrame:
    """Adds ``publish`` to the coverage of runs (``governance.chunk_coverage``): enough chunks are done."""
    return coverage.withColumn("publish", F.col("ratio") >= least)


def sample_k(df: DataFrame, k: int, seed: int, *key: str) -> DataFrame:
    """``k`` rows by a seeded hash of their key: the same on any partitioning. The number is the feature."""
    return df.orderBy(F.xxhash64(F.lit(seed), *key), *key).limit(k)


def pass_through(df: DataFrame, dataset: str, layer: str) -> DataFrame:
    """Rows as they are, with the data set and layer they now belong to."""
    return df.withColumns({"_dataset": F.lit(dataset), "_layer": F.lit(layer)})


def ensure_namespace(spark: SparkSession, name: str) -> None:
    from lakeq.sources.lake_table import safe_identifier

    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {safe_identifier(name)}")


ANNOTATION = "dataset string, field string, type string, role string, description string, confidence double, method string"


def annotate(spark: SparkSession, dataset: str, schema: T.StructType, templates: dict[str, dict], known: DataFrame | None = None) -> DataFrame:
    """What each field means: as ``known`` (an earlier result) says, else by template, else by its name."""
    rows = []
    for f in schema.fields:
        found = template_annotation(f.name, templates)
        if found:
            rows.append((dataset, f.name, f.dataType.simpleString(), found.get("role"), found.get("description"), float(found.get("confidence", 0.0)), "template"))
        else:
            rows.append((dataset, f.name, f.dataType.simpleString(), semantic_type(f.name), None, 0.5, "name"))
    fresh = spark.createDataFrame(rows, ANNOTATION)
    if known is None:
        return fresh
    kept = known.select(*[c.split()[0] for c in ANNOTATION.split(", ")]).join(fresh.select("dataset", "field", "type"), ["dataset", "field", "type"], "left_semi")
    return kept.unionByName(fresh.join(kept.select("dataset", "field", "type"), ["dataset", "field", "type"], "left_anti"))


def glossary(annotations: DataFrame) -> DataFrame:
    """term, description, fields (dataset.field of every use) of annotated fields."""
    used = F.concat_ws(".", "dataset", "field")
    return annotations.groupBy(F.col("role").alias("term")).agg(F.max("description").alias("description"), F.array_sort(F.collect_set(used)).alias("fields"))


def lineage_facets(inputs: dict[str, list[str]], outputs: dict[str, list[str]], rows_out: Column) -> Column:
    """Facets of a transform as JSON: fields of its inputs and outputs, rows written."""
    names = lambda tables: F.create_map(*[x for t, fields in tables.items() for x in (F.lit(t), F.array(*map(F.lit, fields)))])
    return F.to_json(F.struct(names(inputs).alias("inputs"), names(outputs).alias("outputs"), rows_out.alias("row_count")))
