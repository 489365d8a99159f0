"""Declared against observed schemas: drift policy, profiles, versions."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from difflib import SequenceMatcher

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeq.functions.scalars import text_pattern

NUMERIC = {"integer", "number"}
#: What happens for each issue (severity, action).
POLICY = {
    "field_rename_candidate": ("medium", "review_alias_mapping"),
    "missing_required_field": ("critical", "quarantine_record"),
    "dropped_downstream_field": ("high", "block_downstream_publication"),
    "missing_optional_field": ("medium", "fill_null_or_default_in_silver"),
    "new_unknown_field": ("low", "preserve_in_bronze_and_review_before_promotion"),
    "unsafe_type_change": ("high", "quarantine_record"),
    "safe_type_change": ("medium", "safe_cast_in_silver"),
}
ISSUE = "issue_code string, field_name string, severity string, action string, candidate_field string, confidence double"


def json_type_of(kind: T.DataType) -> str:
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, T.IntegralType):
        return "integer"
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        return "number"
    if isinstance(kind, (T.StructType, T.MapType)):
        return "object"
    return "array" if isinstance(kind, T.ArrayType) else "string"


def declared(schema: T.StructType) -> dict[str, set[str]]:
    return {f.name: {json_type_of(f.dataType)} for f in schema.fields}


def safe_cast(expected: set[str], actual: set[str]) -> bool:
    """Numbers into numbers, and strings into any scalar."""
    return (expected <= NUMERIC and actual <= NUMERIC) or (actual == {"string"} and bool(expected & {"integer", "number", "boolean", "string"}))


@dataclass(frozen=True)
class DriftPolicy:
    required: frozenset[str] = frozenset()
    keys: frozenset[str] = frozenset()
    downstream: frozenset[str] = frozenset()
    aliases: tuple[tuple[str, str], ...] = ()
    similarity: float = 0.82


def compare(expected: dict[str, set[str]], actual: dict[str, set[str]], policy: DriftPolicy = DriftPolicy()) -> list[tuple]:
    """Issues in the order missing, new, type: plain metadata, no rows are read."""
    gone, fresh, aliases, out = sorted(set(expected) - set(actual)), sorted(set(actual) - set(expected)), dict(policy.aliases), []
    for name in gone:
        alias, near = aliases.get(name), [(SequenceMatcher(None, name.lower(), n.lower()).ratio(), n) for n in fresh]
        likely = (1.0, alias) if alias in fresh else max(near, key=lambda x: x[0], default=(0.0, None))
        if likely[0] >= policy.similarity:
            code = "field_rename_candidate"
        elif name in policy.required | policy.keys:
            code = "missing_required_field"
        else:
            code = "dropped_downstream_field" if name in policy.downstream else "missing_optional_field"
        found = (likely[1], round(likely[0], 4)) if code == "field_rename_candidate" else (None, None)
        out.append((code, name, *POLICY[code], *found))
    out += [("new_unknown_field", name, *POLICY["new_unknown_field"], None, None) for name in fresh]
    for name in sorted(set(expected) & set(actual)):
        seen = actual[name] - {"null"}
        if expected[name] - {"null"} and seen and seen.isdisjoint(expected[name]):
            rule = "safe_type_change" if safe_cast(expected[name] - {"null"}, seen) else "unsafe_type_change"
            out.append(("field_type_change", name, *POLICY[rule], None, None))
    return out


def verdict(issues: list[tuple]) -> str:
    if any(i[2] == "critical" or i[3] == "quarantine_record" for i in issues):
        return "failed"
    return "warning" if issues else "passed"


def drift_report(spark: SparkSession, expected: T.StructType, actual: T.StructType, policy: DriftPolicy = DriftPolicy()) -> DataFrame:
    return spark.createDataFrame(compare(declared(expected), declared(actual), policy), ISSUE)


# -- profiles ------------------------------------------------------------------------------------------


def profile(df: DataFrame) -> DataFrame:
    """column_name, type, rows, nulls, low, high, pattern of every column, in one aggregate.

    ``pattern``: the one all values share, else null.
    """
    aggregates: list[Column] = [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        numeric = isinstance(f.dataType, T.NumericType)
        low, high = (F.min(c).cast("double") + 0.0, F.max(c).cast("double") + 0.0) if numeric else (F.lit(None).cast("double"), F.lit(None).cast("double"))
        text = isinstance(f.dataType, T.StringType)
        kind = F.when(c.isNotNull(), F.coalesce(text_pattern(c), F.lit("none"))) if text else F.lit(None).cast("string")
        shared = F.when(F.min(kind) == F.max(kind), F.nullif(F.min(kind), F.lit("none")))
        aggregates += [F.count_if(c.isNull()).alias(f"z{i}"), low.alias(f"l{i}"), high.alias(f"h{i}"), shared.alias(f"p{i}")]
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"), F.lit(json_type_of(f.dataType)).alias("type"), F.col("n").alias("rows"), F.col(f"z{i}").alias("nulls"),
                F.col(f"l{i}").alias("low"), F.col(f"h{i}").alias("high"), F.col(f"p{i}").alias("pattern"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return df.agg(*aggregates).select(F.inline(rows))


# -- versions ------------------------------------------------------------------------------------------


def fingerprint(schema: T.StructType) -> str:
    """Twelve hex digits that any change of names, types or nullability changes."""
    text = json.dumps(sorted((f.name, f.dataType.simpleString(), f.nullable) for f in schema.fields))
    return hashlib.sha256(text.encode()).hexdigest()[:12]


class SchemaRegistry:
    """Numbered schema versions of data sets; the same schema again is no new version."""

    def __init__(self) -> None:
        self.versions: dict[str, list[tuple[str, T.StructType]]] = {}

    def register(self, dataset: str, schema: T.StructType) -> str:
        known = self.versions.setdefault(dataset, [])
        mark = fingerprint(schema)
        for label, _ in known:
            if label.endswith(mark):
                return label
        known.append((f"v{len(known) + 1}_{mark}", schema))
        return known[-1][0]

    def latest(self, dataset: str) -> tuple[str, T.StructType]:
        return self.versions[dataset][-1]

    def compare(self, dataset: str, first: int, second: int) -> dict[str, list[str]]:
        a, b = ({f.name for f in self.versions[dataset][n][1].fields} for n in (first, second))
        return {"added": sorted(b - a), "removed": sorted(a - b), "common": sorted(a & b)}


def breaking_changes(history: DataFrame) -> DataFrame:
    """dataset, captured_at, removed, newly_required of a history (dataset, captured_at, fields, required)."""
    w = Window.partitionBy("dataset").orderBy("captured_at")
    before = history.withColumn("_f", F.lag("fields").over(w)).withColumn("_r", F.lag("required").over(w)).filter("_f IS NOT NULL")
    changed = before.select("dataset", "captured_at", F.array_except("_f", "fields").alias("removed"), F.array_except("required", "_r").alias("newly_required"))
    return changed.filter((F.size("removed") > 0) | (F.size("newly_required") > 0))
