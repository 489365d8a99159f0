"""The bronze gate as one plan: fix, coerce, check, compare schemas, gate, quarantine, publish; and the way back.

Rows are judged in one projection; the counts come from one aggregate beside the duplicates of the keys, which one
shuffle of the keys gives. Quarantined rows carry their content as JSON, so they can be repaired and judged again.

Defined cases: no rows pass with ratios 0; a contract without keys has no duplicates; columns that the contract does
not name stay strings; a column it names and the data lack is reported by the drift and is null in published rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeq.functions.scalars import default_value
from lakeq.operators import drift, governance, quality


@dataclass(frozen=True)
class Contract:
    """What a data set promises. ``kinds``: column -> JSON type."""

    dataset: str
    kinds: dict[str, str]
    required: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    rules: tuple[quality.Rule, ...] = ()
    downstream: tuple[str, ...] = ()
    timestamp: str | None = None
    max_age_hours: float = 24.0
    fill: dict[str, str] = field(default_factory=dict)
    rename: dict[str, str] = field(default_factory=dict)
    max_missing: float = 0.20
    max_duplicates: float = 0.05
    min_fresh: float = 0.8


@dataclass(frozen=True)
class Verdict:
    """published rows, quarantine rows, one row of metrics, and the issues of the schema."""

    published: DataFrame
    quarantine: DataFrame
    metrics: DataFrame
    issues: list[tuple]


def judge(df: DataFrame, contract: Contract) -> tuple[DataFrame, list[tuple]]:
    """(rows fixed and coerced with ``_reason``, issues of the schema)."""
    fixed = quality.auto_fix(df, contract.fill, contract.rename)
    lacking = [c for c in contract.kinds if c not in fixed.columns]
    policy = drift.DriftPolicy(required=frozenset(contract.required), keys=frozenset(contract.keys), downstream=frozenset(contract.downstream))
    expected = {c: {kind} for c, kind in contract.kinds.items()}
    # text columns of a bronze feed have no type of their own: only names can drift
    issues = drift.compare(expected, {c: expected.get(c, {"string"}) for c in fixed.columns}, policy)
    whole = fixed.select("*", *[F.lit(None).cast("string").alias(c) for c in lacking])
    typed = quality.coerce(whole.withColumn("_raw", F.struct("*")), contract.kinds)  # the quarantine keeps what was sent
    missing = [F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in contract.required]
    broken = [F.when(~r.passed(), r.name) for r in contract.rules if r.severity == "error"]
    reasons = F.array_compact(F.array(F.when(F.size("_parse_errors") > 0, F.get("_parse_errors", 0)), *missing, *broken))
    return typed.withColumn("_reason", F.get(reasons, 0)), issues


def validate(df: DataFrame, contract: Contract, reference: Column, batch: Column | None = None) -> Verdict:
    """The whole gate. Metrics: records, published, quarantined, missing, duplicates, fresh, violations, schema_valid, status."""
    judged, issues = judge(df, contract)
    data = [c for c in judged.columns if c not in ("_reason", "_parse_errors", "_raw")]
    bad = judged.filter("_reason IS NOT NULL")
    key = F.to_json(F.struct(*contract.keys)) if contract.keys else F.lit("")
    quarantine = governance.quarantine_records(bad.select("_raw.*", "_reason"), contract.dataset, "bronze", F.col("_reason"), key, F.lit(None) if batch is None else batch, reference)
    fresh = quality.freshness(F.col(contract.timestamp).cast("string").try_cast("timestamp"), reference, contract.max_age_hours) if contract.timestamp else F.lit(1.0)
    gone = quality.missing_ratio(judged, list(contract.required)) if contract.required else F.lit(0.0)
    counts = judged.agg(F.count(F.lit(1)).alias("records"), F.count("_reason").alias("quarantined"), gone.alias("missing"), fresh.alias("fresh"))
    repeated = quality.duplicate_summary(judged, list(contract.keys)).select(F.col("ratio").alias("duplicates")) if contract.keys else df.sparkSession.createDataFrame([(0.0,)], "duplicates double")
    both = counts.unionByName(repeated, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in ("records", "quarantined", "missing", "fresh", "duplicates")])
    valid = F.lit(drift.verdict(issues) != "failed")
    gates = quality.threshold_violations(F.col("missing"), F.col("duplicates"), F.col("fresh"), valid, contract.max_missing, contract.max_duplicates, contract.min_fresh)
    metrics = both.select(
        F.lit(contract.dataset).alias("dataset"), "records", (F.col("records") - F.col("quarantined")).alias("published"), "quarantined", "missing", "duplicates", "fresh",
        F.concat_ws(",", gates).alias("violations"), valid.alias("schema_valid"),
    ).withColumn("status", F.when(F.col("violations") != "", "failed").when(F.col("quarantined") > 0, "warning").otherwise("passed"))
    return Verdict(judged.filter("_reason IS NULL").select(*data), quarantine, metrics, issues)


def parsed_report(judged: DataFrame, reason: str = "_reason", columns: list[str] | None = None) -> DataFrame:
    """records, malformed, type_errors, status of judged raw lines (``parse_failures.parse_lines``) per source: any bad line fails it."""
    out = judged.groupBy("source_name").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col(reason).isin("broken_quoting", "field_count_mismatch")).alias("malformed"), F.count_if(F.col(reason) == "invalid_value").alias("type_errors")
    )
    return out.withColumn("status", F.when(F.col("malformed") + F.col("type_errors") > 0, "failed").otherwise("passed"))


# -- the way back --------------------------------------------------------------------------------------


def recover(quarantine: DataFrame, contract: Contract) -> DataFrame:
    """Quarantine rows with ``repaired`` (struct of texts), ``confidence`` and ``outcome``.

    Texts of the wrong type keep what is of the right one (0.5), lost required values get the default of their name
    (0.7, or 0.5 where that is empty); what breaks a rule stays as it is (0).
    """
    payload = T.StructType([T.StructField(c, T.StringType()) for c in contract.kinds])
    row = F.from_json("raw_payload", payload)
    opened = quarantine.withColumn("_row", row)
    values, worth = [], []
    for c, kind in contract.kinds.items():
        text = F.col(f"_row.{c}")
        digits = F.nullif(F.regexp_replace(text, r"[^0-9.\-]" if kind == "number" else r"[^0-9\-]", ""), F.lit(""))
        wrong = F.lit(False) if kind not in quality.COERCIONS or kind == "string" else text.isNotNull() & text.try_cast(quality.COERCIONS[kind]).isNull()
        lost = text.isNull() if c in contract.required else F.lit(False)
        values.append(F.when(wrong, F.coalesce(digits, F.lit("0"))).when(lost, default_value(c)).otherwise(text).alias(c))
        worth.append(F.when(wrong, 0.5).when(lost, F.when(default_value(c) == "", 0.5).otherwise(0.7)))
    least = F.array_min(F.array_compact(F.array(*worth, F.lit(None).cast("double"))))
    done = opened.withColumn("repaired", F.struct(*values)).withColumn("confidence", F.coalesce(least, F.lit(0.0))).drop("_row")
    return done.withColumn("outcome", F.when(F.col("confidence") >= 0.8, "repaired").when(F.col("confidence") >= 0.5, "candidate").otherwise("unrecoverable"))


def replay(recovered: DataFrame, contract: Contract, reference: Column, least: float = 0.5) -> Verdict:
    """The repaired rows through the gate again."""
    return validate(recovered.filter(F.col("confidence") >= least).select("repaired.*"), contract, reference)
