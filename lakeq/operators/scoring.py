"""Scores of fault detection: one-to-one matching in three levels, rates, categories, one weighted figure."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeq.session import cut

FIELDS = ("source_name", "file", "line_id")
#: Rows of one key are numbered in this many parts.
PARTS = 256

# Category -> label, weight.
CATEGORIES = {
    "schema": ("Schema Issues", 0.20),
    "semantic": ("Semantic Issues", 0.15),
    "quality": ("Data Quality", 0.20),
    "heterogeneity": ("Source Heterogeneity", 0.10),
    "lineage": ("Lineage Issues", 0.15),
    "reliability": ("Reliability & Failure Handling", 0.20),
}
# Category -> its scenarios, by the error each shows.
SCENARIOS = {
    "schema": "missing_field extra_field downstream_field_removed field_renamed type_changed",
    "semantic": "same_name_different_meaning different_name_same_meaning unit_changed timestamp_format_changed timestamp_granularity_changed different_spatial_ref"
    " pre_aggregate_records different_business_definitions entity_id_ambiguity",
    "quality": "invalid_format outlier_value null_required_field duplicate_pk cross_source_inconsistency",
    "heterogeneity": "csv_to_json flat_to_nested mock_rest_adapter batch_frequency_mismatch split_batch_to_microfiles",
    "lineage": "suppress_lineage_emission suppress_transform_lineage corrupt_audit_run_id break_downstream_impact corrupt_quarantine_metadata split_emission_targets",
    "reliability": "simulate_api_failure rate_limit_partial_batch partial_file duplicate_batch atomic_write_failure batch_frequency_mismatch_outoforder poison_record",
}
# Least detection rate of a passed scenario; error -> mutation where the names differ.
PASS_RATE = 0.5
ERROR_OF = {
    "downstream_field_removed": "remove_downstream_field", "field_renamed": "rename_to_synonym", "type_changed": "type_error",
    "different_name_same_meaning": "rename_to_synonym", "batch_frequency_mismatch_outoforder": "batch_frequency_mismatch",
}


def catalog(spark: SparkSession) -> DataFrame:
    """category, label, weight, scenario, mutation_type of every scenario."""
    rows = [(c, *CATEGORIES[c], s, ERROR_OF.get(s, s)) for c, names in SCENARIOS.items() for s in names.split()]
    return spark.createDataFrame(rows, "category string, label string, weight double, scenario string, mutation_type string")


def numbered(df: DataFrame, keys: list[str], id_col: str, out: str = "rn") -> DataFrame:
    """Rows of each key numbered from 1, a hot key in parts: part sizes are prefix-summed, rows numbered within parts."""
    placed = df.withColumn("_part", F.pmod(F.xxhash64(id_col), F.lit(PARTS)))
    sizes = placed.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]) & (F.col("_part") == F.col("_p"))
    inner = Window.partitionBy(*keys, "_part").orderBy(id_col)
    return placed.join(before, same).withColumn(out, F.row_number().over(inner) + F.col("_before")).drop("_part", "_p", "_before", *[f"_{k}" for k in keys])


def _pair(faults: DataFrame, findings: DataFrame, keys: list[str]) -> DataFrame:
    """fault, finding: one to one by equal keys; which of several equals meet is fixed, but of no meaning."""
    left = numbered(faults, keys, "fault").select("fault", *keys, "rn")
    right = numbered(findings, keys, "finding").select("finding", *keys, "rn")
    return left.join(right, [*keys, "rn"]).select("fault", "finding")


def match(manifest: DataFrame, detections: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs fault-finding, faults left, findings left).

    Manifest: fault, mutation_id, error_type (expected), source_name, file, line_id, of which a null field matches
    anything. Detections: finding, mutation_id, error_type, source_name, file, line_id. Three levels, each over what
    the one before has left: by mutation_id; by error_type and the fields that the fault names, faults with more
    fields first; by error_type and source.
    """
    faults, findings = manifest, detections
    levels: list[tuple[Column | None, list[str]]] = [(F.col("mutation_id").isNotNull(), ["mutation_id"])]
    patterns = [[f for i, f in enumerate(FIELDS) if bits >> i & 1] for bits in range(2 ** len(FIELDS))]
    for named in sorted(patterns, key=len, reverse=True):
        is_pattern = reduce(lambda a, b: a & b, [F.col(f).isNotNull() if f in named else F.col(f).isNull() for f in FIELDS])
        levels.append((is_pattern, ["error_type", *named]))
    levels.append((F.col("source_name").isNotNull(), ["error_type", "source_name"]))
    there = manifest.agg(*[F.count_if(chosen).alias(f"n{i}") for i, (chosen, _) in enumerate(levels)]).first()  # one row: which levels are in use
    pairs = None
    for (chosen, keys), n in zip(levels, there):
        if not n:
            continue
        found = cut(_pair(faults.filter(chosen), findings, keys))
        pairs = found if pairs is None else pairs.unionByName(found)
        faults = cut(faults.join(found.select("fault"), "fault", "left_anti"))
        findings = cut(findings.join(found.select("finding"), "finding", "left_anti"))
    if pairs is None:  # no faults at all
        pairs = _pair(faults, findings, ["mutation_id"])
    return pairs, faults, findings


def rates(counts: DataFrame) -> DataFrame:
    """Adds detection_rate, precision, false_discovery_rate, leakage_rate, f1 to injected, tp, fp, fn (and skipped).

    Nothing injected counts as all found; skipped faults are no misses. Without findings precision is 0, or 1 where
    there was nothing to find.
    """
    total = F.col("tp") + F.col("fn")
    share = lambda a, b, none: F.round(F.coalesce(F.try_divide(a, b), none), 6)
    out = counts.withColumn("detection_rate", share(F.col("tp"), total, F.lit(1.0)))
    out = out.withColumn("precision", share(F.col("tp"), F.col("tp") + F.col("fp"), F.when(total == 0, 1.0).otherwise(0.0)))
    out = out.withColumn("false_discovery_rate", share(F.col("fp"), F.col("tp") + F.col("fp"), F.lit(0.0))).withColumn("leakage_rate", share(F.col("fn"), total, F.lit(0.0)))
    harmonic = F.try_divide(2 * F.col("precision") * F.col("detection_rate"), F.col("precision") + F.col("detection_rate"))
    none = F.when(total == 0, 1.0).otherwise(0.0)
    return out.withColumn("f1", F.round(F.when(F.col("tp") + F.col("fp") + F.col("fn") == 0, none).otherwise(F.coalesce(harmonic, F.lit(0.0))), 6))


def recovery_rates(repairs: DataFrame, *by: str) -> DataFrame:
    """attempted, repaired, candidates, lost and their shares, of outcomes repaired, candidate, unrecoverable."""
    counts = repairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("attempted"), F.count_if(F.col("outcome") == "repaired").alias("repaired"),
        F.count_if(F.col("outcome") == "candidate").alias("candidates"), F.count_if(F.col("outcome") == "unrecoverable").alias("lost"),
    )
    share = lambda c: F.round(F.coalesce(F.try_divide(c, "attempted"), F.lit(0.0)), 6)
    return counts.withColumns({"recovery_rate": share("repaired"), "candidate_rate": share("candidates"), "loss_rate": share("lost")})


def category_scores(scenarios: DataFrame) -> DataFrame:
    """category, weight, scenarios, passed, failed, skipped, averages over those not skipped, weighted_score.

    Scenarios: category, weight, detection_rate (null where skipped), precision, f1.
    """
    run = F.col("detection_rate").isNotNull()
    mean = lambda c: F.round(F.coalesce(F.avg(F.when(run, F.col(c))), F.lit(0.0)), 6)
    out = scenarios.groupBy("category", "weight").agg(
        F.count(F.lit(1)).alias("scenarios"), F.count_if(F.col("detection_rate") >= PASS_RATE).alias("passed"), F.count_if(F.col("detection_rate") < PASS_RATE).alias("failed"),
        F.count_if(~run).alias("skipped"), mean("detection_rate").alias("avg_detection_rate"), mean("precision").alias("avg_precision"), mean("f1").alias("avg_f1"),
    )
    return out.withColumn("weighted_score", F.round(F.col("avg_detection_rate") * F.col("weight"), 6))


def overall(categories: DataFrame) -> DataFrame:
    """scenarios, passed, overall_score: the categories' detection rates by weight."""
    return categories.agg(
        F.sum("scenarios").alias("scenarios"), F.sum("passed").alias("passed"), F.round(F.coalesce(F.try_divide(F.sum("weighted_score"), F.sum("weight")), F.lit(0.0)), 6).alias("overall_score")
    )
