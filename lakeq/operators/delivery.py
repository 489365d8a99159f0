"""Faults of whole deliveries: files, schemas, lineage and source settings, with detectors that see the data alone.

A delivery is a table of lines (source_name, batch, file, line_no, line) and the sender's list of its files
(source_name, batch, file, lines). Faults are table-driven: which file gets which fault is a table (file,
mutation_type), so one projection injects all of them, and one aggregate per file finds them.

Defined cases: null lines count as lines without fields; files without lines exist only in the list; empty tables
give no findings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Mutation -> what a detector should call it.
FILE_FAULTS = {
    "csv_to_json": "format_mismatch",
    "flat_to_nested": "format_mismatch",
    "split_batch_to_microfiles": "format_mismatch",
    "mock_rest_adapter": "format_mismatch",
    "partial_file": "incomplete_batch",
    "atomic_write_failure": "incomplete_batch",
    "duplicate_batch": "retry_duplicate",
    "poison_record": "parser_exception",
    "missing_batch": "batch_not_found",
    "rate_limit_partial_batch": "row_count_mismatch",
    "pre_aggregate_records": "semantic_anomaly",
}
SCHEMA_FAULTS = {
    "remove_required_field": "missing_required_field",
    "change_field_type": "field_type_change",
    "add_unknown_field": "field_count_mismatch",
    "remove_downstream_field": "dropped_downstream_field",
    "rename_to_synonym": "field_rename_candidate",
}
LINEAGE_FAULTS = {
    "suppress_lineage_emission": "lineage_gap",
    "suppress_transform_lineage": "lineage_gap",
    "break_downstream_impact": "lineage_gap",
    "remove_source_mapping": "lineage_gap",
    "corrupt_audit_run_id": "run_id_mismatch",
    "corrupt_quarantine_metadata": "quarantine_metadata_invalid",
    "split_emission_targets": "lineage_duplication",
}
CONFIG_FAULTS = {"simulate_api_failure": "source_unavailable", "double_delivery": "duplicate_batch", "skip_batch": "batch_sequence_gap", "out_of_order": "batch_sequence_gap"}
SENTINEL, POISON = "__WRITE_IN_PROGRESS__", "\x00\x01POISON"
MICROFILES = 5


# -- files ---------------------------------------------------------------------------------------------


def inject_files(lines: DataFrame, plan: DataFrame, fields: list[str], delimiter: str = "|") -> DataFrame:
    """``lines`` with the faults of ``plan`` (file, mutation_type, lines; bounded by the number of files named)."""
    hit = lines.join(plan.select("file", "mutation_type", F.col("lines").alias("_n")), "file", "left")
    kind, part, n = F.col("mutation_type"), F.split("line", "\\" + delimiter, -1), F.col("_n")
    flat = F.to_json(F.map_from_arrays(F.array(*map(F.lit, fields)), F.slice(part, 1, len(fields))))
    nested = F.to_json(F.struct(F.struct(*[F.get(part, i).alias(f) for i, f in enumerate(fields[:1])]).alias("key"), F.struct(*[F.get(part, i + 1).alias(f) for i, f in enumerate(fields[1:])]).alias("body")))
    page = F.concat(F.lit('{"results":['), flat, F.lit(f'],"next":null}}'))
    kept = (
        F.when(kind == "missing_batch", False).when(kind.isin("partial_file"), F.col("line_no") <= F.ceil(n * 0.5)).when(kind == "atomic_write_failure", F.col("line_no") <= F.ceil(n * 0.6))
        .when(kind == "rate_limit_partial_batch", F.col("line_no") <= F.ceil(n * 0.4)).when(kind == "pre_aggregate_records", F.col("line_no") % 4 == 1).otherwise(True)
    )
    last = F.col("line_no") == F.when(kind == "partial_file", F.ceil(n * 0.5)).when(kind == "atomic_write_failure", F.ceil(n * 0.6))
    text = (
        F.when(kind == "csv_to_json", flat).when(kind == "flat_to_nested", nested).when(kind == "mock_rest_adapter", page)
        .when((kind == "partial_file") & last, F.substring_index("line", delimiter, 2)).when((kind == "atomic_write_failure") & last, F.lit(SENTINEL))
        .when((kind == "poison_record") & (F.col("line_no") == 2), F.lit(POISON)).otherwise(F.col("line"))
    )
    names = (
        F.when(kind == "duplicate_batch", F.array(F.col("file"), F.concat("file", F.lit(".retry"))))
        .when(kind == "split_batch_to_microfiles", F.array(F.concat("file", F.lit(".part"), (F.col("line_no") % MICROFILES).cast("string"))))
        .otherwise(F.array("file"))
    )
    return hit.filter(kept).select("source_name", "batch", F.explode(names).alias("file"), "line_no", text.alias("line"))


def file_facts(lines: DataFrame, width: int, delimiter: str = "|") -> DataFrame:
    """Per file: what detectors look at, in one aggregate. The checksum is a sum, so the order of lines is free."""
    fields = F.size(F.split(F.coalesce("line", F.lit("")), "\\" + delimiter, -1))
    is_json = F.coalesce(F.col("line").startswith("{"), F.lit(False))
    return lines.groupBy("source_name", "batch", "file").agg(
        F.count(F.lit(1)).alias("found"), F.count_if(is_json).alias("json"), F.count_if(is_json & F.col("line").contains('":{')).alias("nested"),
        F.count_if(F.col("line") == SENTINEL).alias("sentinels"), F.count_if(F.col("line").rlike("[\\x00-\\x08]")).alias("control"),
        F.max_by(fields, "line_no").alias("last_fields"), F.sum(F.xxhash64("line").cast("decimal(38,0)")).alias("checksum"),
        F.max("line_no").alias("last_no"),
    ).withColumn("short", (F.col("last_fields") < width) & (F.col("json") == 0) & (F.col("sentinels") == 0))


def detect_files(lines: DataFrame, listed: DataFrame, width: int, delimiter: str = "|") -> DataFrame:
    """source_name, file, error_type: the faults of files, against the sender's list (source_name, batch, file, lines)."""
    facts = file_facts(lines, width, delimiter)
    base = F.regexp_replace("file", r"\.(retry|part\d+)$", "")
    seen = facts.withColumn("base", base)
    sent = listed.select(F.col("file").alias("base"), "lines", F.col("source_name").alias("_source"))
    both = seen.join(sent, "base", "full")
    # a copy has the checksum of the file it repeats; a microfile is one of several under the listed name
    copies = seen.groupBy("base", "checksum", "found").agg(F.count(F.lit(1)).alias("same")).filter("same > 1")
    marked = both.join(copies.select("base", "checksum", F.col("same")), ["base", "checksum"], "left")
    unlisted = F.col("file") != F.col("base")
    kind: Column = (
        F.when(F.col("file").isNull(), "batch_not_found")
        .when(unlisted & F.col("same").isNotNull(), "retry_duplicate")
        .when(unlisted | (F.col("json") > 0), "format_mismatch")
        .when(F.col("control") > 0, "parser_exception")
        .when((F.col("sentinels") > 0) | F.col("short"), "incomplete_batch")
        .when((F.col("found") < F.col("lines") * 0.9) & (F.col("last_no") > F.col("found")), "semantic_anomaly")
        .when(F.col("found") != F.col("lines"), "row_count_mismatch")
    )
    found = marked.select(F.coalesce("source_name", "_source").alias("source_name"), F.col("base").alias("file"), kind.alias("error_type")).filter("error_type IS NOT NULL")
    return found.distinct()


# -- batches and sources -------------------------------------------------------------------------------


def batch_gaps(arrivals: DataFrame) -> DataFrame:
    """source_name, batch, error_type of (source_name, batch, arrived): doubles, holes, and batches before their turn."""
    from pyspark.sql import Window

    counted = arrivals.groupBy("source_name", "batch").agg(F.count(F.lit(1)).alias("n"), F.min("arrived").alias("at"))
    w = Window.partitionBy("source_name").orderBy("batch")
    judged = counted.withColumn("gap", F.col("batch") - F.lag("batch").over(w) > 1).withColumn("early", F.col("at") < F.lag("at").over(w))
    kinds = F.array_compact(F.array(F.when(F.col("n") > 1, "duplicate_batch"), F.when(F.col("gap") | F.col("early"), "batch_sequence_gap")))
    return judged.select("source_name", "batch", F.explode(kinds).alias("error_type"))


def unavailable(health: DataFrame, after: int = 3) -> DataFrame:
    """source_name, error_type of sources whose calls (source_name, status_code) failed at least ``after`` times and never worked."""
    works = F.col("status_code").between(200, 299)
    counted = health.groupBy("source_name").agg(F.count_if(works).alias("ok"), F.count_if(~F.coalesce(works, F.lit(False))).alias("failed"))
    return counted.filter((F.col("ok") == 0) & (F.col("failed") >= after)).select("source_name", F.lit("source_unavailable").alias("error_type"))


# -- schemas -------------------------------------------------------------------------------------------


def detect_schema(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """dataset, field, error_type of (dataset, field, type, required, downstream) against (dataset, field, type).

    A field that vanished while one unknown field of its type came, and only one of each, may have been renamed.
    """
    joined = expected.join(actual.withColumnRenamed("type", "actual_type"), ["dataset", "field"], "full")
    gone, new = F.col("actual_type").isNull(), F.col("type").isNull()
    by_type = joined.filter(gone | new).groupBy("dataset", F.coalesce("type", "actual_type").alias("kind")).agg(
        F.count_if(gone).alias("lost"), F.count_if(new).alias("came"), F.max(F.when(gone, F.col("field"))).alias("was"), F.max(F.when(new, F.col("field"))).alias("field")
    )
    renamed = by_type.filter("lost = 1 AND came = 1").select("dataset", "was", F.col("field").alias("now"))
    rest = joined.join(renamed, (joined["dataset"] == renamed["dataset"]) & joined["field"].isin(renamed["was"], renamed["now"]), "left_anti")
    kind = (
        F.when(gone & F.coalesce("required", F.lit(False)), "missing_required_field").when(gone & F.coalesce("downstream", F.lit(False)), "dropped_downstream_field")
        .when(new, "field_count_mismatch").when(~gone & (F.col("type") != F.col("actual_type")), "field_type_change")
    )
    plain = rest.select("dataset", "field", kind.alias("error_type")).filter("error_type IS NOT NULL")
    return plain.unionByName(renamed.select("dataset", F.col("was").alias("field"), F.lit("field_rename_candidate").alias("error_type")))


def inject_schema(fields: DataFrame, plan: DataFrame) -> DataFrame:
    """(dataset, field, type) of a registered schema after the faults of ``plan`` (dataset, field, mutation_type)."""
    hit = fields.join(plan, ["dataset", "field"], "left")
    kind = F.col("mutation_type")
    kept = hit.filter(~F.coalesce(kind.isin("remove_required_field", "remove_downstream_field"), F.lit(False)))
    changed = kept.select(
        "dataset", F.when(kind == "rename_to_synonym", F.concat("field", F.lit("_value"))).otherwise(F.col("field")).alias("field"),
        F.when(kind == "change_field_type", F.when(F.col("type") == "string", "integer").otherwise("string")).otherwise(F.col("type")).alias("type"), kind.alias("_k"),
    )
    added = changed.filter("_k = 'add_unknown_field'").select("dataset", F.concat("field", F.lit("_unknown")).alias("field"), F.lit("boolean").alias("type"))
    return changed.drop("_k").unionByName(added)


# -- lineage -------------------------------------------------------------------------------------------


def inject_lineage(events: DataFrame, plan: DataFrame) -> DataFrame:
    """Lineage events (run_id, dataset, stage, source_mapping, emitted_to, quarantine_ref) with the faults of ``plan`` (dataset, mutation_type)."""
    hit = events.join(plan, "dataset", "left")
    kind, stage = F.col("mutation_type"), F.col("stage")
    lost = {"suppress_lineage_emission": "bronze", "suppress_transform_lineage": "silver", "break_downstream_impact": "gold"}
    drop = F.lit(False)
    for name, at in lost.items():
        drop = drop | ((kind == name) & (stage == at))
    kept = hit.filter(~F.coalesce(drop, F.lit(False)))
    targets = F.when(kind == "split_emission_targets", F.array("emitted_to", F.lit("second_target"))).otherwise(F.array("emitted_to"))
    return kept.select(
        F.when((kind == "corrupt_audit_run_id") & (stage == "silver"), F.concat(F.lit("corrupt-"), "run_id")).otherwise(F.col("run_id")).alias("run_id"), "dataset", "stage",
        F.when((kind == "remove_source_mapping") & (stage == "bronze"), None).otherwise(F.col("source_mapping")).alias("source_mapping"), F.explode(targets).alias("emitted_to"),
        F.when(kind == "corrupt_quarantine_metadata", F.lit("")).otherwise(F.col("quarantine_ref")).alias("quarantine_ref"),
    )


def detect_lineage(events: DataFrame, datasets: DataFrame, stages: tuple[str, ...] = ("bronze", "silver", "gold")) -> DataFrame:
    """dataset, error_type: stages without event, mappings lost, run ids that differ, one event at several targets."""
    per = events.groupBy("dataset").agg(
        F.count_distinct("stage").alias("stages"), F.count_distinct("run_id").alias("runs"), F.count_distinct("emitted_to").alias("targets"),
        F.count_if((F.col("stage") == stages[0]) & F.col("source_mapping").isNull()).alias("unmapped"), F.count_if(F.col("quarantine_ref") == "").alias("untraced"),
    )
    judged = datasets.select("dataset").distinct().join(per, "dataset", "left")
    kinds = F.array_compact(
        F.array(
            F.when((F.coalesce("stages", F.lit(0)) < len(stages)) | (F.col("unmapped") > 0), "lineage_gap"), F.when(F.col("runs") > 1, "run_id_mismatch"),
            F.when(F.col("untraced") > 0, "quarantine_metadata_invalid"), F.when(F.col("targets") > 1, "lineage_duplication"),
        )
    )
    return judged.select("dataset", F.explode(kinds).alias("error_type"))
