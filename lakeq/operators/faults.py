"""Fault injection into delimited lines, detection, scoring and repair.

Lines are rows (line_id, line). Which line gets which fault follows from seed and line id, so the
same seed gives the same faults on any partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fault -> what a detector should call it.
EXPECTED = {
    "missing_field": "field_count_mismatch",
    "extra_field": "field_count_mismatch",
    "type_error": "type_coercion_error",
    "null_required_field": "type_coercion_error",
    "invalid_format": "type_coercion_error",
    "duplicate_pk": "duplicate_primary_key",
    "outlier_value": "outlier_detected",
    "business_rule_violation": "business_rule_fail",
    "unit_changed": "semantic_anomaly",
    "timestamp_format_changed": "timestamp_parse_error",
    "timestamp_granularity_changed": "semantic_anomaly",
    "same_name_different_meaning": "semantic_anomaly",
    "different_business_definitions": "semantic_anomaly",
    "different_spatial_ref": "semantic_anomaly",
    "entity_id_ambiguity": "entity_resolution_problem",
    "cross_source_inconsistency": "cross_source_inconsistency",
    "fk_violation": "foreign_key_orphan",
}
FAULTS = list(EXPECTED)
# What the faults write.
BAD_NUMBER, NULL_TOKEN, BAD_DATE, SCALE = "NOT_A_NUMBER", "\\N", "NOT_A_DATE", 1_000_000
AMBIGUOUS, NO_PARENT, EXTRA, UNIT_FACTOR, DEFINITION_FACTOR = "_AMBIGUOUS", "-99999", "EXTRA001", 100, 1.5
#: Faults are dealt by (line id * STEP + seed) modulo the number of classes: the same on any partitioning and in SQL.
STEP = 7919


@dataclass(frozen=True)
class LineSpec:
    """Positions (from 0) in a line of ``width`` fields; ``stamp`` holds date and time, ``amount`` a price, ``net`` another one."""

    width: int
    number: int
    date: int
    amount: int
    key: tuple[int, ...]
    stamp: int
    text: int
    net: int
    delimiter: str = "|"


def _set(fields: Column, at: int, value: Column) -> Column:
    return F.transform(fields, lambda x, i: F.when(i == at, value).otherwise(x))


def fault_class(line_id: Column, every: int, seed: int) -> Column:
    """0 .. every * faults - 1; a class below the number of faults is that fault's."""
    return F.pmod(line_id * STEP + seed, F.lit(every * len(FAULTS)))


def inject(lines: DataFrame, spec: LineSpec, every: int, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(lines with faults, manifest). One line in ``every`` is hit; manifest: line_id, mutation_type, field, original_value, expected_detection."""
    names = F.array(*map(F.lit, FAULTS))
    h = fault_class(F.col("line_id"), every, seed)
    marked = lines.withColumn("_f", F.split("line", "\\" + spec.delimiter, -1)).withColumn("mutation_type", F.when(h < len(FAULTS), F.element_at(names, (h + 1).cast("int"))))
    f, kind = F.col("_f"), F.col("mutation_type")
    amount = F.get(f, spec.amount)
    price = amount.try_cast("decimal(20,2)")
    scaled = lambda by: (price * F.lit(by).cast("decimal(9,1)")).cast("decimal(28,2)").cast("string")
    #: fault -> (field, new value); those of the whole line stand below
    values = {
        "type_error": (spec.number, F.lit(BAD_NUMBER)), "null_required_field": (spec.number, F.lit(NULL_TOKEN)), "fk_violation": (spec.number, F.lit(NO_PARENT)),
        "invalid_format": (spec.date, F.lit(BAD_DATE)), "outlier_value": (spec.amount, scaled(SCALE)), "business_rule_violation": (spec.net, F.concat(F.lit("-"), F.get(f, spec.net))),
        "unit_changed": (spec.amount, scaled(UNIT_FACTOR)), "different_business_definitions": (spec.amount, scaled(DEFINITION_FACTOR)), "cross_source_inconsistency": (spec.amount, F.concat(F.lit("-"), amount)),
        "timestamp_format_changed": (spec.stamp, F.regexp_replace(F.get(f, spec.stamp), r"^(\d{4})-(\d{2})-(\d{2})", "$3/$2/$1")),
        "timestamp_granularity_changed": (spec.stamp, F.substring(F.get(f, spec.stamp), 1, 10)),
        "different_spatial_ref": (spec.text, F.concat(F.get(f, spec.text), F.lit(" EPSG:3857"))), "entity_id_ambiguity": (spec.key[0], F.concat(F.get(f, spec.key[0]), F.lit(AMBIGUOUS))),
    }
    swapped = _set(_set(f, spec.amount, F.get(f, spec.net)), spec.net, amount)
    changed = (
        F.when(kind == "missing_field", F.slice(f, 1, spec.width - 1)).when(kind == "extra_field", F.concat(f, F.array(F.lit(EXTRA)))).when(kind == "same_name_different_meaning", swapped)
    )
    at = F.when(kind == "missing_field", spec.width - 1).when(kind == "same_name_different_meaning", spec.amount)
    for name, (field, value) in values.items():
        changed = changed.when(kind == name, _set(f, field, value))
        at = at.when(kind == name, field)
    ready = marked.withColumn("_new", F.array_join(changed.otherwise(f), spec.delimiter)).withColumn("field", at)
    copies = F.when(kind == "duplicate_pk", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    bad = ready.select("line_id", F.explode(copies).alias("copy"), F.col("_new").alias("line"))
    expected = F.create_map(*[F.lit(x) for pair in EXPECTED.items() for x in pair])
    manifest = ready.filter(kind.isNotNull()).select("line_id", "mutation_type", "field", F.get(f, F.col("field")).alias("original_value"), F.try_element_at(expected, kind).alias("expected_detection"))
    return bad, manifest


def detect(lines: DataFrame, spec: LineSpec, limit: float, other_source: DataFrame, parents: DataFrame | None = None) -> DataFrame:
    """line_id, copy, error_type, field: the first finding of each line, the copies of a key after its first.

    ``other_source`` (line_id, amount): what another source says of the amounts. ``parents`` (key): the keys that the
    number field may refer to. Copies are found by one aggregate over the keys of lines without another finding.
    """
    split = lines.withColumn("_f", F.split("line", "\\" + spec.delimiter, -1)).join(other_source.select("line_id", F.col("amount").cast("decimal(20,2)").alias("_other")), "line_id", "left")
    if parents is not None:
        split = split.join(parents.select(F.col("key").cast("string").alias("_p")).distinct(), F.get("_f", spec.number) == F.col("_p"), "left")
    number, date, stamp, other = F.get("_f", spec.number), F.get("_f", spec.date), F.get("_f", spec.stamp), F.col("_other")
    value, net = F.get("_f", spec.amount).try_cast("decimal(28,2)"), F.get("_f", spec.net).try_cast("decimal(28,2)")
    ratio = F.try_divide(value.cast("double"), other.cast("double"))
    findings = [
        (F.size("_f") != spec.width, "field_count_mismatch", None),
        (F.get("_f", spec.key[0]).rlike(r"^\d+_\w+$"), "entity_resolution_problem", spec.key[0]),
        (number.try_cast("bigint").isNull(), "type_coercion_error", spec.number),
        (F.col("_p").isNull() if parents is not None else F.lit(False), "foreign_key_orphan", spec.number),
        (date.try_cast("date").isNull(), "type_coercion_error", spec.date),
        (stamp.rlike(r"^\d{2}/\d{2}/\d{4}"), "timestamp_parse_error", spec.stamp),
        (stamp.rlike(r"^\d{4}-\d{2}-\d{2}$"), "semantic_anomaly", spec.stamp),
        (F.get("_f", spec.text).rlike(r"EPSG:\d+$"), "semantic_anomaly", spec.text),
        (value.isNull(), "type_coercion_error", spec.amount),
        (net < 0, "business_rule_fail", spec.net),
        ((value >= limit) & (ratio.isNull() | (ratio >= SCALE / 100)), "outlier_detected", spec.amount),
        (ratio < 0, "cross_source_inconsistency", spec.amount),
        (F.abs(ratio - 1) > 0.001, "semantic_anomaly", spec.amount),
    ]
    which = F.lit(None).cast("int")
    for n in range(len(findings) - 1, -1, -1):
        which = F.when(findings[n][0], n).otherwise(which)
    table = F.array(*[F.struct(F.lit(kind).alias("error_type"), F.lit(at).cast("int").alias("field")) for _, kind, at in findings])
    keys = [F.get("_f", k) for k in spec.key]
    judged = split.select("line_id", "copy", which.alias("_which"), F.when(which.isNull(), F.concat_ws(spec.delimiter, *keys)).alias("_key"))
    own = judged.filter("_which IS NOT NULL").select("line_id", "copy", F.inline(F.array(F.get(table, F.col("_which")))))
    place = F.struct("line_id", "copy")
    many = judged.filter("_key IS NOT NULL").groupBy("_key").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    again = judged.select("line_id", "copy", "_key").join(many.select("_key", "_first"), "_key").filter(place != F.col("_first"))
    return own.unionByName(again.select("line_id", "copy", F.lit("duplicate_primary_key").alias("error_type"), F.lit(None).cast("int").alias("field")))


def match(manifest: DataFrame, detections: DataFrame) -> DataFrame:
    """line_id, error_type, injected, detected: one-to-one pairs by line and type, the level that line faults need.

    ``scoring.match`` has all levels (ids, fields, source) for faults that name no line.
    """
    m = manifest.select("line_id", F.col("expected_detection").alias("error_type")).groupBy("line_id", "error_type").agg(F.count(F.lit(1)).alias("m"))
    d = detections.groupBy("line_id", "error_type").agg(F.count(F.lit(1)).alias("d"))
    both = m.join(d, ["line_id", "error_type"], "full").na.fill(0, ["m", "d"])
    each = F.explode(F.sequence(F.lit(1), F.greatest("m", "d"))).alias("rn")
    return both.select("line_id", "error_type", "m", "d", each).select("line_id", "error_type", (F.col("rn") <= F.col("m")).alias("injected"), (F.col("rn") <= F.col("d")).alias("detected"))


def score(matched: DataFrame, *by: str) -> DataFrame:
    """tp, fp, fn, precision, recall, f1; 1 where nothing was to find or nothing was found."""
    counts = matched.groupBy(*by).agg(
        F.count_if(F.col("injected") & F.col("detected")).alias("tp"), F.count_if(~F.col("injected") & F.col("detected")).alias("fp"),
        F.count_if(F.col("injected") & ~F.col("detected")).alias("fn"),
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(1.0))
    rated = counts.withColumn("precision", F.round(ratio(F.col("tp"), F.col("tp") + F.col("fp")), 6)).withColumn("recall", F.round(ratio(F.col("tp"), F.col("tp") + F.col("fn")), 6))
    return rated.withColumn("f1", F.round(ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), 6))


def repair(bad: DataFrame, detections: DataFrame, manifest: DataFrame | None, spec: LineSpec) -> DataFrame:
    """line_id, line, strategy, confidence, outcome of every detected line.

    With the manifest originals are restored (0.9), copies dropped (0.95); without it values are derived:
    width cut or padded, tokens defaulted, outliers scaled back, signs turned, day first dates turned, suffixes cut. repaired from 0.8, candidate
    from 0.5, else unrecoverable; a dropped copy has a null line.
    """
    rows = detections.join(bad, ["line_id", "copy"])
    known = manifest.select("line_id", "original_value", F.col("field").alias("at")) if manifest is not None else rows.select("line_id").distinct().select("line_id", F.lit(None).cast("string").alias("original_value"), F.lit(None).cast("int").alias("at"))
    both = rows.join(known, "line_id", "left").withColumn("_f", F.split("line", "\\" + spec.delimiter, -1))
    f, size, kind, have = F.col("_f"), F.size("_f"), F.col("error_type"), F.col("original_value").isNotNull()
    amount, net, stamp = F.get(f, spec.amount), F.get(f, spec.net), F.get(f, spec.stamp)
    put_back = F.transform(f, lambda x, i: F.when(i == F.col("at"), F.col("original_value")).otherwise(x))
    digits = F.coalesce(F.nullif(F.regexp_replace(F.get(f, spec.number), r"[^0-9]", ""), F.lit("")), F.lit("0"))
    fixed = (
        F.when((kind == "field_count_mismatch") & (size > spec.width), F.slice(f, 1, spec.width))
        .when((kind == "field_count_mismatch") & have, F.array_insert(f, F.col("at") + 1, F.col("original_value")))
        .when(kind == "field_count_mismatch", F.concat(f, F.array(F.lit(""))))
        .when(have, put_back)
        .when(kind == "type_coercion_error", _set(f, spec.number, digits))
        .when(kind == "outlier_detected", _set(f, spec.amount, (amount.try_cast("decimal(28,2)") / SCALE).cast("decimal(20,2)").cast("string")))
        .when(kind == "business_rule_fail", _set(f, spec.net, F.abs(net.try_cast("decimal(28,2)")).cast("string")))
        .when(kind == "timestamp_parse_error", _set(f, spec.stamp, F.regexp_replace(stamp, r"^(\d{2})/(\d{2})/(\d{4})", "$3-$2-$1")))
        .when(kind == "entity_resolution_problem", _set(f, spec.key[0], F.regexp_extract(F.get(f, spec.key[0]), r"^\d+", 0)))
        .when((kind == "semantic_anomaly") & (F.col("field") == spec.text), _set(f, spec.text, F.regexp_replace(F.get(f, spec.text), r" EPSG:\d+$", "")))
    )
    confidence = (
        F.when(kind == "duplicate_primary_key", 0.95).when((kind == "field_count_mismatch") & (size > spec.width), 0.9).when(have, 0.9)
        .when(kind.isin("outlier_detected", "business_rule_fail"), 0.6).when(fixed.isNotNull(), 0.5).otherwise(0.0)
    )
    strategy = (
        F.when(kind == "duplicate_primary_key", "drop_copy").when((kind == "field_count_mismatch") & (size > spec.width), "drop_extra_field")
        .when(have, "restore_original").when(fixed.isNotNull(), "derive_value").otherwise("none")
    )
    outcome = F.when(confidence >= 0.8, "repaired").when(confidence >= 0.5, "candidate").otherwise("unrecoverable")
    return both.select("line_id", F.when(kind != "duplicate_primary_key", F.array_join(fixed, spec.delimiter)).alias("line"), strategy.alias("strategy"), confidence.alias("confidence"), outcome.alias("outcome"))
