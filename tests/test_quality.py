import random

import pytest
from pyspark.sql import functions as F

from lakeq.functions import scalars, units
from lakeq.operators import drift, entity, faults, governance, medallion, quality, scoring, windows
from tests.conftest import rows


def one(df):
    return df.first()[0]


def test_ratios(spark):
    df = spark.createDataFrame([(1, "A"), (2, "")], "id int, name string")
    assert one(df.agg(quality.missing_ratio(df, ["id", "name"]))) == 0.25
    assert one(df.limit(0).agg(quality.missing_ratio(df, ["id"]))) == 0.0
    keys = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert abs(quality.duplicate_summary(keys, ["id"]).first().ratio - 1 / 3) < 1e-12
    assert quality.duplicate_summary(keys.limit(0), ["id"]).first().ratio == 0.0
    assert one(spark.range(1).select(quality.readiness(F.lit(0.0), F.lit(0.0), F.lit(True), F.lit(1.0)))) == 1.0
    assert one(spark.range(1).select(quality.readiness(F.lit(1.0), F.lit(1.0), F.lit(False), F.lit(0.0)))) == 0.0


def test_freshness_counts_the_future_and_not_the_missing(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2025-01-01 00:00:00",), (None,), ("2023-01-01 00:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    assert one(df.agg(quality.freshness(F.col("t"), F.lit("2024-01-01 12:00:00").cast("timestamp"), 24))) == 0.5


def test_gate_and_coercion(spark):
    bad = spark.range(1).select(quality.threshold_violations(F.lit(0.5), F.lit(0.5), F.lit(0.0), F.lit(True), 0.0, 0.0, 1.0))
    assert one(bad) == ["missing_ratio", "duplicate_ratio", "freshness_score"]
    df = spark.createDataFrame([("2", "x"), ("high", None)], "severity string, note string")
    out = quality.coerce(df, {"severity": "integer"}).collect()
    assert [r.severity for r in out] == [2, None] and [r._parse_errors for r in out] == [[], ["severity: cannot convert 'high' to integer"]]
    assert rows(quality.schema_errors(df, {"properties": {"severity": {"type": "integer"}}, "required": ["severity"], "additionalProperties": False})) == [("note is unexpected", 2), ("severity is not of type integer", 1)]


def test_rules(spark):
    df = spark.createDataFrame([(1, "a", 5), (None, "", 50), (3, "b1", None)], "id int, s string, v int")
    rules = [quality.Rule("there", "s", "not_null"), quality.Rule("range", "v", "in_range", params={"min": 1, "max": 10}), quality.Rule("form", "s", "regex", "warning", {"pattern": "[a-z]$"})]
    assert {r.rule: r.failed for r in quality.evaluate_rules(df, rules).collect()} == {"there": 1, "range": 1, "form": 1}
    assert [r.failed_rules for r in quality.failing_rows(df, rules).collect()] == [["there", "range"]]


def test_auto_fix_merges_and_fills(spark):
    df = spark.createDataFrame([(" Ada ", "", None, "Bob"), (None, "ops", None, "Bob")], "` Full Name ` string, Department string, dept string, full_name string")
    out = quality.auto_fix(df, {"department": "unknown"}, {"dept": "department"})
    assert [tuple(r) for r in out.collect()] == [("Ada", "unknown"), ("Bob", "ops")]
    counts = quality.auto_fix_counters(df.select(" Full Name ", "Department").limit(1), {"department": "unknown"}).first()
    assert tuple(counts) == (1, 1, 1, 1)


def test_names():
    assert [scalars.clean_name(n) for n in ("Start_Time", "Distance(mi)", " Full Name ")] == ["start_time", "distance_mi", "full_name"]


def test_scalar_columns(spark):
    df = spark.createDataFrame([("https://u:secret@h/x?token=abc&b=1", " YES ", "Acme, Inc. "), (None, "n", None)], "url string, flag string, name string")
    out = df.select(scalars.masked(F.col("url")), scalars.source_bool(F.col("flag")), scalars.json_bool(F.col("flag")), scalars.audit_bool(F.col("flag")), scalars.entity_text(F.col("name")), scalars.json_integer(F.lit("2.0")), scalars.json_integer(F.lit("2.5")))
    assert [tuple(r) for r in out.collect()] == [("https://u:***@h/x?token=***&b=1", True, True, True, "acme inc", 2, None), (None, None, False, False, "", 2, None)]


def test_units(spark):
    given = [("µg/m³", "concentration"), ("mph", "speed"), ("Fahrenheit", "temperature"), ("ppm", "concentration"), ("furlong", "distance"), ("Meters", "distance")]
    expect = [(50.0, "ug/m3"), (80.4672, "km/h"), (10.0, "celsius"), (None, "ug/m3"), (None, None), (0.05, "km")]
    for (unit, dimension), (value, canonical) in zip(given, expect):
        r = units.convert(spark.createDataFrame([("50", unit)], "v string, u string"), "v", "u", dimension).first()
        assert (r.converted, r.canonical_unit) == (value, canonical)


def test_metric_grammar():
    assert [m.column_name() for m in medallion.parse_metrics("count:*,sum:fee,avg:tax,min:a,max:b,anything")] == ["record_count", "total_fee", "avg_tax", "min_a", "max_b", "record_count"]
    with pytest.raises(ValueError):
        medallion.parse_metrics("median:x")


def test_drift_policy():
    expected = {"id": {"integer"}, "event_time": {"string"}, "speed": {"number"}, "status": {"string"}}
    actual = {"id": {"integer"}, "event_timestamp": {"string"}, "speed": {"object"}, "new_col": {"string"}}
    issues = drift.compare(expected, actual, drift.DriftPolicy(required=frozenset({"id"}), downstream=frozenset({"status"}), aliases=(("event_time", "event_timestamp"),)))
    assert [(i[0], i[1]) for i in issues] == [("field_rename_candidate", "event_time"), ("dropped_downstream_field", "status"), ("new_unknown_field", "event_timestamp"), ("new_unknown_field", "new_col"), ("field_type_change", "speed")]
    assert drift.verdict(issues) == "failed"
    extra = drift.compare({"id": {"integer"}}, {"id": {"integer"}, "x": {"string"}})
    assert drift.verdict(extra) == "warning" and drift.verdict([]) == "passed"


def test_schema_versions(spark):
    registry = drift.SchemaRegistry()
    a, b = spark.range(1).schema, spark.range(1).withColumn("x", F.lit("1")).schema
    first = registry.register("t", a)
    assert registry.register("t", a) == first and first.startswith("v1_") and registry.register("t", b).startswith("v2_")
    assert registry.compare("t", 0, 1) == {"added": ["x"], "removed": [], "common": ["id"]}
    history = spark.createDataFrame([("d", 1, ["a", "b"], ["a"]), ("d", 2, ["a"], ["a"]), ("d", 3, ["a", "c"], ["a", "c"]), ("d", 4, ["a", "c", "e"], ["a", "c"])], "dataset string, captured_at int, fields array<string>, required array<string>")
    assert [(r.captured_at, r.removed, r.newly_required) for r in drift.breaking_changes(history).orderBy("captured_at").collect()] == [(2, ["b"], []), (3, [], ["c"])]


def test_scores_that_fall(spark):
    df = spark.createDataFrame([(0, 0.98), (1, 0.96), (2, 0.60)], "n int, s double")
    assert [(r.n, r.fall) for r in windows.drops(df, "n", "s", 0.2).collect()] == [(2, 0.36)]


def test_entities(spark):
    df = spark.createDataFrame([(1, "Acme, Inc."), (2, "acme inc"), (3, "Acme Incorp"), (4, "Zenith Works"), (5, "Zenith Work"), (6, None), (7, "")], "id long, name string")
    ids = {r.source_entity_id: r for r in entity.resolve_exact(df, "company", "s", "id", [], ["name"]).collect()}
    assert ids["1"].canonical_entity_id == ids["2"].canonical_entity_id != ids["3"].canonical_entity_id and ids["6"].match_method == "new_entity" and ids["6"].canonical_entity_id != ids["7"].canonical_entity_id
    classes = {r.id: (r.class_id, r.links) for r in entity.fuzzy_classes(df, "id", "name", 0.8).collect()}
    assert classes == {1: (1, 1), 2: (1, 1), 3: (1, 1), 4: (4, 1), 5: (4, 1), 6: (6, 0), 7: (7, 0)}


def test_clusters_of_a_chain(spark):
    nodes = spark.range(40).toDF("n")
    edges = spark.createDataFrame([(i, i + 1) for i in range(19)] + [(30, 31)], "a long, b long")
    out = {r.node: r.cluster for r in entity.clusters(nodes, edges).collect()}
    assert all(out[i] == 0 for i in range(20)) and out[31] == 30 and out[35] == 35


def test_clusters_keep_their_size_estimate_short(spark):
    order = list(range(20))
    random.Random(4).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")
    out = entity.clusters(spark.range(21).toDF("n"), edges)
    assert {r.node: r.cluster for r in out.collect()} == {n: 0 for n in range(20)} | {20: 20}
    assert out._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 10**100


def test_pieces_of_texts_are_not_broadcast(spark, tmp_path):
    """A table that looks small has many pieces, which the driver must not hold."""
    spark.createDataFrame([(1, "Zenith Works"), (2, "Zenith Work"), (3, "Acme")], "id long, name string").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    for plan in (entity.similar_texts(df, "id", "name"), entity.fuzzy_classes(df, "id", "name")):
        assert "Broadcast" not in plan._jdf.queryExecution().executedPlan().toString()


def ratios(texts, threshold):
    from difflib import SequenceMatcher

    best = lambda x, y: max(SequenceMatcher(None, x, y).ratio(), SequenceMatcher(None, y, x).ratio())
    return {(i, j) for i, x in enumerate(texts) for j, y in enumerate(texts) if i < j and x != y and best(x, y) >= threshold}


@pytest.mark.parametrize("threshold", [0.7, 0.82, 0.88])
def test_no_alike_texts_are_lost(spark, threshold):
    rng = random.Random(int(threshold * 100))
    names = ["zenithworks", "zenithwork", "acme holdings", "acmee holdingz", "ab", "abc", "a"]
    for _ in range(120):
        base = rng.choice(names[:4]) if rng.random() < 0.3 else "".join(rng.choice("abcde ") for _ in range(rng.randint(1, 18)))
        letters = list(base)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(letters) + 1)
            letters[at : at + rng.randint(0, 1)] = rng.choice(["x", "", "a"])
        names.append("".join(letters))
    texts = sorted({" ".join(n.split()) for n in names} - {""})
    df = spark.createDataFrame(list(enumerate(texts)), "id long, name string")
    assert {(r.a, r.b) for r in entity.similar_texts(df, "id", "name", threshold).collect()} == ratios(texts, threshold)


def test_entity_tiers(spark):
    df = spark.createDataFrame([(1, "T1", "acme holdings", 1.0, 1.0), (2, None, "zenithworks", 5.0, 5.0), (3, None, "zenithwork", 5.0, 5.0), (4, None, "zenithwurk", 60.0, 5.0), (5, None, "other", None, None)], "id long, tax string, name string, lat double, lon double")
    got = {r.source_entity_id: r for r in entity.resolve(df, "company", "s", "id", ["tax"], [], "name", ("lat", "lon")).collect()}
    assert [got[str(n)].match_method for n in (1, 2, 3, 5)] == ["exact", "fuzzy", "fuzzy", "new_entity"]
    assert got["2"].canonical_entity_id == got["3"].canonical_entity_id != got["4"].canonical_entity_id


def test_faults_come_back(spark):
    spec = faults.LineSpec(width=6, number=1, date=2, amount=3, key=(0,), stamp=4, text=5, net=1)
    clean = "|100|2024-01-01|7.50|2024-01-01 10:00:00|x"
    lines = spark.createDataFrame([(n, f"{n}{clean}") for n in (1, 2, 3, 4)], "line_id long, line string")
    bad = spark.createDataFrame(
        [(1, 0, f"1{clean}".replace("|100|", "|NOT_A_NUMBER|")), (2, 0, f"2{clean}|EXTRA001"), (3, 0, f"3{clean}"), (3, 1, f"3{clean}"), (4, 0, f"4{clean}".replace("2024-01-01 10", "01/01/2024 10"))],
        "line_id long, copy int, line string",
    )
    manifest = spark.createDataFrame(
        [(1, "type_error", 1, "100", "type_coercion_error"), (2, "extra_field", None, None, "field_count_mismatch"), (3, "duplicate_pk", None, None, "duplicate_primary_key"), (4, "timestamp_format_changed", 4, "2024-01-01 10:00:00", "timestamp_parse_error")],
        "line_id long, mutation_type string, field int, original_value string, expected_detection string",
    )
    found = faults.detect(bad, spec, 1e6, lines.select("line_id", F.lit(7.5).alias("amount")))
    assert rows(faults.score(faults.match(manifest, found)).select("tp", "fp", "fn")) == [(4, 0, 0)]
    was = {r.line_id: r.line for r in lines.collect()}
    fixed = {r.line_id: r for r in faults.repair(bad, found, manifest, spec).collect()}
    assert {r.outcome for r in fixed.values()} == {"repaired"} and all(fixed[n].line == was[n] for n in (1, 2, 4)) and fixed[3].line is None
    alone = {r.line_id: r for r in faults.repair(bad, found, None, spec).collect()}
    assert (alone[1].outcome, alone[4].outcome, alone[4].line) == ("candidate", "candidate", was[4])


def test_matching_takes_ids_then_fields_then_sources(spark):
    manifest = spark.createDataFrame(
        [(1, "m1", "a", "s", "f", 1), (2, None, "a", "s", "f", 2), (3, None, "a", "s", None, None), (4, None, "a", "s", "g", 9), (5, None, "b", "s", None, None)],
        "fault long, mutation_id string, error_type string, source_name string, file string, line_id long",
    )
    found = spark.createDataFrame(
        [(1, "m1", "z", "t", None, None), (2, None, "a", "s", "f", 2), (3, None, "a", "s", "h", 3), (4, None, "a", "s", "h", 4), (5, None, "c", "s", None, None)],
        "finding long, mutation_id string, error_type string, source_name string, file string, line_id long",
    )
    pairs, missed, false = scoring.match(manifest, found)
    got = rows(pairs)
    assert got[:2] == [(1, 1), (2, 2)] and sorted(b for _, b in got) == [1, 2, 3, 4] and [a for a, _ in got] == [1, 2, 3, 4] and rows(missed.select("fault")) == [(5,)] and rows(false.select("finding")) == [(5,)]


def test_numbering_one_hot_key(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    got = scoring.numbered(df, ["k"], "id")
    assert got.filter("k = 'hot'").select("rn").distinct().count() == 2000 and got.filter("k = 'hot'").agg(F.max("rn")).first()[0] == 2000 and got.filter("k <> 'hot' AND rn <> 1").count() == 0


def test_units_are_parsed(spark):
    said = {"Micrograms per cubic meter": "ug/m3", "\u00b5g/m\u00b3": "ug/m3", "ug / m^3": "ug/m3", "kilometres per hour": "km/h", "kmh": "km/h", "meters per second": "m/s", "Miles": "mi", "metres": "m", "\u00b0C": "c", "ppm": "ppm", "": "", None: ""}
    got = spark.createDataFrame([(k,) for k in said], "u string").select(units.unit_key(F.col("u"))).collect()
    assert [r[0] for r in got] == list(said.values())


def test_names_tell_types_defaults_and_intervals(spark):
    assert [scalars.semantic_type(n) for n in ("customer_sk", "trade_id", "last_name", "email1", "trade_date", "fee_amount", "quantity", "is_flag", "zz")] == ["foreign_key", "identifier", "person_name", "email", "temporal", "monetary_amount", "quantity", "categorical", "unknown"]
    got = spark.range(1).select(*[scalars.default_value(n).alias(n) for n in ("pk_x", "trade_dts", "dm_volume", "has_cash", "note")]).first()
    assert (got[0], got[2], got[3], got[4]) == ("0", "0", "false", "") and len(got[1]) == 19
    assert [scalars.humanised_frequency(s) for s in (0, 30, 900, 7200, 2 * 86400, 21 * 86400, 90 * 86400, 800 * 86400)] == ["on_demand", "every_30s", "every_15m", "every_2h", "every_2d", "every_3w", "every_3mo", "every_2y"]
    row = spark.createDataFrame([("UTC", "n/a", "2024-01-05T10:00:00", "2023-01-01")], "timezone string, event_time string, updated_at_date string, date string")
    assert row.select(scalars.first_timestamp(row.columns)).first()[0] == "2024-01-05T10:00:00"
    templates = {"id": {"role": "identifier"}, "created_at": {"role": "timestamp"}}
    assert scalars.template_annotation("CREATED_AT", templates)["role"] == "timestamp" and scalars.template_annotation("grid", templates)["role"] == "identifier" and scalars.template_annotation("zz", templates) is None


def test_dead_letters(spark):
    waits = [r[0] for r in spark.range(1, 9).select(governance.backoff_seconds(F.col("id"))).collect()]
    assert waits == [1, 2, 4, 8, 16, 32, 60, 60]
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    dlq = spark.createDataFrame([("a", "s", "pending", 0, 1), ("b", "s", "pending", 2, 0), ("c", "s", "resolved", 1, 2)], "entry_id string, source string, status string, attempts int, captured_at int").withColumn("next_retry", F.lit(None).cast("timestamp"))
    assert [r.entry_id for r in governance.dlq_due(dlq, now).collect()] == ["b", "a"]
    after = {r.entry_id: (r.status, r.attempts) for r in governance.dlq_after(dlq.filter("status = 'pending'"), F.col("entry_id") == "zzz", now).collect()}
    assert after == {"a": ("pending", 1), "b": ("exhausted", 3)}


def test_decisions(spark):
    base = dict(status="passed", violations=0, schema_valid=True, breaking=False, missing=0.0, duplicates=0.0, fresh=1.0, quarantined=0, records=10)
    cases = [({}, "PASS"), ({"status": "failed"}, "FAIL"), ({"schema_valid": False}, "FAIL"), ({"breaking": True}, "FAIL"), ({"missing": 0.2}, "WARNING"), ({"quarantined": 3}, "WARNING"), ({"quarantined": 10}, "FAIL")]
    df = spark.createDataFrame([tuple((base | c).values()) for c, _ in cases], list(base))
    assert [r.decision for r in governance.decide(df).collect()] == [d for _, d in cases]


def test_access():
    assert governance.may_read("admin", "ops", "x") and governance.may_read("public", "gold", "m") and not governance.may_read("public", "silver", "m") and not governance.may_read("nobody", "gold", "m")
    assert not governance.may_read("r", "gold", "secret", (governance.Grant("r", ("*",), ("secret",)),))


def test_watermarks_never_go_back(spark):
    old, new = spark.createDataFrame([("a", 5), ("b", 9)], "s string, watermark int"), spark.createDataFrame([("a", 7), ("b", 3), ("c", 1)], "s string, watermark int")
    assert rows(governance.advance(old, new, "s")) == [("a", 7), ("b", 9), ("c", 1)]


def test_nested_records_flatten(spark):
    df = spark.createDataFrame([((("Oslo",), [(1,), (2,)]),)], "a struct<address:struct<city:string>,items:array<struct<n:int>>>")
    assert medallion.flatten_nested(df).columns == ["a_address_city", "a_items_n", "a_items_count"] and tuple(medallion.flatten_nested(df).first()) == ("Oslo", 1, 2)
