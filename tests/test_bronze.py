import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeq.operators import bronze, delivery, governance, quality, runs
from lakeq.sources.schema_store import SchemaStore
from tests.conftest import rows

CONTRACT = bronze.Contract(
    "t", {"id": "integer", "amount": "number", "name": "string"}, required=("id", "name"), keys=("id",), rules=(quality.Rule("positive", "amount", "in_range", params={"min": 0}),), max_missing=0.5, max_duplicates=0.5
)
RAW = "Id string, amount string, Name string, note string"


def now():
    return F.lit("2024-01-01").cast("timestamp")


def test_the_gate(spark):
    raw = spark.createDataFrame([("1", "5", " a ", "x"), ("1", "7.5", "b", None), ("x2", "1", "c", ""), ("3", "-1", "d", ""), ("4", "1", "", "")], RAW)
    verdict = bronze.validate(raw, CONTRACT, now())
    assert rows(verdict.published.select("id", "amount", "name")) == [(1, 5.0, "a"), (1, 7.5, "b")]
    assert [i[:2] for i in verdict.issues] == [("new_unknown_field", "note")]
    assert sorted(r.quarantine_reason for r in verdict.quarantine.collect()) == ["id: cannot convert 'x2' to integer", "name is missing", "positive"]
    m = verdict.metrics.first()
    assert (m.records, m.published, m.quarantined, m.schema_valid, m.status) == (5, 2, 3, True, "warning") and m.missing == 0.2 and m.duplicates == 0.2


def test_the_gate_without_rows_or_columns(spark):
    empty = bronze.validate(spark.createDataFrame([], RAW), CONTRACT, now()).metrics.first()
    assert (empty.records, empty.quarantined, empty.missing, empty.duplicates) == (0, 0, 0.0, 0.0)
    lacking = bronze.validate(spark.createDataFrame([("1",)], "id string"), CONTRACT, now()).metrics.first()
    assert lacking.status == "failed" and not lacking.schema_valid and "schema_invalid" in lacking.violations


def test_quarantine_comes_back(spark):
    raw = spark.createDataFrame([("x2", "1", "c", ""), ("3", "-1", "d", ""), ("4", "1", "", "")], RAW)
    recovered = bronze.recover(bronze.validate(raw, CONTRACT, now()).quarantine, CONTRACT)
    got = {r.repaired.id: (r.repaired.name, r.confidence, r.outcome) for r in recovered.collect()}
    assert got == {"2": ("c", 0.5, "candidate"), "3": ("d", 0.0, "unrecoverable"), "4": ("", 0.5, "candidate")}
    again = bronze.replay(recovered, CONTRACT, now())
    assert rows(again.published.select("id", "name")) == [(2, "c")] and again.metrics.first().quarantined == 1


def test_dead_letters_are_recorded_and_archived(spark):
    letters = governance.dlq_record(spark.createDataFrame([(1, None), (2, "b")], "id int, v string"), "s", F.lit("boom"), F.lit("2024-01-01").cast("timestamp"))
    assert letters.select("entry_id").distinct().count() == 2 and {r.payload for r in letters.collect()} == {'{"id":1,"v":null}', '{"id":2,"v":"b"}'}
    done = letters.withColumn("status", F.when(F.col("payload").contains("null"), "resolved").otherwise("pending"))
    kept, gone = governance.dlq_archive(done, F.lit("2024-03-01").cast("timestamp"), 30)
    assert (kept.count(), gone.count()) == (1, 1) and governance.dlq_archive(done, F.lit("2024-01-05").cast("timestamp"), 30)[1].count() == 0


def test_schemas_are_stored(spark, tmp_path):
    one, two = T.StructType([T.StructField("a", T.LongType())]), T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    store = SchemaStore(spark, str(tmp_path / "s"))
    first, second = store.register("d", one), store.register("d", two)
    assert store.register("d", one) == first and first.startswith("v1_") and second.startswith("v2_")
    store.approve("d", first)
    again = SchemaStore(spark, str(tmp_path / "s"))  # another process
    assert again.latest("d") == (second, two) and again.latest("d", approved=True) == (first, one)
    assert again.compare("d", first, second) == {"added": ["b"], "removed": [], "common": ["a"]}
    with pytest.raises(KeyError):
        again.approve("d", "v9_x")
    with pytest.raises(KeyError):
        again.latest("nothing")


def test_expectations_on_keys_of_several_columns(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    suite = [*quality.suite_of(["a"], ["a", "b"]), quality.Expectation("unique", "b"), quality.Expectation("unique", "zz")]
    got = {(r.expectation, r.column_name): r.unexpected for r in quality.expectation_suite(df, suite).collect()}
    assert got == {("row_count", ""): 0, ("exists", "a"): 0, ("not_null", "a"): 2, ("unique", "a+b"): 1, ("unique", "b"): 3, ("unique", "zz"): 1}


def test_json_schema_types_and_formats(spark):
    schema = {"properties": {"b": {"type": "boolean"}, "o": {"type": "object"}, "l": {"type": "array"}, "d": {"type": "string", "format": "date"}, "e": {"type": "string", "format": "email"}}}
    df = spark.createDataFrame([("true", '{"x":1}', "[1]", "2024-02-29", "a@b.c"), ("yes", "[1]", "{}", "2024-02-30", "ab"), (None, None, None, None, None)], "b string, o string, l string, d string, e string")
    assert {r.message: r.rows for r in quality.schema_errors(df, schema, most=None).collect()} == {"b is not of type boolean": 1, "o is not of type object": 1, "l is not of type array": 1, "d is no date": 1, "e is no email": 1}


def test_rules_from_a_file(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "r.yml").write_text("rules:\n  - {name: p, column: x, type: in_range, min: 1, severity: warning}\n  - {name: q, column: y, type: not_null}\n")
    a, b = quality.load_rules(str(tmp_path / "r.yml"))
    assert (a.kind, a.severity, a.params) == ("in_range", "warning", {"min": 1}) and (b.kind, b.severity) == ("not_null", "error")
    assert quality.normal_schema({"properties": {"My Col": {}}, "required": ["My Col"]}) == {"properties": {"my_col": {}}, "required": ["my_col"]}


def test_files_without_faults_and_empty_deliveries(spark):
    lines = spark.createDataFrame([("s", 1, f"f{n}", k, f"{n}|{k}|x") for n in range(3) for k in range(1, 6)], "source_name string, batch int, file string, line_no long, line string")
    listed = lines.groupBy("source_name", "batch", "file").agg(F.count(F.lit(1)).alias("lines"))
    assert delivery.detect_files(lines, listed, 3).count() == 0 and delivery.detect_files(lines.limit(0), listed.limit(0), 3).count() == 0
    assert rows(delivery.detect_files(lines.filter("file <> 'f1'"), listed, 3)) == [("s", "f1", "batch_not_found")]


def test_runs(spark):
    steps = [
        runs.Step("a", lambda t: spark.range(3)), runs.Step("b", lambda t: t["a"].filter("id > 0"), lambda t: {"none_above_1": t["b"].filter("id > 1")}),
        runs.Step("c", lambda t: t["missing"]), runs.Step("d", lambda t: t["a"]),
    ]
    tables, report = runs.run_steps(spark, steps, lambda _, df: df)
    assert [(r.step, r.rows, r.violations, r.status) for r in report.orderBy("position").collect()] == [("a", 3, 0, "valid"), ("b", 2, 1, "invalid"), ("c", None, None, "error"), ("d", None, None, "skipped")] and set(tables) == {"a", "b"}
    assert rows(runs.sample_k(spark.range(100).repartition(7), 5, 1, "id")) == rows(runs.sample_k(spark.range(100).coalesce(1), 5, 1, "id"))


def test_annotations_and_glossary(spark):
    schema = T.StructType([T.StructField("created_at", T.TimestampType()), T.StructField("fee_amount", T.DoubleType())])
    first = runs.annotate(spark, "d", schema, {"created_at": {"role": "timestamp", "description": "made", "confidence": 1.0}})
    assert rows(first.select("field", "role", "method")) == [("created_at", "timestamp", "template"), ("fee_amount", "monetary_amount", "name")]
    known = first.withColumn("description", F.lit("as reviewed"))
    assert {r.description for r in runs.annotate(spark, "d", schema, {}, known).collect()} == {"as reviewed"}
    assert rows(runs.glossary(first).select("term", "fields")) == [("monetary_amount", ["d.fee_amount"]), ("timestamp", ["d.created_at"])]
