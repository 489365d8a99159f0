"""Queries of fault injection, detection, scoring and repair, each with its SQL: what was injected is what must be found."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeq.operators import delivery, faults, scoring
from lakeq.plans.registry import Registry
from lakeq.session import cut, table

registry = Registry()
QUERIES, ORACLE, query = registry.queries, registry.sql, registry.query

# -- lines ---------------------------------------------------------------------------------------------

LINES = faults.LineSpec(width=8, number=2, date=5, amount=4, key=(0, 1), stamp=6, text=3, net=7)
LIMIT, EVERY, SEED = 1_000_000.0, 19, 42


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """The lines of a delivery, made once, with what another source says of their amounts."""
    rows = table(spark, d, "lineitem")
    first = rows.groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct("l_partkey", "l_returnflag", "l_extendedprice", "l_shipdate", "l_quantity")).alias("r"))
    price = F.col("r.l_extendedprice").cast("decimal(20,2)")
    fields = ["l_orderkey", "l_linenumber", "r.l_partkey", "r.l_returnflag", price, F.to_date("r.l_shipdate"), F.date_format("r.l_shipdate", "yyyy-MM-dd HH:mm:ss"), F.col("r.l_quantity").cast("decimal(20,2)")]
    return cut(first.select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("line_id"), F.concat_ws("|", *fields).alias("line"), price.alias("amount")))


def _found(spark: SparkSession, d: str, lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    bad, manifest = faults.inject(lines.select("line_id", "line"), LINES, EVERY, SEED)
    parents = table(spark, d, "part").select(F.col("p_partkey").alias("key"))
    return bad, manifest, faults.detect(bad, LINES, LIMIT, lines.select("line_id", "amount"), parents)


_CLASSES = (
    "WITH kinds(h, mutation_type, error_type) AS (VALUES " + ", ".join(f"({i}, '{k}', '{v}')" for i, (k, v) in enumerate(faults.EXPECTED.items())) + "),"
    " ids AS (SELECT DISTINCT l_orderkey * 100 + l_linenumber AS line_id FROM lineitem),"
    f" hit AS (SELECT line_id, mutation_type, error_type FROM ids JOIN kinds ON h = (line_id * {faults.STEP} + {SEED}) % {EVERY * len(faults.EXPECTED)})"
)


@query(_CLASSES + " SELECT error_type, count(*) AS tp, 0::BIGINT AS fp, 0::BIGINT AS fn, 1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1 FROM hit GROUP BY error_type")
def fault_scores(spark: SparkSession, d: str) -> DataFrame:
    _, manifest, found = _found(spark, d, _lines(spark, d))
    return faults.score(faults.match(manifest, found), "error_type")


@query(
    _CLASSES + " SELECT mutation_type, count(*) AS tp, 0::BIGINT AS fp, 0::BIGINT AS fn, 1.0::DOUBLE AS detection_rate, 1.0::DOUBLE AS precision, 0.0::DOUBLE AS false_discovery_rate, 0.0::DOUBLE AS leakage_rate, 1.0::DOUBLE AS f1"
    " FROM hit GROUP BY mutation_type"
)
def fault_detection_rates(spark: SparkSession, d: str) -> DataFrame:
    """Rates per mutation, by the three levels of matching."""
    _, manifest, found = _found(spark, d, _lines(spark, d))
    return scoring.rates(_mutation_counts(*_as_faults(manifest, found)))


def _as_faults(manifest: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    none = F.lit(None).cast("string")
    given = manifest.select(
        F.col("line_id").alias("fault"), none.alias("mutation_id"), F.col("expected_detection").alias("error_type"), F.lit("lineitem").alias("source_name"), none.alias("file"), "line_id", "mutation_type"
    )
    seen = found.select((F.col("line_id") * 2 + F.col("copy")).alias("finding"), none.alias("mutation_id"), "error_type", F.lit("lineitem").alias("source_name"), none.alias("file"), "line_id")
    return cut(given), cut(seen)


def _mutation_counts(manifest: DataFrame, findings: DataFrame) -> DataFrame:
    """mutation_type, tp, fp, fn; a finding without fault counts for the mutations that expect its type."""
    pairs, _, extra = scoring.match(manifest, findings)
    by_fault = manifest.join(pairs, "fault", "left").groupBy("mutation_type", "error_type").agg(F.count("finding").alias("tp"), F.count_if(F.col("finding").isNull()).alias("fn"))
    false = extra.groupBy("error_type").agg(F.count(F.lit(1)).alias("fp"))
    return by_fault.join(false, "error_type", "left").select("mutation_type", "tp", F.coalesce("fp", F.lit(0)).alias("fp"), "fn")


_RESTORED = "('missing_field', 'type_error', 'null_required_field', 'fk_violation', 'invalid_format', 'outlier_value', 'business_rule_violation', 'unit_changed', 'timestamp_format_changed', 'timestamp_granularity_changed', 'different_business_definitions', 'different_spatial_ref', 'entity_id_ambiguity', 'cross_source_inconsistency')"


@query(
    _CLASSES + ", r AS (SELECT CASE WHEN mutation_type = 'duplicate_pk' THEN 'drop_copy' WHEN mutation_type = 'extra_field' THEN 'drop_extra_field' ELSE 'restore_original' END AS strategy, mutation_type <> 'same_name_different_meaning' AS back FROM hit)"
    " SELECT strategy, 'repaired' AS outcome, count(*) AS lines, count(*) FILTER (back) AS as_before FROM r GROUP BY strategy"
)
def fault_recovery(spark: SparkSession, d: str) -> DataFrame:
    """Repairs with the manifest; a swap of two values keeps one wrong, since the manifest names one field."""
    lines = _lines(spark, d)
    bad, manifest, found = _found(spark, d, lines)
    back = faults.repair(bad, found, manifest, LINES).join(lines.select("line_id", F.col("line").alias("was")), "line_id")
    return back.groupBy("strategy", "outcome").agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("line").isNull() | (F.col("line") == F.col("was"))).alias("as_before"))


@query()
def fault_recovery_rates(spark: SparkSession, d: str) -> DataFrame:
    """What can be repaired from the data alone, per finding."""
    bad, _, found = _found(spark, d, _lines(spark, d))
    repaired = faults.repair(bad, found, None, LINES).join(found.select("line_id", "error_type").distinct(), "line_id")
    return scoring.recovery_rates(repaired, "error_type")


# -- files ---------------------------------------------------------------------------------------------

FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
FILES = 32
_FILE_PLAN = [(f"orders_{n:02d}", kind) for n, kind in enumerate(delivery.FILE_FAULTS)]


def _delivery(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Orders as the lines of numbered files, and the sender's list."""
    orders = table(spark, d, "orders").filter("o_orderkey IS NOT NULL")
    # a key's place among those of its file: keys are dense in no file, so places come from numbered rows
    text = F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(20,2)"), F.to_date("o_orderdate"))
    filed = orders.select("o_orderkey", F.format_string("orders_%02d", F.pmod("o_orderkey", F.lit(FILES))).alias("file"), text.alias("line"))
    placed = scoring.numbered(filed, ["file"], "o_orderkey", "line_no")
    lines = cut(placed.select(F.lit("orders").alias("source_name"), F.lit(1).alias("batch"), "file", F.col("line_no").cast("long").alias("line_no"), "line"))
    return lines, lines.groupBy("source_name", "batch", "file").agg(F.count(F.lit(1)).alias("lines"))


def _file_findings(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    lines, listed = _delivery(spark, d)
    plan = spark.createDataFrame(_FILE_PLAN, "file string, mutation_type string").join(listed.select("file", "lines"), "file")
    return plan, delivery.detect_files(delivery.inject_files(lines, plan, FIELDS), listed, len(FIELDS))


@query(
    "WITH plan(file, mutation_type, error_type) AS (VALUES " + ", ".join(f"('{f}', '{k}', '{delivery.FILE_FAULTS[k]}')" for f, k in _FILE_PLAN) + ")"
    f" SELECT file, mutation_type, error_type FROM plan WHERE file IN (SELECT DISTINCT 'orders_' || lpad(CAST(o_orderkey % {FILES} AS VARCHAR), 2, '0') FROM orders)"
)
def file_faults_found(spark: SparkSession, d: str) -> DataFrame:
    """Every finding about a file, beside what was injected there."""
    plan, found = _file_findings(spark, d)
    return found.join(plan, "file", "full").select("file", "mutation_type", "error_type")


# -- schemas, lineage, settings ------------------------------------------------------------------------


def _registered(spark: SparkSession, d: str) -> DataFrame:
    schema = table(spark, d, "feed_schema")
    return schema.select(F.col("source_name").alias("dataset"), F.col("field_name").alias("field"), F.col("field_type").alias("type"), F.coalesce("is_key", F.lit(False)).alias("required"), (~F.coalesce("is_key", F.lit(False))).alias("downstream"))


_SCHEMA_PLAN = {"trade": "add_unknown_field", "daily_market": "change_field_type", "cash_transaction": "remove_required_field", "holding_history": "remove_downstream_field", "account_update": "rename_to_synonym"}
#: The field that is hit: of the keys, or of the others, the first by name.
_PICKED = (
    "WITH f AS (SELECT source_name AS dataset, field_name AS field, field_type AS type, coalesce(is_key, false) AS k, row_number() OVER (PARTITION BY source_name, coalesce(is_key, false) ORDER BY field_name) AS n FROM feed_schema),"
    " plan(dataset, mutation_type) AS (VALUES " + ", ".join(f"('{s}', '{k}')" for s, k in _SCHEMA_PLAN.items()) + ")"
)


@query(
    _PICKED + " SELECT f.dataset, CASE WHEN mutation_type = 'add_unknown_field' THEN field || '_unknown' ELSE field END AS field,"
    " CASE mutation_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in delivery.SCHEMA_FAULTS.items()) + " END AS error_type"
    " FROM f JOIN plan ON plan.dataset = f.dataset WHERE n = 1 AND k = (mutation_type = 'remove_required_field')"
)
def schema_faults_found(spark: SparkSession, d: str) -> DataFrame:
    fields = _registered(spark, d)
    kinds = spark.createDataFrame(list(_SCHEMA_PLAN.items()), "dataset string, mutation_type string")
    wanted = fields.join(kinds, "dataset").filter(F.col("required") == (F.col("mutation_type") == "remove_required_field"))
    plan = wanted.groupBy("dataset", "mutation_type").agg(F.min("field").alias("field"))
    return delivery.detect_schema(fields, delivery.inject_schema(fields.select("dataset", "field", "type"), plan))


_LINEAGE_PLAN = [(f"dataset_{n}", kind) for n, kind in enumerate(delivery.LINEAGE_FAULTS)]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{s}', '{delivery.LINEAGE_FAULTS[k]}')" for s, k in _LINEAGE_PLAN) + ") t(dataset, error_type)")
def lineage_faults_found(spark: SparkSession, d: str) -> DataFrame:
    datasets = spark.range(12).select(F.concat(F.lit("dataset_"), F.col("id")).alias("dataset"))
    stages = F.explode(F.array(*map(F.lit, ("bronze", "silver", "gold")))).alias("stage")
    events = datasets.select("dataset", stages).select(F.concat(F.lit("run-"), "dataset").alias("run_id"), "dataset", "stage", F.lit("feed").alias("source_mapping"), F.lit("store").alias("emitted_to"), F.lit("q").alias("quarantine_ref"))
    plan = spark.createDataFrame(_LINEAGE_PLAN, "dataset string, mutation_type string")
    return delivery.detect_lineage(delivery.inject_lineage(events, plan), datasets)


@query(
    "WITH b AS (SELECT DISTINCT feed_code AS s, batchid AS b FROM daily_market WHERE feed_code IN ('NYA', 'LDN', 'TKY') AND batchid IS NOT NULL),"
    " x AS (SELECT s, b, min(b) OVER (PARTITION BY s) AS low, max(b) OVER (PARTITION BY s) AS high FROM b),"
    " sent AS (SELECT s, b, low, CASE WHEN s = 'TKY' AND b = high THEN -1 ELSE b END AS arrived FROM x WHERE NOT (s = 'LDN' AND b = low + 1)),"
    " j AS (SELECT s, b, b - lag(b) OVER w > 1 OR arrived < lag(arrived) OVER w AS wrong FROM sent WINDOW w AS (PARTITION BY s ORDER BY b))"
    " SELECT s AS source_name, b AS batch, 'batch_sequence_gap' AS error_type FROM j WHERE wrong"
    " UNION ALL SELECT s, b, 'duplicate_batch' FROM sent WHERE s = 'NYA' AND b = low + 1 UNION ALL SELECT 'DOWN', NULL, 'source_unavailable'"
)
def config_faults_found(spark: SparkSession, d: str) -> DataFrame:
    """Batches sent twice, left out and sent early, and a source that does not answer."""
    batches = table(spark, d, "daily_market").filter("feed_code IN ('NYA', 'LDN', 'TKY') AND batchid IS NOT NULL").groupBy(F.col("feed_code").alias("source_name"), F.col("batchid").alias("batch")).agg(F.lit(1).alias("one"))
    ends = batches.groupBy("source_name").agg(F.min("batch").alias("low"), F.max("batch").alias("high"))
    placed = batches.join(ends, "source_name").withColumn("arrived", F.when((F.col("source_name") == "TKY") & (F.col("batch") == F.col("high")), -1).otherwise(F.col("batch")))
    sent = placed.filter("NOT (source_name = 'LDN' AND batch = low + 1)")
    twice = F.when((F.col("source_name") == "NYA") & (F.col("batch") == F.col("low") + 1), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    gaps = delivery.batch_gaps(sent.select("source_name", "batch", "arrived", F.explode(twice).alias("copy")))
    calls = spark.createDataFrame([("DOWN", 503), ("DOWN", None), ("DOWN", 500), ("UP", 500), ("UP", 200), ("NEW", 500)], "source_name string, status_code int")
    return gaps.unionByName(delivery.unavailable(calls).select("source_name", F.lit(None).cast("long").alias("batch"), "error_type"))


@query()
def scenario_report(spark: SparkSession, d: str) -> DataFrame:
    """Categories of scenarios by what the detectors found of every mutation, and the weighted whole."""
    _, manifest, found = _found(spark, d, _lines(spark, d))
    rates = scoring.rates(_mutation_counts(*_as_faults(manifest, found))).select("mutation_type", "detection_rate", "precision", "f1")
    plan, files = _file_findings(spark, d)
    one = lambda df, hit: df.groupBy("mutation_type").agg(F.avg(hit.cast("double")).alias("detection_rate"), F.lit(1.0).alias("precision"), F.avg(hit.cast("double")).alias("f1"))
    expected = lambda names: F.try_element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("mutation_type"))
    by_file = one(plan.join(files, "file", "left"), F.coalesce(F.col("error_type") == expected(delivery.FILE_FAULTS), F.lit(False)))
    kinds = spark.createDataFrame(list(_SCHEMA_PLAN.items()), "dataset string, mutation_type string")
    by_schema = one(kinds.join(schema_faults_found(spark, d), "dataset", "left"), F.coalesce(F.col("error_type") == expected(delivery.SCHEMA_FAULTS), F.lit(False)))
    lineage = spark.createDataFrame(_LINEAGE_PLAN, "dataset string, mutation_type string")
    by_lineage = one(lineage.join(lineage_faults_found(spark, d), "dataset", "left"), F.coalesce(F.col("error_type") == expected(delivery.LINEAGE_FAULTS), F.lit(False)))
    settings = config_faults_found(spark, d).select(F.when(F.col("error_type") == "source_unavailable", "simulate_api_failure").otherwise("batch_frequency_mismatch").alias("mutation_type"))
    by_setting = one(settings, F.lit(True))
    known = rates.unionByName(by_file).unionByName(by_schema).unionByName(by_lineage).unionByName(by_setting)
    best = known.groupBy("mutation_type").agg(F.max("detection_rate").alias("detection_rate"), F.min("precision").alias("precision"), F.max("f1").alias("f1"))
    return scoring.category_scores(scoring.catalog(spark).join(best, "mutation_type", "left"))


@query("SELECT 37::BIGINT AS scenarios, 37::BIGINT AS passed, 1.0::DOUBLE AS overall_score")
def scenario_score(spark: SparkSession, d: str) -> DataFrame:
    return scoring.overall(scenario_report(spark, d))
