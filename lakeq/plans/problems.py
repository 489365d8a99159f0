"""Queries of the general data problems (p1-p5), with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeq.operators import bronze, feed_drift, history, orphans, parse_failures, timestamps
from lakeq.session import bounded_rows, cut, table

CUSTOMER_ATTRIBUTES = [
    "taxid", "status", "lastname", "firstname", "middleinitial", "gender", "tier", "dob", "email", "phone1", "phone2", "phone3",
    "address1", "address2", "postalcode", "city", "state_prov", "country", "c_credit_score",
]
#: The sources of the raw lines.
RAW_SOURCES = ("account_update", "cash_transaction", "daily_market", "holding_history", "hr", "prospect", "trade", "watch_history")
ACCOUNT_ATTRIBUTES = ["status", "accountdesc", "taxstatus"]
REFERENCES = [
    orphans.Reference("dim_account", "sk_accountid", "sk_customerid", "dim_customer", "sk_customerid"),
    orphans.Reference("dim_account", "sk_accountid", "sk_brokerid", "dim_broker", "sk_brokerid"),
    orphans.Reference("dim_security", "sk_securityid", "sk_companyid", "dim_company", "sk_companyid"),
]


# -- 1: rows that fail to parse ------------------------------------------------------------------------


def _judged(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    layouts = table(spark, d, "source_layouts")
    return parse_failures.parse_lines(table(spark, d, "raw_lines"), layouts), layouts


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return parse_failures.failures(_judged(spark, d)[0]).distinct()


def p1_typed(source: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        judged, layouts = _judged(spark, d)
        return parse_failures.typed_records(judged, layouts, source)

    return query


def p1_error_counts(spark: SparkSession, d: str) -> DataFrame:
    return _judged(spark, d)[0].groupBy("source_name").agg(
        F.count(F.lit(1)).alias("records"),
        *[F.count_if(F.col("_reason") == r).alias(r) for r in (parse_failures.BROKEN, parse_failures.COUNT, parse_failures.VALUE)],
    )


def p1_load_counts(spark: SparkSession, d: str) -> DataFrame:
    """Per source: records, and what becomes of them; loaded rows are counted after typing."""
    judged, layouts = _judged(spark, d)
    failed = judged.groupBy("source_name").agg(F.count(F.lit(1)).alias("records"), F.count("_reason").alias("failed"))
    loaded = None
    for source in sorted(parse_failures.layouts_of(layouts)):
        one = parse_failures.typed_records(judged, layouts, source).agg(F.count(F.lit(1)).alias("loaded")).select(F.lit(source).alias("source_name"), "loaded")
        loaded = one if loaded is None else loaded.unionByName(one)
    return failed.join(loaded, "source_name", "left").select("source_name", "records", F.coalesce("loaded", F.lit(0)).alias("loaded"), "failed")


def p1_source_report(spark: SparkSession, d: str) -> DataFrame:
    """Records, malformed lines, lines with a wrong value and the status of every source."""
    return bronze.parsed_report(_judged(spark, d)[0])


def p1_assembled(spark: SparkSession, d: str) -> DataFrame:
    """The files rebuilt from their physical lines: records assembled per file and judged, per source."""
    physical = table(spark, d, "raw_lines").select(
        "source_file", "source_name", "delimiter", "record_number", "line_id", F.posexplode(F.split("raw_line", "\n", -1)).alias("part", "line")
    )
    layouts = table(spark, d, "source_layouts")
    records = parse_failures.assembled(physical, layouts, ["record_number", "line_id", "part"])
    return parse_failures.parse_lines(records, layouts, "record_number").groupBy("source_name").agg(
        F.count(F.lit(1)).alias("records"),
        *[F.count_if(F.col("_reason") == r).alias(r) for r in (parse_failures.BROKEN, parse_failures.COUNT, parse_failures.VALUE)],
    )


#: Delimiters the SQL knows; a file with another one would show as a difference.
_DELIMITERS = ("|", ",", ";", "\t", "~", "^", ":")


def _lines_sql() -> str:
    """line_id, source_name, fields (quotes kept), closed: the records by regular expressions."""
    parts = []
    for mark in _DELIMITERS:
        d = {"|": "\\|", "^": "\\^"}.get(mark, mark)
        field = f'"(?:[^"]|"")*"|[^"{d}][^{d}]*|'
        text = f"chr({ord(mark)})"
        parts.append(
            f"SELECT line_id, source_name, regexp_extract_all(line || {text}, '(?s)({field}){d}', 1) AS fields, regexp_full_match(line, '(?s)(?:{field})(?:{d}(?:{field}))*') AS closed"
            f" FROM lines WHERE delimiter = {text} AND trim(replace(line, {text}, ''), blanks) <> ''"
        )
    return (
        "WITH lines AS (SELECT line_id, source_name, delimiter, chr(32)||chr(9)||chr(10)||chr(13) AS blanks, CASE WHEN ends_with(raw_line, chr(13)) THEN left(raw_line, length(raw_line) - 1) ELSE raw_line END AS line FROM raw_lines),"
        f" records AS ({' UNION ALL '.join(parts)}),"
        " layouts AS (SELECT source_name, list(value_type ORDER BY col_no) AS kinds FROM (SELECT DISTINCT source_name, col_no, value_type FROM source_layouts) GROUP BY source_name),"
        " pieces AS (SELECT line_id, unnest(fields) AS raw, unnest(kinds) AS kind FROM records JOIN layouts USING (source_name) WHERE closed AND len(fields) = len(kinds)),"
        " vals AS (SELECT line_id, kind, CASE WHEN starts_with(raw, '\"') THEN replace(raw[2:-2], '\"\"', '\"') ELSE raw END AS x, trim(x, chr(32)||chr(9)||chr(10)||chr(13)) AS t FROM pieces),"
        " wrong AS (SELECT DISTINCT line_id FROM vals WHERE CASE WHEN kind = 'string' THEN contains(x, chr(65533)) WHEN t = '' THEN false"
        " WHEN kind = 'integer' THEN NOT regexp_full_match(t, '[+-]?[0-9]+') OR TRY_CAST(t AS BIGINT) IS NULL"
        " WHEN kind = 'decimal' THEN NOT regexp_full_match(t, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)')"
        " WHEN kind = 'date' THEN NOT regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}') OR TRY_CAST(t AS DATE) IS NULL"
        " ELSE NOT regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2} ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]') OR TRY_CAST(t AS TIMESTAMP) IS NULL END),"
        " judged AS (SELECT r.line_id, r.source_name, CASE WHEN NOT closed THEN 'broken_quoting' WHEN len(fields) <> coalesce(len(kinds), 0) THEN 'field_count_mismatch' WHEN w.line_id IS NOT NULL THEN 'invalid_value' END AS reason"
        " FROM records r LEFT JOIN layouts USING (source_name) LEFT JOIN wrong w ON w.line_id = r.line_id)"
    )


_P1_JUDGED = _lines_sql()


# -- 2: references to records that do not exist --------------------------------------------------------


def _references(spark: SparkSession, d: str) -> DataFrame:
    rows = None
    for ref in REFERENCES:
        part = orphans.references(table(spark, d, ref.child_table), ref)
        rows = part if rows is None else rows.unionByName(part)
    return rows


def _orphan_rows(spark: SparkSession, d: str) -> DataFrame:
    parents = {r.parent_table: (table(spark, d, r.parent_table), r.parent_key) for r in REFERENCES}
    return orphans.find_orphans(_references(spark, d), parents, table(spark, d, "key_deletions"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphan_rows(spark, d).select("child_table", "child_sk", "fk_column").distinct()


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphan rows per table, column and batch."""
    return _orphan_rows(spark, d).groupBy("child_table", "fk_column", F.col("period").alias("batchid")).agg(
        F.count(F.lit(1)).alias("orphan_rows"), F.count_distinct("key").alias("orphan_keys")
    )


def p2_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Orphan keys per parent table and batch, from a ledger that takes one batch after the other."""
    references, deletions = _references(spark, d), table(spark, d, "key_deletions")
    stored, reports = spark.createDataFrame([], orphans.LEDGER), None
    # a driver loop over the calendar of batches, which is metadata; each turn reads the deltas of its batch only
    for batch in sorted(int(r[0]) for r in bounded_rows(table(spark, d, "batch_dates").select("batchid").distinct(), history.MAX_SNAPSHOTS, "batch_dates")):
        deltas = orphans.reference_deltas(references.filter(F.col("period") == batch))
        deltas = deltas.unionByName(orphans.deletion_deltas(deletions.filter(F.col("deleted_batchid") == batch)))
        for ref in REFERENCES:
            delivered = table(spark, d, ref.parent_table).filter(F.col("batchid") == batch)
            deltas = deltas.unionByName(orphans.delivery_deltas(delivered, ref.parent_table, ref.parent_key, batch))
        stored = cut(orphans.advance(stored, deltas, batch))
        now = orphans.orphan_keys(stored.filter(F.col("period") == batch)).groupBy("parent_table", F.col("period").alias("batchid")).agg(
            F.count(F.lit(1)).alias("orphan_keys"), F.sum("refs").alias("orphan_rows")
        )
        reports = now if reports is None else reports.unionByName(now)
    return reports


_P2_ROWS = " UNION ALL ".join(
    f"SELECT '{r.child_table}' AS child_table, '{r.parent_table}' AS parent_table, c.{r.child_key} AS child_sk, '{r.column}' AS fk_column, c.batchid AS batchid, c.{r.column} AS k"
    f" FROM {r.child_table} c WHERE c.{r.column} IS NOT NULL AND c.{r.column} <> 0"
    f" AND (NOT EXISTS (SELECT 1 FROM {r.parent_table} p WHERE p.{r.parent_key} = c.{r.column} AND p.batchid <= c.batchid)"
    f" OR EXISTS (SELECT 1 FROM key_deletions x WHERE x.parent_table = '{r.parent_table}' AND x.sk_value = c.{r.column}"
    " AND x.deleted_batchid <= c.batchid AND (x.restored_batchid IS NULL OR x.restored_batchid > c.batchid)))"
    for r in REFERENCES
)


# -- 3: schemas that drift between files ---------------------------------------------------------------


def _drift(spark: SparkSession, d: str) -> feed_drift.Drift:
    return feed_drift.Drift(table(spark, d, "feed_records"), table(spark, d, "feed_schema"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _drift(spark, d).changes().select("file_name", "change_kind", "field_name", "candidate_field").distinct()


def p3_change_log(spark: SparkSession, d: str) -> DataFrame:
    """Every change, with the file's place in its channel, in that order."""
    return _drift(spark, d).change_log()


def p3_union_schema(spark: SparkSession, d: str) -> DataFrame:
    return _drift(spark, d).union_schema()


def p3_table(source: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        return _drift(spark, d).table(source)

    return query


# -- 4: mixed timestamp formats and time zones ---------------------------------------------------------


def _stamped(spark: SparkSession, d: str) -> DataFrame:
    trade = timestamps.source_rows(table(spark, d, "trade"), "trade", "trade_dts", "instant")
    return trade.unionByName(timestamps.source_rows(table(spark, d, "daily_market"), "daily_market", "dm_date", "date"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    spelled = timestamps.normalise_spelled(_stamped(spark, d), table(spark, d, "feed_zones"))
    return spelled.filter("norm <> text").select("src_table", "rec_id", "norm").distinct()


def p4_formats(spark: SparkSession, d: str) -> DataFrame:
    """Rows per table and format read, the unreadable ones under null."""
    return timestamps.normalise(_stamped(spark, d), table(spark, d, "feed_zones")).groupBy("src_table", "fmt").agg(
        F.count(F.lit(1)).alias("rows"), F.count("norm").alias("read"), F.min("norm").alias("first_norm"), F.max("norm").alias("last_norm")
    )


def _hidden_orders(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(slash dates as the path reads them where no feed registers an order, feeds with their order)."""
    zones = table(spark, d, "feed_zones")
    hidden = zones.withColumn("day_first", F.lit(None).cast("boolean"))
    read = timestamps.normalise_spelled(_stamped(spark, d), hidden).filter("fmt IN ('day/month', 'month/day')")
    return read, zones.select(F.col("feed_code").alias("feed"), "day_first").distinct()


def p4_unregistered(spark: SparkSession, d: str) -> DataFrame:
    """The order of day and month as the path finds it where no feed registers one."""
    return _hidden_orders(spark, d)[0].groupBy("src_table", "fmt").agg(F.count(F.lit(1)).alias("rows"))


def p4_path_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """Slash dates that both orders read: how many the path reads as registered, with the registration hidden from it."""
    read, orders = _hidden_orders(spark, d)
    part = lambda n: F.regexp_extract("text", r"^\s*(\d{1,2})[/-](\d{1,2})", n).try_cast("int")
    open_ = read.filter((part(1) <= 12) & (part(2) <= 12) & (part(1) != part(2))).join(F.broadcast(orders), "feed")
    right = (F.col("fmt") == "day/month") == F.col("day_first")
    return open_.groupBy("src_table").agg(F.count(F.lit(1)).alias("open_dates"), F.count_if(right).alias("as_registered"), (F.count_if(right) / F.count(F.lit(1))).alias("accuracy"))


# -- 5: history of changing entity attributes ----------------------------------------------------------


def _customers(spark: SparkSession, d: str) -> DataFrame:
    return history.change_history(table(spark, d, "dim_customer"), "dim_customer", "customerid", CUSTOMER_ATTRIBUTES, rank=("batchid", "sk_customerid"))


def _accounts(spark: SparkSession, d: str) -> DataFrame:
    return history.snapshot_history(
        table(spark, d, "dim_account"), "dim_account", "accountid", ACCOUNT_ATTRIBUTES, table(spark, d, "batch_dates"), rank="sk_accountid"
    )


def p5_customer_versions(spark: SparkSession, d: str) -> DataFrame:
    """The customer dimension rebuilt: attributes, batch, effectivedate, enddate and iscurrent of each version."""
    carry = (*CUSTOMER_ATTRIBUTES, "batchid")
    versions = history.change_history(table(spark, d, "dim_customer"), "dim_customer", "customerid", CUSTOMER_ATTRIBUTES, rank=("batchid", "sk_customerid"), carry=carry)
    return history.full_versions(versions, carry)


def p5_account_versions(spark: SparkSession, d: str) -> DataFrame:
    carry = (*ACCOUNT_ATTRIBUTES, "batchid")
    versions = history.snapshot_history(
        table(spark, d, "dim_account"), "dim_account", "accountid", ACCOUNT_ATTRIBUTES, table(spark, d, "batch_dates"), rank="sk_accountid", carry=carry
    )
    return history.full_versions(versions, carry)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _customers(spark, d).unionByName(_accounts(spark, d)).drop("state").distinct()


def p5_current(spark: SparkSession, d: str) -> DataFrame:
    """Per entity: versions, first date, and whether a version is still open."""
    versions = _customers(spark, d).unionByName(_accounts(spark, d))
    return versions.groupBy("entity", "entity_key").agg(
        F.count(F.lit(1)).alias("versions"), F.min("valid_from").alias("first_from"), F.max(F.col("valid_to") == history.OPEN_END).alias("iscurrent")
    )


def _state_sql(columns: list[str]) -> str:
    return "concat_ws(chr(31), " + ", ".join(f"coalesce(lower(trim(CAST({c} AS VARCHAR), chr(32)||chr(9)||chr(13)||chr(10))), '')" for c in columns) + ")"


_P5_VERSIONS = f"""
WITH c AS (
  SELECT *, customerid AS k, effectivedate AS f, {_state_sql(CUSTOMER_ATTRIBUTES)} AS s,
         row_number() OVER (PARTITION BY customerid, effectivedate ORDER BY batchid DESC, sk_customerid DESC) AS rn
  FROM dim_customer WHERE customerid IS NOT NULL AND effectivedate IS NOT NULL),
cc AS (SELECT *, lag(s) OVER (PARTITION BY k ORDER BY f) AS before FROM c WHERE rn = 1),
cv AS (SELECT k, f FROM cc WHERE before IS NULL OR before <> s),
b AS (SELECT batchid, batch_date, row_number() OVER (ORDER BY batchid) AS pos FROM batch_dates),
a AS (
  SELECT x.*, accountid AS k, b.pos, b.batch_date, {_state_sql(ACCOUNT_ATTRIBUTES)} AS s,
         row_number() OVER (PARTITION BY accountid, x.batchid ORDER BY sk_accountid DESC) AS rn
  FROM dim_account x JOIN b ON b.batchid = x.batchid WHERE accountid IS NOT NULL),
aa AS (SELECT *, lag(s) OVER (PARTITION BY k ORDER BY pos) AS before, lag(pos) OVER (PARTITION BY k ORDER BY pos) AS was
       FROM a WHERE rn = 1),
ai AS (SELECT *, sum(CASE WHEN before = s AND was = pos - 1 THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY pos) AS island FROM aa),
av AS (SELECT k, min(pos) AS p, max(pos) AS q FROM ai GROUP BY k, island),
v AS (
  SELECT 'dim_customer' AS entity, k AS entity_key, f AS valid_from,
         coalesce(lead(f) OVER (PARTITION BY k ORDER BY f), '9999-12-31') AS valid_to FROM cv
  UNION ALL
  SELECT 'dim_account', av.k, b1.batch_date, coalesce(b2.batch_date, '9999-12-31')
  FROM av JOIN b b1 ON b1.pos = av.p LEFT JOIN b b2 ON b2.pos = av.q + 1)
"""

QUERIES = {
    "p1_found": p1_found,
    **{f"p1_typed_{source}": p1_typed(source) for source in RAW_SOURCES},
    "p1_load_counts": p1_load_counts,
    "p1_assembled": p1_assembled,
    "p1_source_report": p1_source_report,
    "p1_error_counts": p1_error_counts,
    "p2_found": p2_found,
    "p2_report": p2_report,
    "p2_ledger": p2_ledger,
    "p3_found": p3_found,
    "p3_change_log": p3_change_log,
    "p3_union_schema": p3_union_schema,
    "p3_table_trade": p3_table("trade"),
    "p3_table_daily_market": p3_table("daily_market"),
    "p3_table_cash_transaction": p3_table("cash_transaction"),
    "p3_table_holding_history": p3_table("holding_history"),
    "p3_table_account_update": p3_table("account_update"),
    "p4_found": p4_found,
    "p4_formats": p4_formats,
    "p4_unregistered": p4_unregistered,
    "p4_path_accuracy": p4_path_accuracy,
    "p5_found": p5_found,
    "p5_current": p5_current,
    "p5_customer_versions": p5_customer_versions,
    "p5_account_versions": p5_account_versions,
}

ORACLE = {
    "p1_found": _P1_JUDGED + " SELECT DISTINCT line_id, reason FROM judged WHERE reason IS NOT NULL",
    "p1_error_counts": _P1_JUDGED + " SELECT source_name, count(*) AS records, count(*) FILTER (reason = 'broken_quoting') AS broken_quoting,"
    " count(*) FILTER (reason = 'field_count_mismatch') AS field_count_mismatch, count(*) FILTER (reason = 'invalid_value') AS invalid_value FROM judged GROUP BY source_name",
    "p1_source_report": _P1_JUDGED + " SELECT source_name, count(*) AS records, count(*) FILTER (reason IN ('broken_quoting', 'field_count_mismatch')) AS malformed,"
    " count(*) FILTER (reason = 'invalid_value') AS type_errors, CASE WHEN count(reason) > 0 THEN 'failed' ELSE 'passed' END AS status FROM judged GROUP BY source_name",
    "p1_load_counts": _P1_JUDGED + " SELECT source_name, count(*) AS records, count(*) FILTER (reason IS NULL) AS loaded, count(reason) AS failed FROM judged GROUP BY source_name",
    "p2_found": f"SELECT DISTINCT child_table, child_sk, fk_column FROM ({_P2_ROWS})",
    "p2_report": "SELECT child_table, fk_column, batchid, count(*) AS orphan_rows, count(DISTINCT k) AS orphan_keys"
    f" FROM ({_P2_ROWS}) GROUP BY child_table, fk_column, batchid",
    "p2_ledger": f"SELECT parent_table, batchid, count(DISTINCT k) AS orphan_keys, count(*) AS orphan_rows FROM ({_P2_ROWS}) GROUP BY parent_table, batchid",
    "p5_customer_versions": _P5_VERSIONS + f", cw AS (SELECT *, coalesce(lead(f) OVER (PARTITION BY k ORDER BY f), '9999-12-31') AS e FROM cc WHERE before IS NULL OR before <> s)"
    f" SELECT k AS entity_key, f AS effectivedate, e AS enddate, e = '9999-12-31' AS iscurrent, {', '.join([*CUSTOMER_ATTRIBUTES, 'batchid'])} FROM cw",
    "p5_account_versions": _P5_VERSIONS + ", aw AS (SELECT k, pos AS p, batchid, status, accountdesc, taxstatus FROM aa)"
    " SELECT av.k AS entity_key, b1.batch_date AS effectivedate, coalesce(b2.batch_date, '9999-12-31') AS enddate, b2.batch_date IS NULL AS iscurrent, status, accountdesc, taxstatus, aw.batchid"
    " FROM av JOIN b b1 ON b1.pos = av.p LEFT JOIN b b2 ON b2.pos = av.q + 1 JOIN aw ON aw.k = av.k AND aw.p = av.p",
    "p5_found": _P5_VERSIONS + "SELECT DISTINCT entity, entity_key, valid_from, valid_to FROM v",
    "p5_current": _P5_VERSIONS + "SELECT entity, entity_key, count(*) AS versions, min(valid_from) AS first_from,"
    " bool_or(valid_to = '9999-12-31') AS iscurrent FROM v GROUP BY entity, entity_key",
}
