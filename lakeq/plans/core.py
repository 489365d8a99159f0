"""Queries of the lakehouse operators over the driver tables, each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeq.functions import scalars, units
from lakeq.operators import audits, bronze, drift, entity, governance, medallion, quality, windows
from lakeq.plans.registry import Registry
from lakeq.session import shared_dir, table
from lakeq.sources import lake_table

registry = Registry()
QUERIES, ORACLE, query = registry.queries, registry.sql, registry.query
REFERENCE_TIME = "1998-09-01"


# -- gold ----------------------------------------------------------------------------------------------


@query(
    "SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS record_count,"
    " CAST(sum(CAST(value AS DECIMAL(20,4))) AS DOUBLE) AS total_value, max(value) AS max_value FROM events GROUP BY ALL"
)
def gold_windowed_events(spark: SparkSession, d: str) -> DataFrame:
    metrics = medallion.parse_metrics("count:*,sum:value,max:value")
    return medallion.gold_aggregate(table(spark, d, "events"), ["event_type"], metrics, "ts", "1 hour")


@query(
    "SELECT l_returnflag, l_linestatus, count(*) AS record_count, CAST(sum(CAST(l_quantity AS DECIMAL(20,4))) AS DOUBLE) AS total_l_quantity,"
    " CAST(sum(CAST(l_extendedprice AS DECIMAL(20,4))) AS DOUBLE) / count(l_extendedprice) AS avg_l_extendedprice,"
    " min(l_discount) AS min_l_discount, max(l_tax) AS max_l_tax FROM lineitem GROUP BY ALL"
)
def gold_group_metrics(spark: SparkSession, d: str) -> DataFrame:
    metrics = medallion.parse_metrics("count:*,sum:l_quantity,avg:l_extendedprice,min:l_discount,max:l_tax")
    return medallion.gold_aggregate(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], metrics)


@query(
    "SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(20,4))) AS DOUBLE) / count(value) AS avg_value"
    " FROM events WHERE value >= 0 GROUP BY ALL"
)
def daily_metrics_valid(spark: SparkSession, d: str) -> DataFrame:
    valid = table(spark, d, "events").filter("value >= 0")
    return valid.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), (F.sum(F.col("value").cast("decimal(20,4)")).cast("double") / F.count("value")).alias("avg_value")
    )


@query(
    "SELECT event_type, date_part('year', ts) AS y, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY CUBE (event_type, date_part('year', ts))"
)
def cube_distinct(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").withColumn("y", F.year("ts").cast("long"))
    return events.cube("event_type", "y").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))


# -- quality -------------------------------------------------------------------------------------------


@query(
    "SELECT count(*) AS records, round((count(*) FILTER (lang IS NULL OR lang = '') + count(*) FILTER (symbol IS NULL OR symbol = '')"
    " + count(*) FILTER (source IS NULL OR source = '')) / (count(*) * 3.0), 6) AS missing_ratio FROM documents"
)
def missing_ratio(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").agg(
        F.count(F.lit(1)).alias("records"), F.round(quality.missing_ratio(table(spark, d, "documents"), ["lang", "symbol", "source"]), 6).alias("missing_ratio")
    )


@query(
    "WITH n AS (SELECT count(*) AS n FROM trade), c AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') AS nulls FROM trade"
        for c in "rec_id trade_id trade_dts status ttype is_cash s_symbol trade_quantity trade_price execution_id execution_broker_id cash_amount fee commission tax feed_code batchid".split()
    )
    + ") SELECT column_name, nulls, round_even(nulls / CAST(n AS DOUBLE), 10) AS ratio FROM c, n WHERE nulls > 0"
)
def null_profile(spark: SparkSession, d: str) -> DataFrame:
    return quality.null_profile(table(spark, d, "trade"), places=10)


@query(
    "WITH g AS (SELECT trade_id, count(*) AS n FROM trade GROUP BY trade_id)"
    " SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - 1) AS BIGINT) AS duplicates, sum(n - 1) / CAST(sum(n) AS DOUBLE) AS ratio FROM g"
)
def duplicate_ratio(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicate_summary(table(spark, d, "trade"), ["trade_id"])


@query(
    f"SELECT count(*) AS records, count(*) FILTER (epoch_us(TIMESTAMP '{REFERENCE_TIME}') - epoch_us(o_orderdate) <= 365 * 24 * 3600000000) / CAST(count(*) AS DOUBLE) AS freshness FROM orders"
)
def freshness_score(spark: SparkSession, d: str) -> DataFrame:
    score = quality.freshness(F.col("o_orderdate"), F.lit(REFERENCE_TIME).cast("timestamp"), 365 * 24)
    return table(spark, d, "orders").agg(F.count(F.lit(1)).alias("records"), score.alias("freshness"))


_MEASURES = (
    "m AS (SELECT batchid, count(*) AS records, (count(*) FILTER (trade_dts IS NULL OR trade_dts = '') + count(*) FILTER (s_symbol IS NULL OR s_symbol = '')) / (count(*) * 2.0) AS missing,"
    " (count(*) - count(DISTINCT trade_id) - CASE WHEN count(*) > count(trade_id) THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) AS duplicates,"
    " count(*) FILTER (trade_price > 0) / CAST(count(*) AS DOUBLE) AS fresh FROM trade GROUP BY batchid)"
)


def _measures(spark: SparkSession, d: str) -> DataFrame:
    trade = table(spark, d, "trade")
    keys = F.count_distinct("trade_id") + F.when(F.count(F.lit(1)) > F.count("trade_id"), 1).otherwise(0)
    return trade.groupBy("batchid").agg(
        F.count(F.lit(1)).alias("records"), quality.missing_ratio(trade, ["trade_dts", "s_symbol"]).alias("missing"),
        ((F.count(F.lit(1)) - keys) / F.count(F.lit(1))).alias("duplicates"), (F.count_if(F.col("trade_price") > 0) / F.count(F.lit(1))).alias("fresh"),
    )


@query(
    f"WITH {_MEASURES} SELECT batchid, records, round_even(greatest(0.0, least(1.0, CAST(0.30 AS DOUBLE) * (1 - missing) + CAST(0.20 AS DOUBLE) * (1 - duplicates) + CAST(0.30 AS DOUBLE) * 1.0::DOUBLE + CAST(0.20 AS DOUBLE) * fresh)), 10) AS readiness FROM m"
)
def readiness_score(spark: SparkSession, d: str) -> DataFrame:
    score = quality.readiness(F.col("missing"), F.col("duplicates"), F.lit(True), F.col("fresh"), places=10)
    return _measures(spark, d).select("batchid", "records", score.alias("readiness"))


@query(
    f"WITH {_MEASURES} SELECT batchid, concat_ws(',', CASE WHEN missing > 0.02 THEN 'missing_ratio' END, CASE WHEN duplicates > 0.02 THEN 'duplicate_ratio' END,"
    " CASE WHEN fresh < 0.9 THEN 'freshness_score' END) AS violations FROM m"
)
def threshold_gate(spark: SparkSession, d: str) -> DataFrame:
    broken = quality.threshold_violations(F.col("missing"), F.col("duplicates"), F.col("fresh"), F.lit(True), 0.02, 0.02, 0.9)
    return _measures(spark, d).select("batchid", F.concat_ws(",", broken).alias("violations"))


@query(
    f"WITH {_MEASURES} SELECT batchid, CASE WHEN missing > 0.15 OR duplicates > 0.05 OR fresh < 0.7 THEN 'WARNING' WHEN records > 100 THEN 'WARNING' ELSE 'FAIL' END AS decision,"
    " CASE WHEN missing > 0.15 OR duplicates > 0.05 OR fresh < 0.7 THEN 0.86::DOUBLE WHEN records > 100 THEN 0.84::DOUBLE ELSE 0.88::DOUBLE END AS confidence FROM m"
)
def governance_decision(spark: SparkSession, d: str) -> DataFrame:
    evidence = _measures(spark, d).withColumns(
        {"status": F.lit("passed"), "violations": F.lit(0), "schema_valid": F.lit(True), "breaking": F.lit(False), "quarantined": F.lit(100)}
    )
    return governance.decide(evidence).select("batchid", "decision", "confidence")


@query(
    "WITH n AS (SELECT count(*) AS n FROM orders), e AS ("
    "SELECT 'row_count' AS expectation, '' AS column_name, CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END AS unexpected FROM orders"
    " UNION ALL SELECT 'exists', 'o_orderkey', 0 UNION ALL SELECT 'exists', 'o_comment', 1"
    " UNION ALL SELECT 'not_null', 'o_orderkey', count(*) FILTER (o_orderkey IS NULL) FROM orders"
    " UNION ALL SELECT 'unique', 'o_orderkey', count(o_orderkey) - count(DISTINCT o_orderkey) FROM orders"
    " UNION ALL SELECT 'unique', 'o_custkey', count(o_custkey) - count(DISTINCT o_custkey) FROM orders"
    " UNION ALL SELECT 'in_set', 'o_orderstatus', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders"
    " UNION ALL SELECT 'between', 'o_totalprice', count(*) FILTER (NOT o_totalprice BETWEEN 1000 AND 400000) FROM orders)"
    " SELECT expectation, column_name, unexpected = 0 AS success, CAST(unexpected AS BIGINT) AS unexpected,"
    " CASE WHEN expectation IN ('row_count', 'exists') THEN 0.0::DOUBLE ELSE unexpected * 100.0::DOUBLE / n END AS percent FROM e, n"
)
def expectation_suite(spark: SparkSession, d: str) -> DataFrame:
    e = quality.Expectation
    suite = [
        e("row_count"), e("exists", "o_orderkey"), e("exists", "o_comment"), e("not_null", "o_orderkey"), e("unique", "o_orderkey"), e("unique", "o_custkey"),
        e("in_set", "o_orderstatus", {"values": ["F", "O"]}), e("between", "o_totalprice", {"min": 1000, "max": 400000}),
    ]
    return quality.expectation_suite(table(spark, d, "orders"), suite)


RULES = [
    quality.Rule("key_there", "o_orderkey", "not_null"),
    quality.Rule("price_range", "o_totalprice", "in_range", params={"min": 1000, "max": 450000}),
    quality.Rule("priority_form", "o_orderpriority", "regex", "warning", {"pattern": "[1-3]-"}),
    quality.Rule("status_known", "o_orderstatus", "in_set", "error", {"values": ["F", "O"]}),
]


@query(
    "SELECT r.rule, r.severity, (SELECT count(*) FROM orders) AS checked, r.failed FROM ("
    "SELECT 'key_there' AS rule, 'error' AS severity, count(*) FILTER (o_orderkey IS NULL) AS failed FROM orders"
    " UNION ALL SELECT 'price_range', 'error', count(*) FILTER (NOT (o_totalprice >= 1000 AND o_totalprice <= 450000)) FROM orders"
    " UNION ALL SELECT 'priority_form', 'warning', count(*) FILTER (NOT regexp_matches(o_orderpriority, '^(?:[1-3]-)')) FROM orders"
    " UNION ALL SELECT 'status_known', 'error', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders) r"
)
def quality_rules_eval(spark: SparkSession, d: str) -> DataFrame:
    return quality.evaluate_rules(table(spark, d, "orders"), RULES)


@query(
    "SELECT o_orderkey, concat_ws(',', CASE WHEN NOT (o_totalprice >= 1000 AND o_totalprice <= 450000) THEN 'price_range' END, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'status_known' END) AS failed"
    " FROM orders WHERE NOT (o_totalprice >= 1000 AND o_totalprice <= 450000) OR o_orderstatus NOT IN ('F', 'O')"
)
def failing_rows(spark: SparkSession, d: str) -> DataFrame:
    return quality.failing_rows(table(spark, d, "orders"), RULES).select("o_orderkey", F.concat_ws(",", "failed_rules").alias("failed"))


@query(
    "SELECT line_id, CASE WHEN length(regexp_replace(raw_line, '[^|]', '', 'g')) + 1 <> 14 THEN 'field_count_mismatch' END AS problem, length(regexp_replace(raw_line, '[^|]', '', 'g')) + 1 AS fields"
    " FROM raw_lines WHERE source_name = 'trade' AND delimiter = '|' AND trim(raw_line) <> ''"
)
def field_count_check(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "raw_lines").filter("source_name = 'trade' AND delimiter = '|' AND trim(raw_line) <> ''")
    n = F.size(F.split("raw_line", r"\|", -1)).cast("long")
    return lines.select("line_id", F.when(n != 14, "field_count_mismatch").alias("problem"), n.alias("fields"))


_INT = "'^[+-]?[0-9]+$'"


@query(
    "WITH t AS (SELECT line_id, string_split(raw_line, '|') AS f FROM raw_lines WHERE source_name = 'holding_history' AND delimiter = '|')"
    f" SELECT line_id, len(list_filter(f[1:4], lambda x: trim(x) <> '' AND (NOT regexp_matches(trim(x), {_INT}) OR TRY_CAST(trim(x) AS BIGINT) IS NULL))) AS bad_fields FROM t WHERE len(f) = 4"
)
def coercion_errors(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "raw_lines").filter("source_name = 'holding_history' AND delimiter = '|'").withColumn("f", F.split("raw_line", r"\|", -1)).filter(F.size("f") == 4)
    split = lines.select("line_id", *[F.get("f", i).alias(f"c{i}") for i in range(4)])
    typed = quality.coerce(split, {f"c{i}": "integer" for i in range(4)})
    return typed.select("line_id", F.size("_parse_errors").cast("long").alias("bad_fields"))


@query(
    "SELECT count(*) AS records, CAST(coalesce(sum(CASE WHEN status <> trim(status) THEN 1 ELSE 0 END + CASE WHEN accountdesc <> trim(accountdesc) THEN 1 ELSE 0 END), 0) AS BIGINT) AS trimmed,"
    " CAST(coalesce(sum(CASE WHEN accountdesc IS NULL OR trim(accountdesc) = '' THEN 1 ELSE 0 END), 0) AS BIGINT) AS filled,"
    " count(*) FILTER (status <> trim(status) OR accountdesc <> trim(accountdesc) OR accountdesc IS NULL OR trim(accountdesc) = '') AS changed FROM dim_account"
)
def auto_fix_counters(spark: SparkSession, d: str) -> DataFrame:
    return quality.auto_fix_counters(table(spark, d, "dim_account").select("status", "accountdesc"), {"accountdesc": "unknown"})


@query(
    "SELECT sk_accountid, nullif(trim(status), '') AS status, coalesce(nullif(trim(accountdesc), ''), 'unknown') AS accountdesc FROM (SELECT CAST(sk_accountid AS VARCHAR) AS sk_accountid, status, accountdesc FROM dim_account)"
)
def auto_fix(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "dim_account").select(F.col("sk_accountid"), F.col("status").alias(" Status "), F.col("accountdesc").alias("Account Desc"))
    return quality.auto_fix(raw, {"accountdesc": "unknown"}, {"Account Desc": "accountdesc"})


SCHEMA = {
    "properties": {"status": {"type": "string", "enum": ["ACTV", "INAC", "PNDG", "CLSD"]}, "taxstatus": {"type": "integer", "minimum": 1}, "accountdesc": {"type": "string"}},
    "required": ["status", "accountdesc"],
}


@query(
    "SELECT * FROM (SELECT 'status is required' AS message, count(*) FILTER (status IS NULL) AS rows FROM dim_account UNION ALL"
    " SELECT 'status is not one of the enumeration', count(*) FILTER (status NOT IN ('ACTV', 'INAC', 'PNDG', 'CLSD')) FROM dim_account UNION ALL"
    " SELECT 'taxstatus violates minimum', count(*) FILTER (taxstatus < 1) FROM dim_account UNION ALL"
    " SELECT 'accountdesc is required', count(*) FILTER (accountdesc IS NULL) FROM dim_account) WHERE rows > 0"
)
def schema_validation(spark: SparkSession, d: str) -> DataFrame:
    return quality.schema_errors(table(spark, d, "dim_account").select("status", "taxstatus", "accountdesc"), SCHEMA)


# -- audits --------------------------------------------------------------------------------------------


#: The references between the tables at hand: those of the warehouse, and those of feeds and documents.
EDGES = {
    **audits.FOREIGN_KEYS, "trade": "execution_broker_id=dim_broker.sk_brokerid s_symbol=dim_security.symbol", "daily_market": "dm_s_symb=dim_security.symbol", "documents": "symbol=dim_security.symbol",
    "lineitem": "l_orderkey=orders.o_orderkey l_partkey=part.p_partkey l_suppkey=supplier.s_suppkey", "orders": "o_custkey=customer.c_custkey", "events": "user_id=customer.c_custkey",
}
EDGE_TABLES = ("dim_account", "dim_customer", "dim_broker", "dim_security", "dim_company", "trade", "daily_market", "documents", "lineitem", "orders", "part", "supplier", "customer", "events")


def _edge_sql(child: str, column: str, parent: str, key: str) -> str:
    norm = "lower(trim(coalesce(CAST({} AS VARCHAR), '')))"
    return (
        f"SELECT '{child}' AS child_table, '{column}' AS fk_column, '{parent}' AS parent_table, {norm.format(column)} AS fk_value, count(*) AS rows FROM {child}"
        f" WHERE {norm.format(column)} NOT IN ('', '0') AND {norm.format(column)} NOT IN (SELECT {norm.format(key)} FROM {parent}) GROUP BY ALL"
    )


def _here(edge: tuple[str, str, str, str]) -> bool:
    return edge[0] in EDGE_TABLES and edge[2] in EDGE_TABLES


@query(" UNION ALL ".join(_edge_sql(*e) for e in audits.edges(EDGES) if _here(e)))
def fk_orphans(spark: SparkSession, d: str) -> DataFrame:
    """The orphans of every reference whose tables are there."""
    return audits.orphan_audit({n: table(spark, d, n) for n in EDGE_TABLES}, EDGES)


@query(
    "SELECT count(*) AS matches FROM (SELECT DISTINCT lower(trim(coalesce(lastname, ''))) AS a, lower(trim(coalesce(firstname, ''))) AS b FROM dim_customer) c"
    " WHERE (a <> '' OR b <> '') AND EXISTS (SELECT 1 FROM dim_broker x WHERE lower(trim(coalesce(x.lastname, ''))) = a AND lower(trim(coalesce(x.firstname, ''))) = b)"
)
def name_overlap(spark: SparkSession, d: str) -> DataFrame:
    return audits.overlap(table(spark, d, "dim_customer"), table(spark, d, "dim_broker"), {"lastname": "lastname", "firstname": "firstname"})


@query(
    "WITH k AS (SELECT count(*) AS v FROM (SELECT sk_accountid FROM dim_account WHERE sk_accountid IS NULL OR TRUE QUALIFY sk_accountid IS NULL OR row_number() OVER (PARTITION BY sk_accountid ORDER BY batchid, status, accountdesc, taxstatus) > 1)),"
    f" o AS (SELECT count(*) AS v FROM ({_edge_sql('dim_account', 'sk_brokerid', 'dim_broker', 'sk_brokerid')})), s AS (SELECT count(*) AS v FROM dim_account WHERE effectivedate IS NULL OR trim(effectivedate) = ''),"
    " a AS (SELECT 'unique_keys' AS audit, v AS violations FROM k UNION ALL SELECT 'orphan_brokers', v FROM o UNION ALL SELECT 'blank_starts', v FROM s)"
    " SELECT audit, violations, violations = 0 AS passed FROM (SELECT * FROM a UNION ALL SELECT 'overall', CAST(sum(violations) AS BIGINT) FROM a)"
)
def audit_overall(spark: SparkSession, d: str) -> DataFrame:
    account = table(spark, d, "dim_account")
    return audits.audit_summary(
        {
            "unique_keys": audits.repeated_keys(account, ["sk_accountid"], ["batchid", "status", "accountdesc", "taxstatus"]),
            "orphan_brokers": audits.orphan_audit({"dim_account": account, "dim_broker": table(spark, d, "dim_broker")}, {"dim_account": "sk_brokerid=dim_broker.sk_brokerid"}),
            "blank_starts": account.filter(scalars.is_blank(F.col("effectivedate"))),
        }
    )


@query(
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS record_count, count(*)::INTEGER AS field_count, string_agg(column_name, ',' ORDER BY column_index) AS fields FROM duckdb_columns() WHERE table_name = '{t}'" for t in ("orders", "part", "trade"))
)
def table_baselines(spark: SparkSession, d: str) -> DataFrame:
    return audits.baselines({n: table(spark, d, n) for n in ("orders", "part", "trade")})


@query(
    "WITH f AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey) AS n FROM (SELECT o_custkey, o_orderstatus, o_totalprice, o_orderkey, o_orderdate FROM orders)),"
    " s AS (SELECT o_custkey, o_orderstatus, CAST(sum(CAST(o_totalprice AS DECIMAL(28,4))) AS DOUBLE) AS t FROM orders GROUP BY ALL)"
    " SELECT f.o_custkey, f.o_orderstatus, s.t AS o_totalprice, f.o_orderkey, f.o_orderdate FROM f JOIN s ON s.o_custkey = f.o_custkey AND s.o_orderstatus = f.o_orderstatus WHERE n = 1"
)
def pre_aggregated(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderkey", "o_orderdate")
    return audits.pre_aggregate(orders, ["o_custkey", "o_orderstatus"], ["o_totalprice"], ["o_orderdate", "o_orderkey"])


@query(
    "WITH s AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') SELECT o_orderkey, o_orderstatus AS status,"
    " CASE WHEN o_orderstatus = 'F' THEN 'missing_partner' ELSE 'forbidden_partner' END AS violation FROM orders LEFT JOIN s ON l_orderkey = o_orderkey"
    " WHERE (o_orderstatus = 'F' AND l_orderkey IS NULL) OR (o_orderstatus = 'O' AND l_orderkey IS NOT NULL)"
)
def status_consistency(spark: SparkSession, d: str) -> DataFrame:
    returned = table(spark, d, "lineitem").filter("l_returnflag = 'R'")
    status = F.col("o_orderstatus")
    return audits.presence_violations(table(spark, d, "orders"), "o_orderkey", status, returned, "l_orderkey", status == "F", status == "O")


@query(
    "WITH p AS (SELECT DISTINCT lower(trim(coalesce(lastname, ''))) AS a, lower(trim(coalesce(firstname, ''))) AS b FROM dim_broker),"
    " c AS (SELECT sk_customerid, iscurrent, a IS NOT NULL AS found FROM dim_customer LEFT JOIN p ON a = lower(trim(coalesce(lastname, ''))) AND b = lower(trim(coalesce(firstname, ''))))"
    " SELECT violation, count(*) AS n FROM (SELECT CASE WHEN iscurrent AND NOT found THEN 'marked_without_match' WHEN NOT coalesce(iscurrent, false) AND found THEN 'match_not_marked' END AS violation FROM c)"
    " WHERE violation IS NOT NULL GROUP BY violation"
)
def name_match_audit(spark: SparkSession, d: str) -> DataFrame:
    found = audits.flag_against_match(table(spark, d, "dim_customer"), "iscurrent", table(spark, d, "dim_broker"), {"lastname": "lastname", "firstname": "firstname"})
    return found.groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


@query(
    "WITH h AS (SELECT l_orderkey, string_agg(l_linenumber || ':' || l_returnflag, ',' ORDER BY l_shipdate, l_linenumber, l_returnflag) AS history FROM lineitem GROUP BY l_orderkey)"
    " SELECT o_orderkey, coalesce(history, '') AS history FROM orders LEFT JOIN h ON l_orderkey = o_orderkey"
)
def history_collect(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").withColumn("entry", F.concat_ws(":", F.col("l_linenumber").cast("string"), "l_returnflag"))
    rows = medallion.collect_history(table(spark, d, "orders"), "o_orderkey", lines, "l_orderkey", ["l_shipdate", "l_linenumber", "l_returnflag"], "entry", "entries")
    return rows.select("o_orderkey", F.array_join("entries", ",").alias("history"))


@query(
    "SELECT rec_id, trade_id, CASE WHEN trade_id IS NULL THEN 'missing_key' ELSE 'repeated_key' END AS reason FROM (SELECT rec_id, trade_id, row_number() OVER (PARTITION BY trade_id ORDER BY rec_id) AS n FROM trade) WHERE trade_id IS NULL OR n > 1"
)
def pk_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return audits.repeated_keys(table(spark, d, "trade"), ["trade_id"], ["rec_id"]).select("rec_id", "trade_id", "reason")


@query(
    "WITH a AS (SELECT 'trade' AS table_name, count(*) AS n FROM trade UNION ALL SELECT 'daily_market', count(*) FROM daily_market UNION ALL SELECT 'orders', count(*) FROM orders),"
    " b AS (SELECT 'trade' AS table_name, count(*) AS n FROM trade WHERE batchid = 1 UNION ALL SELECT 'daily_market', count(*) FROM daily_market UNION ALL SELECT 'part', count(*) FROM part)"
    " SELECT coalesce(a.table_name, b.table_name) AS table_name, coalesce(a.n, 0) AS source_rows, coalesce(b.n, 0) AS warehouse_rows, coalesce(b.n, 0) - coalesce(a.n, 0) AS delta FROM a FULL JOIN b ON a.table_name = b.table_name"
)
def row_count_recon(spark: SparkSession, d: str) -> DataFrame:
    read = {n: table(spark, d, n) for n in ("trade", "daily_market", "orders", "part")}
    source = audits.row_counts({n: read[n] for n in ("trade", "daily_market", "orders")})
    return audits.reconcile(source, audits.row_counts({"trade": read["trade"].filter("batchid = 1"), "daily_market": read["daily_market"], "part": read["part"]}))


@query()
def table_checksum(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for name in ("region", "nation", "supplier", "customer", "orders"):
        one = audits.table_checksum(table(spark, d, name)).select(F.lit(name).alias("table_name"), "n", "checksum")
        out = one if out is None else out.unionByName(one)
    return out


_VERSIONS = (
    "v AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate AS effectivedate, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS enddate FROM orders)"
)


def _versions(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("effectivedate"))
    return audits.versioned(log, "o_custkey", "effectivedate", ["o_orderkey"])


@query(f"WITH {_VERSIONS} SELECT o_custkey, o_orderkey, o_orderstatus, effectivedate, enddate, enddate IS NULL AS iscurrent FROM v")
def scd2_history(spark: SparkSession, d: str) -> DataFrame:
    return _versions(spark, d)


@query(
    "WITH k AS (SELECT CAST(customerid AS VARCHAR) AS k, count(*) FILTER (iscurrent) AS n FROM dim_customer GROUP BY 1)"
    " SELECT 'not_one_current' AS violation, (SELECT count(*) FROM k WHERE n <> 1) AS rows UNION ALL"
    " SELECT 'closed_without_end', count(*) FILTER (NOT coalesce(iscurrent, false) AND lower(trim(coalesce(enddate, ''))) IN ('', '9999-12-31')) FROM dim_customer UNION ALL"
    " SELECT 'blank_start', count(*) FILTER (effectivedate IS NULL OR trim(effectivedate) = '') FROM dim_customer"
)
def scd2_audit(spark: SparkSession, d: str) -> DataFrame:
    return audits.version_audit(table(spark, d, "dim_customer"), "customerid")


@query(
    f"WITH {_VERSIONS} SELECT e.event_id, v.o_orderkey FROM events e LEFT JOIN v ON v.o_custkey = e.user_id AND e.ts >= v.effectivedate AND (v.enddate IS NULL OR e.ts < v.enddate)"
)
def asof_key_lookup(spark: SparkSession, d: str) -> DataFrame:
    return audits.version_as_of(table(spark, d, "events"), "user_id", "ts", _versions(spark, d), "o_custkey", "effectivedate", "enddate", ["o_orderkey"]).select("event_id", "o_orderkey")


# -- duplicates, outliers, imputation ------------------------------------------------------------------


@query("SELECT event_id, user_id, event_type, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def dedup_latest(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return windows.keep_best(events, ["user_id", "event_type"], F.col("ts"), F.col("event_id"))


@query(
    "WITH r AS (SELECT event_id, value, count(value) OVER w AS n, CAST(sum(CAST(value AS DECIMAL(20,4))) OVER w AS DOUBLE) AS s, CAST(sum(CAST(value AS DECIMAL(20,4)) * CAST(value AS DECIMAL(18,4))) OVER w AS DOUBLE) AS q"
    " FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW))"
    " SELECT event_id, n AS rolling_n, s AS rolling_sum FROM r WHERE n > 2 AND value > s / n + 1.5 * sqrt(greatest(0.0, (q - s * (s / n)) / (n - 1)))"
)
def rolling_outliers(spark: SparkSession, d: str) -> DataFrame:
    stats = windows.rolling_stats(table(spark, d, "events").select("event_id", "user_id", "ts", "value"), "user_id", "ts", "value", 7)
    far = (F.col("rolling_n") > 2) & (F.col("value") > F.col("rolling_avg") + 1.5 * F.col("rolling_std"))
    return stats.filter(far).select("event_id", "rolling_n", "rolling_sum")


_FENCES = "f AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY l_returnflag)"


@query(f"WITH {_FENCES} SELECT l_returnflag, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q1 - 1.5 * (q3 - q1), 6) AS low, round(q3 + 1.5 * (q3 - q1), 6) AS high FROM f")
def iqr_fences(spark: SparkSession, d: str) -> DataFrame:
    fences = windows.quartile_fences(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice")
    return fences.select("l_returnflag", *[F.round(c, 6).alias(c) for c in ("q1", "q3", "low", "high")])


@query(
    "WITH f AS (SELECT dm_s_symb, quantile_cont(dm_close, 0.25) AS q1, quantile_cont(dm_close, 0.75) AS q3 FROM daily_market GROUP BY dm_s_symb)"
    " SELECT rec_id, m.dm_s_symb, dm_close FROM daily_market m JOIN f ON f.dm_s_symb = m.dm_s_symb WHERE dm_close < q1 - 1.5 * (q3 - q1) OR dm_close > q3 + 1.5 * (q3 - q1)"
)
def iqr_outliers(spark: SparkSession, d: str) -> DataFrame:
    market = table(spark, d, "daily_market").select("rec_id", "dm_s_symb", "dm_close")
    return windows.outside_fences(market, windows.quartile_fences(market, ["dm_s_symb"], "dm_close"), ["dm_s_symb"], "dm_close")


@query(
    "WITH v AS (SELECT *, CASE WHEN event_type = 'click' THEN NULL ELSE value END AS known FROM events), m AS (SELECT user_id, median(known) AS med FROM v GROUP BY user_id)"
    " SELECT event_id, coalesce(known, med) AS filled, known IS NULL AND med IS NOT NULL AS is_imputed, CASE WHEN known IS NULL AND med IS NOT NULL THEN 'group_median' END AS imputation_method FROM v LEFT JOIN m ON m.user_id = v.user_id"
)
def impute_group_median(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").withColumn("known", F.when(F.col("event_type") == "click", None).otherwise(F.col("value")))
    return windows.median_fill(events, "user_id", "known", "filled").select("event_id", "filled", "is_imputed", "imputation_method")


@query(
    "WITH v AS (SELECT *, CASE WHEN event_type = 'click' THEN NULL ELSE value END AS known FROM events)"
    " SELECT event_id, last_value(known IGNORE NULLS) OVER w AS filled, known IS NULL AND last_value(known IGNORE NULLS) OVER w IS NOT NULL AS is_imputed FROM v"
    " WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
)
def impute_forward_fill(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").withColumn("known", F.when(F.col("event_type") == "click", None).otherwise(F.col("value")))
    return windows.forward_fill(events, "user_id", ["ts", "event_id"], "known", "filled").select("event_id", "filled", "is_imputed")


@query(
    "WITH c AS (SELECT customerid, email, count(*) AS n, min((batchid, sk_customerid)) AS best FROM dim_customer WHERE email IS NOT NULL GROUP BY ALL)"
    " SELECT customerid, arg_min(email, best) AS by_priority, arg_max(email, (n, email)) AS by_majority, max(n) AS votes FROM c GROUP BY customerid"
)
def survivorship(spark: SparkSession, d: str) -> DataFrame:
    return windows.survivor(table(spark, d, "dim_customer"), "customerid", "email", F.col("batchid"), F.col("sk_customerid"))


@query(
    f"WITH {_MEASURES}, s AS (SELECT batchid, round(missing * 100, 6) AS score FROM m), l AS (SELECT batchid, score, round(lag(score) OVER (ORDER BY batchid) - score, 6) AS fall FROM s) SELECT batchid, score, fall FROM l WHERE fall >= 0.001"
)
def readiness_drop(spark: SparkSession, d: str) -> DataFrame:
    scores = _measures(spark, d).select("batchid", F.round(F.col("missing") * 100, 6).alias("score"))
    return windows.drops(scores, "batchid", "score", 0.001)


@query("SELECT sha256(text) AS text_hash, count(*) AS copies, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def exact_duplicates_hash(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("text IS NOT NULL")
    return docs.groupBy(F.sha2("text", 256).alias("text_hash")).agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_doc")).filter("copies > 1")


# -- standardising -------------------------------------------------------------------------------------


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k FROM events")
def json_flatten(spark: SparkSession, d: str) -> DataFrame:
    parsed = table(spark, d, "events").select("event_id", F.from_json("props", "struct<k:bigint>").alias("props"))
    return medallion.flatten_nested(parsed)


@query(
    "SELECT sk_accountid, trim(status) AS status, trim(accountdesc) AS accountdesc, CAST(NULL AS VARCHAR) AS branch_note, accountdesc IS NULL OR trim(accountdesc) = '' AS is_missing_accountdesc FROM dim_account"
)
def silver_standardise(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "dim_account").select("sk_accountid", F.col("status").alias("Status"), F.col("accountdesc").alias("AccountDesc"))
    return medallion.standardise(raw, ["status", "Branch Note"], ("accountdesc",))


@query("SELECT CASE WHEN c_nationkey = 14 THEN 'match' ELSE 'other' END AS side, count(*) AS n FROM customer GROUP BY 1")
def code_split(spark: SparkSession, d: str) -> DataFrame:
    yes, no = medallion.split_by_code(table(spark, d, "customer"), "c_nationkey", 14)
    both = yes.select(F.lit("match").alias("side")).unionByName(no.select(F.lit("other").alias("side")))
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def envelope_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return medallion.flatten_payload(medallion.envelope(orders, "orders", "batch1"), ())


@query(
    "WITH delta AS (SELECT o_orderkey + 100 AS o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders)"
    " SELECT o_orderkey, o_totalprice FROM delta UNION ALL SELECT o_orderkey, o_totalprice FROM orders o WHERE NOT EXISTS (SELECT 1 FROM delta x WHERE x.o_orderkey = o.o_orderkey)"
)
def merge_upsert(spark: SparkSession, d: str) -> DataFrame:
    base = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    delta = base.select((F.col("o_orderkey") + 100).alias("o_orderkey"), (F.col("o_totalprice") * 2).alias("o_totalprice"))
    return lake_table.merged(base, delta, ["o_orderkey"], ["o_totalprice"])


def _folder(spark: SparkSession, name: str) -> str:
    """A fresh place in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query(
    "WITH delta AS (SELECT o_orderkey + 100 AS o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders), new AS (SELECT max(o_orderkey) + 1000 AS o_orderkey, 1.0::DOUBLE AS o_totalprice FROM orders)"
    " SELECT o_orderkey, o_totalprice FROM delta UNION ALL SELECT o_orderkey, o_totalprice FROM orders o WHERE NOT EXISTS (SELECT 1 FROM delta x WHERE x.o_orderkey = o.o_orderkey) UNION ALL SELECT * FROM new"
)
def lake_table_merge(spark: SparkSession, d: str) -> DataFrame:
    """A table written, merged twice with the same rows, appended to, and read back."""
    base = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    delta = base.select((F.col("o_orderkey") + 100).alias("o_orderkey"), (F.col("o_totalprice") * 2).alias("o_totalprice"))
    lake = lake_table.LakeTable(spark, _folder(spark, "orders"))
    lake.replace(base)
    for _ in range(2):
        lake.merge(delta, ["o_orderkey"], ["o_totalprice"])
    lake.append(base.agg((F.max("o_orderkey") + 1000).alias("o_orderkey"), F.lit(1.0).alias("o_totalprice")))
    return lake.read()


@query("SELECT unnest(['csv', 'json', 'orc', 'parquet']) AS format, (SELECT count(*) FROM supplier) AS rows, (SELECT CAST(sum(s_suppkey) AS BIGINT) FROM supplier) AS keys")
def export_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """A table exported in every format and read back."""
    out, place = None, _folder(spark, "export")
    for fmt in ("csv", "json", "orc", "parquet"):
        lake_table.export(table(spark, d, "supplier").select("s_suppkey", "s_name"), f"{place}/{fmt}", fmt)
        back = (spark.read.option("header", True) if fmt == "csv" else spark.read).format(fmt).load(f"{place}/{fmt}")
        one = back.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("s_suppkey").cast("long")).alias("keys")).select(F.lit(fmt).alias("format"), "rows", "keys")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id")
def stream_upserts(spark: SparkSession, d: str) -> DataFrame:
    """The latest event of every user, merged into a table by a stream of files."""
    place = _folder(spark, "stream")
    events = table(spark, d, "events").select("user_id", "event_id", "ts")
    events.withColumn("part", F.col("event_id") % 3).write.partitionBy("part").parquet(f"{place}/in")
    lake = lake_table.LakeTable(spark, f"{place}/latest")
    stream = spark.readStream.schema(events.schema).parquet(f"{place}/in")

    def keep_latest(batch: DataFrame, _: int) -> None:
        rows = batch if not lake.version() else batch.unionByName(lake.read().join(batch.select("user_id").distinct(), "user_id", "left_semi"))
        lake.merge(rows, ["user_id"], ["ts", "event_id"])

    stream.select("user_id", "event_id", "ts").writeStream.foreachBatch(keep_latest).option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start().awaitTermination()
    return lake.read().select("user_id", "ts", "event_id")


_UNIT = "CASE p_size % 4 WHEN 0 THEN 'Fahrenheit' WHEN 1 THEN ' Kelvin ' WHEN 2 THEN '°C' ELSE 'furlong' END"


@query(
    "SELECT p_partkey, CASE WHEN p_size % 4 < 3 THEN 'celsius' END AS canonical_unit,"
    " CASE p_size % 4 WHEN 0 THEN round_even(p_size * 0.5555555556::DOUBLE + -17.7777777778::DOUBLE, 6) WHEN 1 THEN round_even(p_size * 1.0::DOUBLE + -273.15::DOUBLE, 6) WHEN 2 THEN round_even(p_size * 1.0::DOUBLE + 0.0::DOUBLE, 6) END AS converted,"
    " CASE p_size % 4 WHEN 0 THEN p_size BETWEEN -130 AND 160 WHEN 1 THEN p_size BETWEEN 180 AND 350 WHEN 2 THEN p_size BETWEEN -90 AND 70 END AS plausible FROM part"
)
def unit_convert(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").select("p_partkey", "p_size", F.expr(_UNIT).alias("unit"))
    return units.convert(parts, "p_size", "unit", "temperature").select("p_partkey", "canonical_unit", "converted", "plausible")


@query(
    "SELECT column_name, kind, count(*) AS n FROM (SELECT 'trade_dts' AS column_name, trade_dts AS x FROM trade UNION ALL SELECT 'dm_date', dm_date FROM daily_market UNION ALL SELECT 'email', email FROM dim_customer) t,"
    " LATERAL (SELECT CASE WHEN regexp_matches(x, '^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}') THEN 'datetime' WHEN regexp_matches(x, '^\\d{4}-\\d{2}-\\d{2}') THEN 'date'"
    " WHEN regexp_matches(x, '(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}') THEN 'uuid' WHEN regexp_matches(x, '(?s)@[^@]*\\.[^@]*$') THEN 'email'"
    " WHEN regexp_matches(x, '^https?://') THEN 'url' WHEN regexp_matches(x, '^-?\\d+\\.\\d+') THEN 'coordinate' END AS kind) GROUP BY ALL"
)
def pattern_profile(spark: SparkSession, d: str) -> DataFrame:
    columns = (("trade", "trade_dts"), ("daily_market", "dm_date"), ("dim_customer", "email"))
    out = None
    for name, c in columns:
        one = table(spark, d, name).select(F.lit(c).alias("column_name"), scalars.text_pattern(F.col(c)).alias("kind"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("column_name", "kind").agg(F.count(F.lit(1)).alias("n"))


@query(
    "SELECT 'l_orderkey' AS column_name, 'integer' AS type, count(*) AS rows, count(*) - count(l_orderkey) AS nulls, CAST(min(l_orderkey) AS DOUBLE) AS low, CAST(max(l_orderkey) AS DOUBLE) AS high, CAST(NULL AS VARCHAR) AS pattern FROM lineitem"
    " UNION ALL SELECT 'l_tax', 'number', count(*), count(*) - count(l_tax), min(l_tax) + 0.0, max(l_tax) + 0.0, NULL FROM lineitem UNION ALL SELECT 'l_returnflag', 'string', count(*), count(*) - count(l_returnflag), NULL, NULL, NULL FROM lineitem"
)
def column_profile(spark: SparkSession, d: str) -> DataFrame:
    return drift.profile(table(spark, d, "lineitem").select("l_orderkey", "l_tax", "l_returnflag"))


@query(
    "SELECT * FROM (VALUES ('field_rename_candidate', 'o_totalprice', 'medium', 'review_alias_mapping', 'o_totalprices', 0.96::DOUBLE), ('missing_required_field', 'o_custkey', 'critical', 'quarantine_record', NULL, NULL),"
    " ('new_unknown_field', 'o_totalprices', 'low', 'preserve_in_bronze_and_review_before_promotion', NULL, NULL), ('field_type_change', 'o_orderkey', 'medium', 'safe_cast_in_silver', NULL, NULL)) t(issue_code, field_name, severity, action, candidate_field, confidence)"
)
def schema_drift_report(spark: SparkSession, d: str) -> DataFrame:
    expected = table(spark, d, "orders")
    actual = expected.drop("o_custkey").withColumnRenamed("o_totalprice", "o_totalprices").withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
    return drift.drift_report(spark, expected.schema, actual.schema, drift.DriftPolicy(required=frozenset({"o_custkey"})))


# -- entities ------------------------------------------------------------------------------------------

_ENTITY = "trim(regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9]+', ' ', 'g'))"


@query(
    f"WITH t AS (SELECT sk_companyid, {_ENTITY.format('name')} AS n, {_ENTITY.format('city')} AS c, coalesce(lower(trim(CAST(companyid AS VARCHAR))), '') AS e FROM dim_company)"
    " SELECT 'dim_company' AS source_system, 'company' AS entity_type, CAST(sk_companyid AS VARCHAR) AS source_entity_id,"
    " 'ceid_' || substr(sha256('company|' || CASE WHEN e <> '' THEN 'companyid=' || e WHEN n <> '' OR c <> '' THEN concat_ws('|', CASE WHEN n <> '' THEN 'name=' || n END, CASE WHEN c <> '' THEN 'city=' || c END) ELSE 'id=' || sk_companyid END), 1, 16) AS canonical_entity_id,"
    " CASE WHEN e <> '' THEN 'exact' WHEN n <> '' OR c <> '' THEN 'rule_based' ELSE 'new_entity' END AS match_method, CASE WHEN e <> '' THEN 1.0::DOUBLE WHEN n <> '' OR c <> '' THEN 0.95::DOUBLE ELSE 0.5::DOUBLE END AS confidence_score FROM t"
)
def entity_exact_rule(spark: SparkSession, d: str) -> DataFrame:
    return entity.resolve_exact(table(spark, d, "dim_company"), "company", "dim_company", "sk_companyid", ["companyid"], ["name", "city"])


@query()
def entity_tiers(spark: SparkSession, d: str) -> DataFrame:
    """Crosswalk of brokers by exact, fuzzy and probabilistic likeness, with counts."""
    brokers = table(spark, d, "dim_broker").withColumn("full_name", F.concat_ws(" ", "firstname", "lastname"))
    return entity.resolve(brokers, "broker", "dim_broker", "sk_brokerid", ["email"], [], "full_name").groupBy("match_method").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("canonical_entity_id").alias("entities"))


@query()
def entity_fuzzy_classes(spark: SparkSession, d: str) -> DataFrame:
    return entity.fuzzy_classes(table(spark, d, "dim_company").select("sk_companyid", "name"), "sk_companyid", "name")


# -- the bronze gate -----------------------------------------------------------------------------------

ACCOUNTS = bronze.Contract(
    "dim_account", {"sk_accountid": "integer", "accountid": "integer", "status": "string", "accountdesc": "string", "taxstatus": "integer", "batchid": "integer", "effectivedate": "string"},
    required=("sk_accountid", "accountdesc"), keys=("accountid", "batchid"), rules=(quality.Rule("status_known", "status", "in_set", params={"values": ["ACTV", "INAC", "PNDG", "CLSD"]}),),
    timestamp="effectivedate", max_age_hours=2 * 365 * 24, max_duplicates=0.5,
)
GATE_TIME = "2015-08-01"


def _raw_accounts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "dim_account").select(*[F.col(c).cast("string").alias(c) for c in ACCOUNTS.kinds])


_GATE = (
    "WITH f AS (SELECT sk_accountid, accountid, batchid, nullif(trim(status), '') AS status, nullif(trim(accountdesc), '') AS accountdesc, nullif(trim(effectivedate), '') AS effectivedate FROM dim_account),"
    " j AS (SELECT *, CASE WHEN sk_accountid IS NULL THEN 'sk_accountid is missing' WHEN accountdesc IS NULL THEN 'accountdesc is missing' WHEN status NOT IN ('ACTV', 'INAC', 'PNDG', 'CLSD') THEN 'status_known' END AS reason FROM f),"
    " k AS (SELECT sum(n - 1) / CAST(sum(n) AS DOUBLE) AS duplicates FROM (SELECT count(*) AS n FROM f GROUP BY accountid, batchid)),"
    " m AS (SELECT count(*) AS records, count(reason) AS quarantined, (count(*) FILTER (sk_accountid IS NULL) + count(*) FILTER (accountdesc IS NULL)) / (count(*) * 2.0::DOUBLE) AS missing,"
    f" count(*) FILTER (epoch_us(TIMESTAMP '{GATE_TIME}') - epoch_us(TRY_CAST(effectivedate AS TIMESTAMP)) <= 2 * 365 * 24 * 3600000000) / CAST(count(*) AS DOUBLE) AS fresh FROM j)"
)


@query(
    _GATE + ", v AS (SELECT *, concat_ws(',', CASE WHEN missing > 0.2 THEN 'missing_ratio' END, CASE WHEN duplicates > 0.5 THEN 'duplicate_ratio' END, CASE WHEN fresh < 0.8 THEN 'freshness_score' END) AS violations FROM m, k)"
    " SELECT 'dim_account' AS dataset, records, records - quarantined AS published, quarantined, missing, duplicates, fresh, violations, true AS schema_valid,"
    " CASE WHEN violations <> '' THEN 'failed' WHEN quarantined > 0 THEN 'warning' ELSE 'passed' END AS status FROM v"
)
def bronze_gate(spark: SparkSession, d: str) -> DataFrame:
    """The metrics of the whole gate over the account snapshots as they arrive."""
    return bronze.validate(_raw_accounts(spark, d), ACCOUNTS, F.lit(GATE_TIME).cast("timestamp")).metrics


@query(_GATE + " SELECT 'dim_account' AS dataset, reason AS quarantine_reason, count(*) AS rows FROM j WHERE reason IS NOT NULL GROUP BY reason")
def bronze_quarantine(spark: SparkSession, d: str) -> DataFrame:
    held = bronze.validate(_raw_accounts(spark, d), ACCOUNTS, F.lit(GATE_TIME).cast("timestamp")).quarantine
    return governance.quarantine_summary(held).drop("first_key")


@query(
    _GATE + " SELECT CASE WHEN reason = 'status_known' THEN 'unrecoverable' ELSE 'candidate' END AS outcome, count(*) AS rows FROM j WHERE reason IS NOT NULL GROUP BY 1"
)
def quarantine_recovery(spark: SparkSession, d: str) -> DataFrame:
    """What of the quarantine can be repaired: lost descriptions get a default, unknown states do not."""
    held = bronze.validate(_raw_accounts(spark, d), ACCOUNTS, F.lit(GATE_TIME).cast("timestamp")).quarantine
    return bronze.recover(held, ACCOUNTS).groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"))


# -- governance ----------------------------------------------------------------------------------------


@query(
    "SELECT event_id, coalesce(ts < max(ts) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - INTERVAL 2 DAYS, false) AS is_late FROM events"
)
def late_data_split(spark: SparkSession, d: str) -> DataFrame:
    return governance.split_late(table(spark, d, "events").select("event_id", "ts"), "ts", 2 * 86_400, "event_id").drop("ts")


@query(
    "WITH m AS (SELECT event_type, max(ts) AS watermark, count(*) AS rows FROM events GROUP BY event_type), t AS (SELECT max(ts) AS now FROM events)"
    " SELECT event_type, watermark, rows, CAST(floor((epoch_us(now) - epoch_us(watermark)) / 60000000) AS BIGINT) AS gap_minutes, floor((epoch_us(now) - epoch_us(watermark)) / 60000000) > 30 AS needs_backfill FROM m, t"
)
def watermark_gap(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    marks = governance.watermarks(events, "event_type", "ts")
    now = events.agg(F.max("ts").cast("string")).first()[0]
    return governance.gaps(marks, F.lit(now).cast("timestamp"))


@query(
    "SELECT 'orders' AS dataset, reason AS quarantine_reason, count(*) AS rows, min(CAST(o_orderkey AS VARCHAR)) AS first_key FROM (SELECT o_orderkey, CASE WHEN NOT (o_totalprice >= 1000 AND o_totalprice <= 450000) THEN 'price_range' ELSE 'status_known' END AS reason"
    " FROM orders WHERE NOT (o_totalprice >= 1000 AND o_totalprice <= 450000) OR o_orderstatus NOT IN ('F', 'O')) GROUP BY reason"
)
def quarantine_summary(spark: SparkSession, d: str) -> DataFrame:
    bad = quality.failing_rows(table(spark, d, "orders"), RULES)
    at = F.lit(REFERENCE_TIME).cast("timestamp")
    rows = governance.quarantine_records(bad, "orders", "bronze", F.get("failed_rules", 0), F.col("o_orderkey"), F.lit("batch1"), at)
    return governance.quarantine_summary(rows)


@query(
    "SELECT event_type AS source, count(*) FILTER (user_id % 3 = 0) AS pending, count(*) FILTER (user_id % 3 = 1) AS resolved, count(*) FILTER (user_id % 3 = 2) AS exhausted FROM events GROUP BY event_type"
)
def dlq_stats(spark: SparkSession, d: str) -> DataFrame:
    status = F.element_at(F.array(F.lit("pending"), F.lit("resolved"), F.lit("exhausted")), (F.col("user_id") % 3 + 1).cast("int"))
    return governance.dlq_stats(table(spark, d, "events").select(F.col("event_type").alias("source"), status.alias("status")), ["pending", "resolved", "exhausted"])


@query(
    "SELECT role, layer, table_name, role IN ('admin', 'steward') OR role = 'analyst' AND layer <> 'ops' OR role = 'public' AND layer = 'gold' AS allowed"
    " FROM (VALUES ('admin'), ('steward'), ('analyst'), ('public')) r(role), (VALUES ('bronze', 'trade'), ('silver', 'trade'), ('gold', 'market'), ('ops', 'audit')) t(layer, table_name)"
)
def access_policy_matrix(spark: SparkSession, d: str) -> DataFrame:
    tables = spark.createDataFrame([("bronze", "trade"), ("silver", "trade"), ("gold", "market"), ("ops", "audit")], "layer string, table_name string")
    return governance.policy_matrix(tables)


@query(
    "WITH e AS (SELECT DISTINCT l_shipdate::DATE AS chunk_id, l_returnflag AS run_id FROM lineitem), r AS (SELECT DISTINCT l_shipdate::DATE AS chunk_id, l_returnflag AS run_id FROM lineitem WHERE l_quantity > 45)"
    " SELECT e.run_id, count(*) AS chunks, count(r.chunk_id) AS done, round(count(r.chunk_id) / CAST(count(*) AS DOUBLE), 6) AS ratio, CASE WHEN count(*) = count(r.chunk_id) THEN 'complete' WHEN count(r.chunk_id) > 0 THEN 'partial' ELSE 'failed' END AS status"
    " FROM e LEFT JOIN r ON r.chunk_id = e.chunk_id AND r.run_id = e.run_id GROUP BY e.run_id"
)
def chunk_coverage(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("chunk_id"), F.col("l_returnflag").alias("run_id"), "l_quantity")
    expected = lines.select("run_id", "chunk_id").distinct()
    return governance.chunk_coverage(expected, lines.filter("l_quantity > 45").withColumn("status", F.lit("completed")))


@query(
    "WITH t AS (SELECT s_symbol AS entity, arg_max(trade_price, (batchid, rec_id)) AS v, max(batchid) AS b FROM trade WHERE s_symbol IS NOT NULL AND trade_price IS NOT NULL GROUP BY 1),"
    " m AS (SELECT dm_s_symb AS entity, arg_max(dm_close, (batchid, rec_id)) AS v, max(batchid) AS b FROM daily_market WHERE dm_s_symb IS NOT NULL AND dm_close IS NOT NULL GROUP BY 1)"
    " SELECT t.entity, 'price' AS attribute, 2::BIGINT AS sources, abs(t.v - m.v) AS spread, CAST(abs(t.b - m.b) * 86400 AS BIGINT) AS lag_seconds, abs(t.v - m.v) > 50 AS differs, abs(t.b - m.b) > 1 AS late FROM t JOIN m ON m.entity = t.entity"
)
def cross_source_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    """The last price of a security by its trades against that of the market feed; a batch counts as a day."""

    def last(name: str, symbol: str, value: str) -> DataFrame:
        rows = table(spark, d, name).filter(F.col(symbol).isNotNull() & F.col(value).isNotNull())
        best = rows.groupBy(F.col(symbol).alias("entity")).agg(F.max_by(value, F.struct("batchid", "rec_id")).alias("value"), F.max("batchid").alias("b"))
        return best.select("entity", F.lit("price").alias("attribute"), "value", F.timestamp_seconds(F.col("b") * 86400).alias("at"))

    return audits.compare_sources({"trade": last("trade", "s_symbol", "trade_price"), "market": last("daily_market", "dm_s_symb", "dm_close")}, 50, 86_400)


@query("SELECT s_suppkey FROM supplier EXCEPT SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 49")
def set_except(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select("s_suppkey").subtract(table(spark, d, "lineitem").filter("l_returnflag = 'R' AND l_quantity > 49").select(F.col("l_suppkey").alias("s_suppkey")))


@query("SELECT l_returnflag, l_linestatus, grouping(l_returnflag)::INTEGER AS all_flags, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_linestatus), ())")
def grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return table(spark, d, "lineitem").groupingSets([[flag, status], [status], []], flag, status).agg(F.grouping("l_returnflag").cast("int").alias("all_flags"), F.count(F.lit(1)).alias("n"))


@query("SELECT l_shipdate, l_returnflag, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_shipdate, l_returnflag)")
def rollup_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").rollup("l_shipdate", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query(
    "WITH v AS (SELECT sk_customerid, customerid, tier FROM dim_customer), c AS (SELECT customerid, tier, count(*) AS n FROM v WHERE tier IS NOT NULL GROUP BY ALL), m AS (SELECT customerid, arg_min(tier, (-n, tier)) AS mode FROM c GROUP BY customerid)"
    " SELECT sk_customerid, coalesce(tier, mode) AS filled, tier IS NULL AND mode IS NOT NULL AS is_imputed FROM v LEFT JOIN m ON m.customerid = v.customerid"
)
def impute_mode(spark: SparkSession, d: str) -> DataFrame:
    return windows.mode_fill(table(spark, d, "dim_customer").select("sk_customerid", "customerid", "tier"), "customerid", "tier", "filled").select("sk_customerid", "filled", "is_imputed")


@query(
    "WITH s AS (SELECT customerid, city, CAST(sum(CAST(batchid AS DECIMAL(20,6))) AS DOUBLE) AS w FROM dim_customer WHERE city IS NOT NULL GROUP BY ALL)"
    " SELECT customerid, arg_min(city, (-w, city)) AS city, round(max(w) / sum(w), 6) AS confidence FROM s GROUP BY customerid"
)
def survivorship_weighted(spark: SparkSession, d: str) -> DataFrame:
    return windows.weighted_survivor(table(spark, d, "dim_customer"), "customerid", "city", F.col("batchid"))


@query("SELECT DISTINCT l_suppkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT s_suppkey FROM supplier WHERE s_acctbal > 0")
def set_intersect(spark: SparkSession, d: str) -> DataFrame:
    returned = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select("l_suppkey")
    return returned.intersect(table(spark, d, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey")))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_orders(spark: SparkSession, d: str) -> DataFrame:
    """A top-k report: the limit is the feature."""
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)
