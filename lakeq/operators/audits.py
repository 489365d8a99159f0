"""Warehouse audits: keys, references, histories, counts, checksums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeq.functions.scalars import audit_bool, is_blank, record_hash, safe_str
from lakeq.operators.windows import last_known

OPEN_END = "9999-12-31"


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose reference (trimmed, lower case, neither '' nor '0') is no parent key."""
    keyed = child.withColumn("_fk", safe_str(F.col(fk))).filter(~F.col("_fk").isin("", "0"))
    return keyed.join(parent.select(safe_str(F.col(pk)).alias("_fk")).distinct(), "_fk", "left_anti").drop("_fk")


def repeated_keys(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Every row beyond the first of its key, and rows with a blank key part, with the reason.

    Keys that occur once are set aside by a partial aggregate, so only repeated ones are sorted.
    """
    blank = F.lit(False)
    for k in keys:
        blank = blank | is_blank(F.col(k))
    missing = df.filter(blank).withColumn("reason", F.lit("missing_key"))
    full = df.filter(~blank)
    many = full.groupBy(*keys).count().filter("count > 1").drop("count")
    w = Window.partitionBy(*keys).orderBy(*order)
    repeated = full.join(many, keys, "left_semi").withColumn("_n", F.row_number().over(w)).filter("_n > 1").drop("_n").withColumn("reason", F.lit("repeated_key"))
    return missing.unionByName(repeated)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, n of each table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def reconcile(source: DataFrame, warehouse: DataFrame) -> DataFrame:
    """table_name, source_rows, warehouse_rows, delta over both lists of counts."""
    both = source.withColumnRenamed("n", "source_rows").join(warehouse.withColumnRenamed("n", "warehouse_rows"), "table_name", "full")
    filled = both.na.fill(0, ["source_rows", "warehouse_rows"])
    return filled.withColumn("delta", F.col("warehouse_rows") - F.col("source_rows"))


def table_checksum(df: DataFrame) -> DataFrame:
    """n, checksum of the rows in any order: sums of 60-bit slices of the row hashes, never a sorted list."""
    h = record_hash(*df.columns)
    parts = [F.conv(F.substring(h, at, 15), 16, 10).cast("decimal(20,0)") for at in (1, 16, 31, 46)]
    sums = [F.coalesce(F.sum(p), F.lit(0)).cast("string") for p in parts]
    return df.agg(F.count(F.lit(1)).alias("n"), F.sha2(F.concat_ws(",", *sums), 256).alias("checksum"))


def versioned(changes: DataFrame, key: str, effective: str, order: list[str]) -> DataFrame:
    """Versions of a change log: enddate is the next change, the last one is current."""
    w = Window.partitionBy(key).orderBy(effective, *order)
    return changes.withColumn("enddate", F.lead(effective).over(w)).withColumn("iscurrent", F.col("enddate").isNull())


def version_audit(df: DataFrame, key: str, current: str = "iscurrent", effective: str = "effectivedate", end: str = "enddate") -> DataFrame:
    """violation, rows of a history: one current version per key, closed others, no blank start."""
    is_current = audit_bool(F.col(current))
    per_key = df.groupBy(safe_str(F.col(key)).alias("k")).agg(F.count_if(is_current).alias("n")).filter("n <> 1")
    keys = per_key.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("not_one_current").alias("violation"), "rows")
    open_end = safe_str(F.col(end)).isin("", OPEN_END)
    rows = df.agg(F.count_if(~is_current & open_end).alias("a"), F.count_if(is_blank(F.col(effective))).alias("b"))
    return keys.unionByName(
        rows.select(F.inline(F.array(F.struct(F.lit("closed_without_end").alias("violation"), F.col("a").alias("rows")), F.struct(F.lit("blank_start").alias("violation"), F.col("b").alias("rows")))))
    )


def presence_violations(df: DataFrame, key: str, status: Column, other: DataFrame, other_key: str, must: Column, must_not: Column) -> DataFrame:
    """Rows whose status demands a partner that is not there, or forbids one that is."""
    there = other.select(F.col(other_key).alias(key)).distinct().withColumn("_there", F.lit(True))
    flagged = df.withColumn("_must", must).withColumn("_not", must_not).filter("_must OR _not")
    joined = flagged.join(there, key, "left").withColumn("_there", F.coalesce("_there", F.lit(False)))
    kind = F.when(F.col("_must") & ~F.col("_there"), "missing_partner").when(F.col("_not") & F.col("_there"), "forbidden_partner")
    return joined.select(key, status.alias("status"), kind.alias("violation")).filter("violation IS NOT NULL")


def flag_against_match(df: DataFrame, flag: str, other: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose boolean disagrees with whether a row of ``other`` matches on normalised columns."""
    keys = [f"_k{i}" for i in range(len(on))]
    left = df.select("*", *[safe_str(F.col(a)).alias(k) for k, a in zip(keys, on)])
    right = other.select(*[safe_str(F.col(b)).alias(k) for k, b in zip(keys, on.values())]).distinct().withColumn("_match", F.lit(True))
    joined = left.join(right, keys, "left").withColumn("_match", F.coalesce("_match", F.lit(False)))
    marked = audit_bool(F.col(flag))
    kind = F.when(marked & ~F.col("_match"), "marked_without_match").when(~marked & F.col("_match"), "match_not_marked")
    return joined.withColumn("violation", kind).filter("violation IS NOT NULL").drop("_match", *keys)


def version_as_of(facts: DataFrame, key: str, at: str, versions: DataFrame, version_key: str, start: str, end: str, take: list[str]) -> DataFrame:
    """Facts with the columns of the version valid at their time: start <= time < end, null end open.

    Versions of a key do not overlap; of several with one start the one that ends last counts. Facts and versions are
    swept together in the order of time, in blocks (``windows.last_known``): no fact meets more than one version, and a
    key with a third of all rows is swept in many tasks. Facts without a version keep nulls.
    """
    version = F.struct(F.col(end).cast("timestamp").alias("to"), *[F.col(c) for c in take])
    far = F.lit("9999-12-31").cast("timestamp")
    marks = versions.select(F.col(version_key).alias("_k"), F.col(start).cast("timestamp").alias("_at"), F.lit(0).alias("_tag"), F.coalesce(F.col(end).cast("timestamp"), far).alias("_to"), version.alias("_v"))
    rows = facts.select(F.col(key).alias("_k"), F.col(at).cast("timestamp").alias("_at"), F.lit(1).alias("_tag"), far.alias("_to"), F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("_row"))
    swept = last_known(marks.unionByName(rows, allowMissingColumns=True), "_k", ["_at", "_tag", "_to"], "_v", "_now").filter("_tag = 1")
    valid = F.col("_k").isNotNull() & F.col("_at").isNotNull() & (F.col("_now.to").isNull() | (F.col("_at") < F.col("_now.to")))
    return swept.select("_row.*", *[F.when(valid, F.col(f"_now.{c}")).alias(c) for c in take])


# Child table -> references as column=parent.key.
FOREIGN_KEYS = {
    "dim_account": "sk_customerid=dim_customer.sk_customerid sk_brokerid=dim_broker.sk_brokerid",
    "dim_security": "sk_companyid=dim_company.sk_companyid",
    "dim_company": "industryid=industry.in_id",
    "dim_trade": "sk_accountid=dim_account.sk_accountid sk_securityid=dim_security.sk_securityid sk_companyid=dim_company.sk_companyid sk_closed_customerid=dim_customer.sk_customerid sk_traded_customerid=dim_customer.sk_customerid",
    "fact_cash_balances": "sk_customerid=dim_customer.sk_customerid sk_accountid=dim_account.sk_accountid sk_date=dim_date.sk_date",
    "fact_holdings": "sk_tradeid=dim_trade.sk_tradeid sk_customerid=dim_customer.sk_customerid sk_accountid=dim_account.sk_accountid sk_securityid=dim_security.sk_securityid sk_companyid=dim_company.sk_companyid sk_closedate=dim_date.sk_date sk_closetime=dim_time.sk_time",
    "fact_market_history": "sk_securityid=dim_security.sk_securityid sk_companyid=dim_company.sk_companyid sk_date=dim_date.sk_date sk_fifty_two_week_high_date=dim_date.sk_date sk_fifty_two_week_low_date=dim_date.sk_date",
    "fact_watches": "sk_customerid=dim_customer.sk_customerid sk_securityid=dim_security.sk_securityid sk_closedate=dim_date.sk_date",
    "prospect": "sk_recorddateid=dim_date.sk_date sk_updatedateid=dim_date.sk_date",
}


def edges(keys: dict[str, str]) -> list[tuple[str, str, str, str]]:
    """(child, column, parent, key) of every reference."""
    return [(child, c, *target.split(".")) for child, text in keys.items() for c, _, target in (r.partition("=") for r in text.split())]


def orphan_audit(tables: dict[str, DataFrame], keys: dict[str, str]) -> DataFrame:
    """child_table, fk_column, parent_table, fk_value, rows: the orphans of every edge whose tables and columns are there.

    References are counted per value before they meet the keys, so rows move only as distinct values.
    """
    out = None
    for child, column, parent, key in edges(keys):
        if child not in tables or parent not in tables or column not in tables[child].columns or key not in tables[parent].columns:
            continue
        counted = tables[child].groupBy(safe_str(F.col(column)).alias("fk_value")).agg(F.count(F.lit(1)).alias("rows")).filter(~F.col("fk_value").isin("", "0"))
        lost = counted.join(tables[parent].select(safe_str(F.col(key)).alias("fk_value")).distinct(), "fk_value", "left_anti")
        one = lost.select(F.lit(child).alias("child_table"), F.lit(column).alias("fk_column"), F.lit(parent).alias("parent_table"), "fk_value", "rows")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no edge has both of its tables")
    return out


def overlap(left: DataFrame, right: DataFrame, on: dict[str, str]) -> DataFrame:
    """matches: the distinct normalised keys of ``left`` that ``right`` has too; blank keys count for nothing."""
    mine = left.select(*[safe_str(F.col(a)).alias(f"k{i}") for i, a in enumerate(on)]).distinct().filter(" OR ".join(f"k{i} <> ''" for i in range(len(on))))
    theirs = right.select(*[safe_str(F.col(b)).alias(f"k{i}") for i, b in enumerate(on.values())]).distinct()
    return mine.join(theirs, [f"k{i}" for i in range(len(on))], "left_semi").agg(F.count(F.lit(1)).alias("matches"))


def compare_sources(sources: dict[str, DataFrame], threshold: float, max_lag_seconds: int) -> DataFrame:
    """entity, attribute, sources, spread, lag_seconds, differs, late of (entity, attribute, value, at) from several sources.

    The latest value of each source counts; ``spread`` is the greatest difference between sources, ``lag_seconds`` that of their times.
    """
    rows = None
    for name, df in sources.items():
        one = df.groupBy("entity", "attribute").agg(F.max_by("value", "at").alias("value"), F.max("at").alias("at")).withColumn("source", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    seconds = F.unix_micros(F.col("at").cast("timestamp"))
    out = rows.groupBy("entity", "attribute").agg(
        F.count(F.lit(1)).alias("sources"), (F.max("value") - F.min("value")).alias("spread"), F.floor((F.max(seconds) - F.min(seconds)) / 1_000_000).alias("lag_seconds")
    )
    return out.filter("sources > 1").withColumn("differs", F.coalesce(F.col("spread") > threshold, F.lit(False))).withColumn("late", F.coalesce(F.col("lag_seconds") > max_lag_seconds, F.lit(False)))


def baselines(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, record_count, field_count, fields of each table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(name).alias("table_name"), "record_count", F.lit(len(df.columns)).alias("field_count"), F.lit(",".join(df.columns)).alias("fields"))
        out = one if out is None else out.unionByName(one)
    return out


def pre_aggregate(df: DataFrame, keys: list[str], sums: list[str], order: list[str]) -> DataFrame:
    """One row per key: amounts summed, all other columns those of the first row by ``order``."""
    rest = [c for c in df.columns if c not in (*keys, *sums)]
    totals = [F.sum(F.col(c).cast("decimal(28,4)")).cast("double").alias(c) for c in sums]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first") if rest else F.lit(None).alias("_first")
    return df.groupBy(*keys).agg(*totals, first).select(*keys, *sums, *[F.col(f"_first.{c}").alias(c) for c in rest]).select(*df.columns)


def audit_summary(audits: dict[str, DataFrame]) -> DataFrame:
    """audit, violations, passed of several lists of violations, and ``overall`` over all of them."""
    out = None
    for name, df in audits.items():
        one = df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("audit"), "violations")
        out = one if out is None else out.unionByName(one)
    total = out.agg(F.sum("violations").alias("violations")).select(F.lit("overall").alias("audit"), "violations")
    return out.unionByName(total).withColumn("passed", F.col("violations") == 0)
