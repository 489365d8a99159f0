"""Governance tables: quarantine, dead letters, decisions, policy, watermarks, lineage, manifests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def quarantine_records(df: DataFrame, dataset: str, layer: str, reason: Column, key: Column, batch: Column, at: Column, severity: str = "high") -> DataFrame:
    """Append-only quarantine rows with the rejected row as JSON."""
    raw = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    return df.select(
        F.sha2(F.concat_ws("|", F.lit(dataset), key.cast("string"), reason, raw), 256).alias("quarantine_id"), reason.alias("quarantine_reason"), F.lit(dataset).alias("dataset"),
        F.lit(layer).alias("layer"), key.cast("string").alias("record_key"), batch.cast("string").alias("batch_id"), at.alias("quarantined_at"),
        F.lit(severity).alias("severity"), F.lit("open").alias("status"), F.lit("quarantined").alias("action_taken"), raw.alias("raw_payload"),
    )


def quarantine_summary(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("dataset", "quarantine_reason").agg(F.count(F.lit(1)).alias("rows"), F.min("record_key").alias("first_key"))


def backoff_seconds(attempt: Column, base: float = 1.0, most: float = 60.0) -> Column:
    """Delay before the attempt after this one, doubling up to a bound; jitter is added where it is scheduled."""
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(2.0), attempt - 1))


def dlq_record(failed: DataFrame, source: str, error: Column, at: Column) -> DataFrame:
    """Dead letters of rows: entry_id, source, error, payload, status, attempts, captured_at, next_retry."""
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in failed.columns]), {"ignoreNullFields": "false"})
    return failed.select(
        F.sha2(F.concat_ws("|", F.lit(source), error, body), 256).alias("entry_id"), F.lit(source).alias("source"), error.alias("error"), body.alias("payload"),
        F.lit("pending").alias("status"), F.lit(0).alias("attempts"), at.alias("captured_at"), F.lit(None).cast("timestamp").alias("next_retry"),
    )


def dlq_archive(dlq: DataFrame, now: Column, days: int) -> tuple[DataFrame, DataFrame]:
    """(letters that stay, letters to archive): captured more than ``days`` days ago and no longer pending."""
    old = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("captured_at").cast("timestamp")) > days * 86_400_000_000) & (F.col("status") != "pending")
    gone = F.coalesce(old, F.lit(False))
    return dlq.filter(~gone), dlq.filter(gone)


def dlq_due(dlq: DataFrame, now: Column, max_attempts: int = 3, limit: int = 100) -> DataFrame:
    """The next letters to try again: pending, due, attempts left, oldest first. The limit is the batch size of a replay."""
    ready = dlq.filter((F.col("status") == "pending") & (F.col("attempts") < max_attempts) & (F.col("next_retry").isNull() | (F.col("next_retry") <= now)))
    return ready.orderBy("captured_at", "entry_id").limit(limit)


def dlq_after(dlq: DataFrame, succeeded: Column, now: Column, max_attempts: int = 3) -> DataFrame:
    """The letters after a replay: resolved, pending with a later retry, or exhausted."""
    tried = F.col("attempts") + 1
    status = F.when(succeeded, "resolved").when(tried >= max_attempts, "exhausted").otherwise("pending")
    wait = F.timestamp_micros(F.unix_micros(now.cast("timestamp")) + (backoff_seconds(tried) * 1_000_000).cast("bigint"))
    return dlq.withColumns({"attempts": tried, "status": status, "next_retry": F.when(status == "pending", wait)})


def dlq_stats(dlq: DataFrame, statuses: list[str]) -> DataFrame:
    """Letters per source and status; the statuses are named, so no pass looks for them."""
    return dlq.groupBy("source").pivot("status", statuses).agg(F.count(F.lit(1))).na.fill(0)


def decide(evidence: DataFrame) -> DataFrame:
    """Adds decision and confidence by the first rule that holds.

    Evidence: status, violations, schema_valid, breaking, missing, duplicates, fresh, quarantined, records.
    """
    rules = [
        ((F.col("status") == "failed") | (F.col("violations") > 0) | ~F.col("schema_valid"), "FAIL", 0.92),
        (F.col("breaking"), "FAIL", 0.90),
        ((F.col("missing") > 0.15) | (F.col("duplicates") > 0.05) | (F.col("fresh") < 0.7), "WARNING", 0.86),
        ((F.col("quarantined") > 0) & (F.col("records") > F.col("quarantined")), "WARNING", 0.84),
        (F.col("quarantined") > 0, "FAIL", 0.88),
        (F.lit(True), "PASS", 0.88),
    ]
    decision, confidence = F.when(rules[0][0], rules[0][1]), F.when(rules[0][0], rules[0][2])
    for when, what, sure in rules[1:]:
        decision, confidence = decision.when(when, what), confidence.when(when, sure)
    return evidence.withColumn("decision", decision).withColumn("confidence", confidence)


# -- access --------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Grant:
    """A role may read the layers, but for denied tables. ``*`` stands for all."""

    role: str
    layers: tuple[str, ...]
    denied: tuple[str, ...] = ()


GRANTS = (Grant("admin", ("*",)), Grant("steward", ("*",)), Grant("analyst", ("bronze", "silver", "gold")), Grant("public", ("gold",)))


def may_read(role: str, layer: str, table: str, grants: tuple[Grant, ...] = GRANTS) -> bool:
    """No grant, no access; a denial beats a grant."""
    own = [g for g in grants if g.role == role]
    return not any(table in g.denied for g in own) and any("*" in g.layers or layer in g.layers for g in own)


def policy_matrix(tables: DataFrame, grants: tuple[Grant, ...] = GRANTS) -> DataFrame:
    """role, layer, table_name, allowed for a table list (layer, table_name): roles are a handful of literals."""
    roles = F.array(*[F.struct(F.lit(g.role).alias("role"), F.array(*map(F.lit, g.layers)).alias("layers"), F.array(*map(F.lit, g.denied)).cast("array<string>").alias("denied")) for g in grants])
    spread = tables.select("layer", "table_name", F.inline(roles))
    allowed = ~F.array_contains("denied", F.col("table_name")) & (F.array_contains("layers", "*") | F.array_contains("layers", F.col("layer")))
    return spread.groupBy("role", "layer", "table_name").agg(F.max(allowed).alias("allowed"))


# -- watermarks and late data --------------------------------------------------------------------------


def watermarks(df: DataFrame, source: str, at: str) -> DataFrame:
    return df.groupBy(source).agg(F.max(at).alias("watermark"), F.count(F.lit(1)).alias("rows"))


def advance(old: DataFrame, new: DataFrame, source: str) -> DataFrame:
    """The later watermark of each source: never backwards."""
    both = old.select(source, "watermark").unionByName(new.select(source, "watermark"))
    return both.groupBy(source).agg(F.max("watermark").alias("watermark"))


def gaps(marks: DataFrame, now: Column, threshold_minutes: int = 30) -> DataFrame:
    """Whole minutes since each watermark and whether a backfill is due."""
    minutes = F.floor((F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("watermark").cast("timestamp"))) / 60_000_000)
    return marks.withColumn("gap_minutes", minutes).withColumn("needs_backfill", minutes > threshold_minutes)


#: Arrivals of a block, about, and blocks whose maxima are folded into one.
LATE_BLOCK, LATE_FAN = 65_536, 1024


def split_late(df: DataFrame, at: str, lateness_seconds: int, order: str) -> DataFrame:
    """Adds is_late: the row is older than the latest row before it less the lateness.

    ``order`` numbers arrivals, which are cut into blocks by their spread. The running maximum is built from block
    maxima, and those from maxima of groups of blocks, so no window holds more than ``LATE_FAN`` blocks of a group.
    """
    from pyspark.sql import Window

    low, high, n = df.agg(F.min(order), F.max(order), F.count(order)).first()
    width = max(1, int(LATE_BLOCK * ((high or 0) - (low or 0) + 1) / max(n, 1)))
    placed = df.withColumn("_at", F.unix_micros(F.col(at).cast("timestamp"))).withColumn("_block", F.floor((F.col(order) - F.lit(low or 0)) / width))
    maxima = placed.groupBy("_block").agg(F.max("_at").alias("_top")).withColumn("_group", F.floor(F.col("_block") / LATE_FAN))
    before = lambda *by: Window.partitionBy(*[F.lit(0), *by]).orderBy(F.col("_block") if by else F.col("_group")).rowsBetween(Window.unboundedPreceding, -1)
    groups = maxima.groupBy("_group").agg(F.max("_top").alias("_g")).withColumn("_outer", F.max("_g").over(before())).drop("_g")
    known = maxima.join(groups, "_group").withColumn("_before", F.greatest(F.max("_top").over(before("_group")), F.col("_outer"))).select("_block", "_before")
    inner = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    seen = placed.join(known, "_block").withColumn("_seen", F.greatest(F.max("_at").over(inner), F.col("_before")))
    return seen.withColumn("is_late", F.col("_at") < F.col("_seen") - lateness_seconds * 1_000_000).drop("_at", "_block", "_before", "_seen")


# -- runs ----------------------------------------------------------------------------------------------


def chunk_coverage(expected: DataFrame, results: DataFrame) -> DataFrame:
    """Per run: chunks, done, ratio, status. A chunk without result counts as failed."""
    latest = results.groupBy("run_id", "chunk_id").agg(F.max(F.col("status") == "completed").alias("done"))
    joined = expected.join(latest, ["run_id", "chunk_id"], "left")
    out = joined.groupBy("run_id").agg(F.count(F.lit(1)).alias("chunks"), F.count_if(F.coalesce("done", F.lit(False))).alias("done"))
    return out.withColumn("ratio", F.round(F.col("done") / F.col("chunks"), 6)).withColumn(
        "status", F.when(F.col("done") == F.col("chunks"), "complete").when(F.col("done") > 0, "partial").otherwise("failed")
    )


def pending_chunks(expected: DataFrame, results: DataFrame) -> DataFrame:
    """The chunks a resumed run still has to do."""
    return expected.join(results.filter(F.col("status") == "completed"), ["run_id", "chunk_id"], "left_anti")


def lineage_event(spark: SparkSession, job: str, run_id: str, inputs: list[str], outputs: list[str], state: str = "COMPLETE") -> DataFrame:
    """One run event: job, run, state, input and output data sets."""
    return spark.createDataFrame([(job, run_id, state, inputs, outputs)], "job string, run_id string, event_type string, inputs array<string>, outputs array<string>").withColumn("event_time", F.current_timestamp())


def event(df: DataFrame, stream: str, dataset: str) -> DataFrame:
    """Rows as governance events of one stream (audit, quality_metrics, lineage, schema_history, ...)."""
    return df.select(F.lit(stream).alias("stream"), F.lit(dataset).alias("dataset"), F.current_timestamp().alias("event_time"), F.to_json(F.struct("*")).alias("payload"))


def latest_events(events: DataFrame, stream: str, n: int = 20) -> DataFrame:
    """The last ``n`` events of a stream."""
    return events.filter(F.col("stream") == stream).orderBy(F.desc("event_time")).limit(n)


def throughput(rows: int, seconds: float, units: float) -> dict[str, float]:
    """Rows a second, and data units an hour of a run."""
    return {"rows_per_second": rows / seconds if seconds else 0.0, "units_per_hour": units / (seconds / 3600) if seconds else 0.0}
