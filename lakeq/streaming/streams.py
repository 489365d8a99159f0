"""Structured Streaming forms of the batch operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeq.operators.medallion import Metric, gold_aggregate


@dataclass(frozen=True)
class LateDataPolicy:
    """What a stream does with time: watermark, allowed lateness, window, and where late rows go."""

    event_time: str
    watermark: str
    lateness_seconds: int
    action: str = "retain_for_reprocess"
    window: str = "1 hour"


def policy_for(source_type: str, event_time: str) -> LateDataPolicy:
    """Two hours for live feeds, a day for everything else."""
    hours = 2 if source_type in ("api_stream", "gtfs_realtime") else 24
    return LateDataPolicy(event_time, f"{hours} hours", hours * 3600)


def parquet_stream(spark: SparkSession, path: str, like: str, event_time: str, files_per_trigger: int = 16) -> DataFrame:
    """A stream of Parquet files with the schema of ``like``; the event time as an instant."""
    schema = spark.read.parquet(like).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return stream.withColumn(event_time, F.col(event_time).cast("timestamp"))


def windowed_gold(stream: DataFrame, policy: LateDataPolicy, dimensions: list[str], metrics: list[Metric]) -> DataFrame:
    """The windowed gold aggregate over a stream; a window comes out once the watermark has passed it."""
    return gold_aggregate(stream, dimensions, metrics, policy.event_time, policy.window, policy.watermark)


def sliding_counts(stream: DataFrame, policy: LateDataPolicy, key: str, length: str, slide: str) -> DataFrame:
    return stream.withWatermark(policy.event_time, policy.watermark).groupBy(F.window(policy.event_time, length, slide), key).agg(F.count(F.lit(1)).alias("n"))


def sessions(stream: DataFrame, policy: LateDataPolicy, key: str, gap: str) -> DataFrame:
    return stream.withWatermark(policy.event_time, policy.watermark).groupBy(F.session_window(policy.event_time, gap), key).agg(F.count(F.lit(1)).alias("n"))


def deduplicated(stream: DataFrame, policy: LateDataPolicy, keys: list[str]) -> DataFrame:
    """The first row of each key; state is kept as long as the watermark says."""
    return stream.withWatermark(policy.event_time, policy.watermark).dropDuplicatesWithinWatermark(keys)


def upsert_into(table, keys: list[str], order: list[str]):
    """A ``foreachBatch`` function that merges each micro-batch; running a batch twice changes nothing."""

    def run(batch: DataFrame, _: int) -> None:
        table.merge(batch, keys, order)

    return run


def stored_mark(spark: SparkSession, path: str, before: int):
    """The latest event time of all batches before one, as stored by the last of them; None where there is none."""
    if before <= 0:
        return None
    try:
        return spark.read.schema("at timestamp").parquet(f"{path}/marks/batch={before - 1}").first()["at"]
    except AnalysisException:  # no batch before this one was routed
        return None


def route_late(path: str, policy: LateDataPolicy):
    """A ``foreachBatch`` function that writes each row once, under ``path``/rows/batch=N/is_late=..., and the batch's mark.

    A row is late if it lies beyond the lateness before the latest of all earlier batches. The mark is stored beside
    the rows, so a restart goes on where the stream stopped, and running a batch again gives the same files.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark, rows = batch.sparkSession, f"{path}/rows/batch={number}"
        seen = stored_mark(spark, path, number)
        mark = F.lit(seen).cast("timestamp") - F.expr(f"INTERVAL {policy.lateness_seconds} SECONDS")
        is_late = F.lit(False) if seen is None else F.coalesce(F.col(policy.event_time) < mark, F.lit(False))
        batch.withColumn("is_late", is_late).write.mode("overwrite").partitionBy("is_late").parquet(rows)
        written = spark.read.schema(f"{policy.event_time} timestamp").parquet(rows)
        top = written.agg(F.greatest(F.max(policy.event_time), F.lit(seen).cast("timestamp")).alias("at"))
        top.coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/batch={number}")

    return run
