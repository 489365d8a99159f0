from pyspark.sql import functions as F

from lakeq.operators.medallion import gold_aggregate, parse_metrics
from lakeq.sources.lake_table import LakeTable
from lakeq.streaming import streams
from tests.conftest import rows

POLICY = streams.policy_for("api_stream", "ts")


def run(df, mode, name, tmp_path):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name)


def files(spark, tmp_path, data, parts=3):
    events = spark.read.parquet(f"{data}/events.parquet")
    events.orderBy("ts").repartitionByRange(parts, "ts").write.parquet(str(tmp_path / "in"))
    return str(tmp_path / "in"), f"{data}/events.parquet"


def test_policy():
    assert (POLICY.watermark, streams.policy_for("batch", "ts").watermark) == ("2 hours", "24 hours")


def test_windows_match_the_batch_but_for_open_ones(spark, tmp_path, data):
    path, like = files(spark, tmp_path, data)
    metrics = parse_metrics("count:*,sum:value")
    out = run(streams.windowed_gold(streams.parquet_stream(spark, path, like, "ts"), POLICY, ["event_type"], metrics), "append", "gold", tmp_path)
    batch = gold_aggregate(spark.read.parquet(like).withColumn("ts", F.col("ts").cast("timestamp")), ["event_type"], metrics, "ts")
    streamed = set(rows(out))
    assert streamed <= set(rows(batch)) and len(streamed) > 0.9 * batch.count()


def test_duplicates_go_once(spark, tmp_path, data):
    path, like = files(spark, tmp_path, data)
    spark.read.parquet(path).write.mode("append").parquet(path + "2")
    spark.read.parquet(path).write.mode("append").parquet(path + "2")
    out = run(streams.deduplicated(streams.parquet_stream(spark, path + "2", like, "ts"), streams.policy_for("batch", "ts"), ["event_id"]), "append", "dedup", tmp_path)
    assert out.count() == out.select("event_id").distinct().count() > 0


def test_upserts_and_late_rows(spark, tmp_path, data):
    path, like = files(spark, tmp_path, data)
    table = LakeTable(spark, str(tmp_path / "t"))
    stream = streams.parquet_stream(spark, path, like, "ts", files_per_trigger=1)
    stream.writeStream.foreachBatch(streams.upsert_into(table, ["user_id"], ["ts", "event_id"])).option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start().awaitTermination(120)
    events = spark.read.parquet(like)
    assert table.read().count() == events.select("user_id").distinct().count()
    route = streams.route_late(str(tmp_path / "routed"), POLICY)
    stream.writeStream.foreachBatch(route).option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start().awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "routed" / "rows")).count() == events.count()


def test_the_mark_of_late_rows_outlives_the_stream(spark, tmp_path):
    at = lambda *hours: spark.createDataFrame([(h,) for h in hours], "h int").select(F.expr("timestamp_seconds(h * 3600)").alias("ts"), "h")
    path = str(tmp_path / "r")
    streams.route_late(path, POLICY)(at(10, 1), 0)
    for _ in range(2):  # a new process, and a batch that runs twice
        streams.route_late(path, POLICY)(at(9, 7), 1)
    streams.route_late(path, POLICY)(at(8), 2)
    got = spark.read.parquet(f"{path}/rows")
    assert rows(got.select("batch", "h", F.col("is_late").cast("boolean"))) == [(0, 1, False), (0, 10, False), (1, 7, True), (1, 9, False), (2, 8, False)]


def test_sliding_and_session_windows(spark, tmp_path, data):
    path, like = files(spark, tmp_path, data)
    slid = run(streams.sliding_counts(streams.parquet_stream(spark, path, like, "ts"), POLICY, "event_type", "2 hours", "1 hour"), "append", "slid", tmp_path)
    assert slid.count() > 0
    sess = run(streams.sessions(streams.parquet_stream(spark, path, like, "ts"), POLICY, "user_id", "30 minutes"), "append", "sess", tmp_path)
    assert sess.count() > 0
