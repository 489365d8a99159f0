"""Session, table access and the shared folder that cuts lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benches; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lakeq")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; set only where the session names none."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakeq-checkpoint-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it from there: short lineage that outlives executors."""
    folder = shared_dir(df.sparkSession)
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def cut_unsized(df: DataFrame) -> DataFrame:
    """``cut`` without the estimate of the size, which a checkpoint keeps: only sizes that AQE has measured allow a broadcast.

    Estimates are of the compressed files and leave out what an explode adds. In a loop they must go because joins
    multiply them, so that their digits double each round until they fill the driver.
    """
    spark, done = df.sparkSession, cut(df)
    return DataFrame(spark._jsparkSession.createDataFrame(done._jdf.toJavaRDD(), done._jdf.schema()), spark)


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Rows of a small metadata table on the driver; more than ``limit`` is an error, never a silent cut."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} rows; it is meant to be metadata")
    return rows


#: Rows of a few narrow columns that may be broadcast, some 100 MB at most.
MAX_BROADCAST_ROWS = 1_000_000


def small_side(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` (cheap to count: a cut table or metadata) with a broadcast hint if its counted rows allow, else without."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def with_defaults(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Only the named columns, the missing ones as typed nulls: extra or clashing columns do no harm."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{have[name.lower()]}`") if name.lower() in have else F.lit(None)).cast(kind).alias(name)
            for name, kind in columns.items()
        ]
    )
