"""A versioned Parquet table with idempotent, null-safe upserts.

A version is a numbered commit file that lists the data folders it consists of. Data is written first, to a folder
of its own; then the commit file is written under another name and renamed to the next number, which fails if that
number is taken. Nothing is deleted on the way: a crash anywhere leaves the version before, and of two writers that
began from one version the second gets ``ConflictError``. An append adds a folder and rewrites nothing. The file system
is reached through the JVM, so this class needs a classic session (not Spark Connect). On a catalog with row-level
operations use its MERGE.
"""

from __future__ import annotations

import json
import re
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeq.operators.windows import keep_best

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def safe_identifier(name: str) -> str:
    """The name, if it needs no quoting anywhere; else an error."""
    if not _NAME.fullmatch(name):
        raise ValueError(f"unsafe identifier {name!r}")
    return name


def merge_condition(keys: list[str], target: str = "target", source: str = "source") -> str:
    """Null-safe equality of all keys."""
    return " AND ".join(f"{target}.{safe_identifier(k)} <=> {source}.{safe_identifier(k)}" for k in keys)


def resolve_keys(df: DataFrame, preferred: list[str], record_id: str = "_record_id") -> list[str]:
    """The preferred keys that exist, else the record id, else none."""
    keys = [k for k in preferred if k in df.columns]
    return keys or ([record_id] if record_id in df.columns else [])


def merged(target: DataFrame, source: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``target`` with the rows of ``source`` put in its place; of several source rows of a key the latest by ``order``.

    Columns that only one side has are null on the other.
    """
    latest = keep_best(source, keys, *[F.col(o) for o in order])
    marks = latest.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    kept = target.join(marks, same, "left_anti")
    return kept.unionByName(latest, allowMissingColumns=True)


class ConflictError(RuntimeError):
    """Another writer has committed the version this one was about to."""


class LakeTable:
    """A table under ``path`` (any Hadoop file system with atomic rename)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._hadoop(self.path).getFileSystem(self._conf)

    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _names(self, folder: str) -> list[str]:
        at = self._hadoop(f"{self.path}/{folder}")
        return [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def version(self) -> int:
        """The current version, 0 where there is none."""
        return max((int(n) for n in self._names("_commits") if n.isdigit()), default=0)

    def folders(self, version: int | None = None) -> list[str]:
        """The data folders of a version (the current one)."""
        version = self.version() if version is None else version
        if not version:
            return []
        stream = self._fs.open(self._hadoop(f"{self.path}/_commits/{version}"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        paths = [f"{self.path}/{f}" for f in self.folders(version)]
        if not paths:
            raise FileNotFoundError(f"no table at {self.path}")
        parts = [self.spark.read.parquet(p) for p in paths]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def write_data(self, df: DataFrame, partition_by: list[str]) -> str:
        """Writes a data folder that no version holds yet; its name."""
        name = f"data-{uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(f"{self.path}/{name}")
        return name

    def commit(self, folders: list[str], after: int) -> int:
        """Makes ``folders`` the version that follows ``after``."""
        waiting = self._hadoop(f"{self.path}/_commits/.{uuid.uuid4().hex}")
        stream = self._fs.create(waiting, False)
        stream.write(bytearray(json.dumps(folders).encode()))
        stream.close()
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        target = self._hadoop(f"{self.path}/_commits/{after + 1}")
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf).rename(waiting, target, options)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                raise ConflictError(f"version {after + 1} of {self.path} was committed by another writer") from None
            raise
        return after + 1

    def replace(self, df: DataFrame, partition_by: list[str] | None = None) -> None:
        before = self.version()
        self.commit([self.write_data(df, partition_by or [])], before)

    def append(self, df: DataFrame) -> None:
        before = self.version()
        self.commit([*self.folders(before), self.write_data(df, [])], before)

    def compact(self) -> None:
        """The current rows in one folder."""
        self.replace(self.read())

    def vacuum(self, keep: int = 2) -> int:
        """Deletes the data folders that none of the last ``keep`` versions holds; only while no writer is at work."""
        current = self.version()
        kept = {f for v in range(max(1, current - keep + 1), current + 1) for f in self.folders(v)}
        gone = [n for n in self._names("") if n.startswith("data-") and n not in kept]
        for name in gone:
            self._fs.delete(self._hadoop(f"{self.path}/{name}"), True)
        return len(gone)

    def merge(self, source: DataFrame, keys: list[str], order: list[str] | None = None) -> list[str]:
        """Upsert by the keys that exist; without any, append. Returns the keys used."""
        used = resolve_keys(source, keys)
        for k in used:
            safe_identifier(k)
        order = order or sorted(c for c in source.columns if c not in used)
        before = self.version()
        if not used:
            self.append(source)
        elif not before:
            self.commit([self.write_data(keep_best(source, used, *[F.col(o) for o in order]), [])], before)
        else:
            self.commit([self.write_data(merged(self.read(before), source, used, order), [])], before)
        return used


def write_partitioned(df: DataFrame, path: str, key: str, parts: int, fmt: str = "json") -> None:
    """Rows spread over ``parts`` folders by a hash of their key."""
    placed = df.withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)))
    placed.repartition(parts, "part").write.mode("overwrite").partitionBy("part").format(fmt).save(path)


def export(df: DataFrame, path: str, fmt: str) -> None:
    """csv (with header), json, parquet or orc."""
    if fmt not in ("csv", "json", "parquet", "orc"):
        raise ValueError(f"no sink for {fmt}")
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)
