"""Schema versions of data sets, kept in a table: numbered, approved or not, compared by name."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeq.operators.drift import fingerprint
from lakeq.session import bounded_rows
from lakeq.sources.lake_table import LakeTable

ROW = "dataset string, number int, version string, schema_json string, status string, registered_at timestamp"
#: Versions of one data set; schemas are metadata.
MAX_VERSIONS = 100_000


class SchemaStore:
    """Versions ``v{n}_{fingerprint}`` in a versioned table; the same schema again is no new version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.table = spark, LakeTable(spark, path)

    def rows(self) -> DataFrame:
        return self.table.read() if self.table.version() else self.spark.createDataFrame([], ROW)

    def versions(self, dataset: str) -> list:
        return sorted(bounded_rows(self.rows().filter(F.col("dataset") == dataset), MAX_VERSIONS, "schema versions"), key=lambda r: r["number"])

    def register(self, dataset: str, schema: T.StructType, status: str = "draft") -> str:
        known, mark = self.versions(dataset), fingerprint(schema)
        for r in known:
            if r["version"].endswith(mark):
                return r["version"]
        label = f"v{len(known) + 1}_{mark}"
        row = self.spark.createDataFrame([(dataset, len(known) + 1, label, schema.json(), status, None)], ROW)
        self.table.append(row.withColumn("registered_at", F.current_timestamp()))
        return label

    def approve(self, dataset: str, version: str) -> None:
        """Marks a version as approved; an unknown one is an error."""
        hit = self.rows().filter((F.col("dataset") == dataset) & (F.col("version") == version))
        if hit.isEmpty():
            raise KeyError(f"{dataset} has no version {version}")
        self.table.merge(hit.withColumn("status", F.lit("approved")), ["dataset", "version"], ["number"])

    def latest(self, dataset: str, approved: bool = False) -> tuple[str, T.StructType]:
        found = [r for r in self.versions(dataset) if not approved or r["status"] == "approved"]
        if not found:
            raise KeyError(f"{dataset} has no {'approved ' if approved else ''}version")
        return found[-1]["version"], T.StructType.fromJson(json.loads(found[-1]["schema_json"]))

    def compare(self, dataset: str, first: str, second: str) -> dict[str, list[str]]:
        """Field names added, removed and common from one version to another."""
        fields = {r["version"]: {f["name"] for f in json.loads(r["schema_json"])["fields"]} for r in self.versions(dataset)}
        a, b = fields[first], fields[second]
        return {"added": sorted(b - a), "removed": sorted(a - b), "common": sorted(a & b)}
