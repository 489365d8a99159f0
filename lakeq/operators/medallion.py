"""Raw to clean to aggregate layers: envelopes, standardising, gold aggregates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeq.functions.scalars import clean_name, is_blank

KINDS = ("count", "sum", "avg", "min", "max")


@dataclass(frozen=True)
class Metric:
    """One aggregate of a gold table."""

    kind: str
    column: str = ""

    def column_name(self) -> str:
        return "record_count" if self.kind == "count" else f"{ {'sum': 'total'}.get(self.kind, self.kind)}_{self.column}"

    def expression(self) -> Column:
        value = F.col(self.column).try_cast("double") if self.column else None
        exact = F.sum(F.col(self.column).try_cast("decimal(20,4)")).cast("double") if self.column else None
        out = {
            "count": lambda: F.count(F.lit(1)),
            "sum": lambda: exact,
            "avg": lambda: F.try_divide(exact, F.count(value)),
            "min": lambda: F.min(value),
            "max": lambda: F.max(value),
        }[self.kind]()
        return out.alias(self.column_name())


def parse_metrics(spec: str) -> list[Metric]:
    """``count:*,sum:fee``: kind and column, comma separated; an entry without a colon counts."""
    metrics = []
    for part in filter(None, (p.strip() for p in spec.split(","))):
        kind, _, column = part.partition(":")
        if not _:
            kind, column = "count", ""
        if kind not in KINDS:
            raise ValueError(f"unknown metric {kind!r}")
        metrics.append(Metric(kind, "" if kind == "count" else column))
    return metrics


def gold_aggregate(df: DataFrame, dimensions: list[str], metrics: list[Metric], event_time: str | None = None, window: str = "1 hour", watermark: str | None = None) -> DataFrame:
    """Aggregates per dimensions and, with an event time, per tumbling window (batch or streaming).

    Sums and averages run over decimals of four places, so that no partitioning changes their last digit.
    """
    keys: list[Column] = [F.col(d) for d in dimensions]
    if event_time:
        if watermark:
            df = df.withWatermark(event_time, watermark)
        keys = [F.window(event_time, window).alias("window"), *keys]
    out = df.groupBy(*keys).agg(*[m.expression() for m in metrics])
    if event_time:
        out = out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *[c for c in out.columns if c != "window"])
    return out


def envelope(df: DataFrame, source: str, batch: str, dataset: str | None = None) -> DataFrame:
    """Record id, source, dataset and batch beside the row as ``payload``."""
    payload = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    body = F.to_json(payload, {"ignoreNullFields": "false"})
    return df.select(
        F.sha2(F.concat_ws("|", F.lit(source), F.lit(batch), body), 256).alias("_record_id"), F.lit(source).alias("_source"), F.lit(dataset or source).alias("_dataset"),
        F.lit(batch).alias("_batch_id"), F.current_timestamp().alias("_ingested_at"), payload.alias("payload"),
    )


def flatten_payload(df: DataFrame, keep: tuple[str, ...] = ("_record_id", "_batch_id")) -> DataFrame:
    """Payload fields at the top level, with the metadata that survives."""
    names = [f.name for f in df.schema["payload"].dataType.fields]
    return df.select(*[F.col(f"payload.`{n}`").alias(n) for n in names], *[c for c in keep if c in df.columns and c not in names])


def standardise(df: DataFrame, contract: list[str] | None = None, flags: tuple[str, ...] = ()) -> DataFrame:
    """Clean names, trimmed strings, contract columns that lack as null, ``is_missing_`` flags: one projection."""
    names = [clean_name(c) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError("names clash after cleaning; merge them first")
    columns = []
    for field, name in zip(df.schema.fields, names):
        c = F.col(f"`{field.name}`")
        columns.append((F.trim(c) if isinstance(field.dataType, T.StringType) else c).alias(name))
    columns += [F.lit(None).cast("string").alias(clean_name(c)) for c in contract or [] if clean_name(c) not in names]
    out = df.select(*columns)
    return out.select("*", *[is_blank(F.col(f)).alias(f"is_missing_{f}") for f in flags])


def flatten_nested(df: DataFrame, separator: str = "_") -> DataFrame:
    """Struct fields as columns; of an array of structs the first element, with its length as ``_count``."""

    def walk(schema: T.StructType, path: Column | None, prefix: str) -> list[Column]:
        out = []
        for f in schema.fields:
            c = F.col(f"`{f.name}`") if path is None else path.getField(f.name)
            name = prefix + f.name
            if isinstance(f.dataType, T.StructType):
                out += walk(f.dataType, c, name + separator)
            elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
                out += walk(f.dataType.elementType, F.get(c, 0), name + separator)
                out.append(F.size(c).alias(name + "_count"))
            else:
                out.append(c.alias(name))
        return out

    return df.select(*walk(df.schema, None, ""))


def split_by_code(df: DataFrame, column: str, code: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose integer code is ``code``, and all others, unreadable codes included."""
    value = F.coalesce(F.trim(F.col(column).cast("string")).try_cast("int"), F.lit(-1))
    return df.filter(value == code), df.filter(value != code)


def collect_history(df: DataFrame, key: str, history: DataFrame, history_key: str, order: list[str], value: str, out: str) -> DataFrame:
    """Each row with the ordered array of its history values, [] where it has none."""
    lists = history.groupBy(F.col(history_key).alias(key)).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(*order, value))), lambda s: s[value]).alias(out)
    )
    return df.join(lists, key, "left").withColumn(out, F.coalesce(out, F.array().cast(lists.schema[out].dataType)))
