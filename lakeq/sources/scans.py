"""Scans of delimited, fixed-width, XML, JSON and Parquet files."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeq.functions.scalars import clean_name, source_bool
from lakeq.operators.parse_failures import assemble_records
from lakeq.sources.registry import SOURCES, Source

TYPES = {"integer": "bigint", "number": "double", "date": "date", "string": "string"}


def delimited_lines(spark: SparkSession, paths: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """source_file, line: one row per physical line; splittable, for files without line breaks in fields."""
    return spark.read.option("encoding", encoding).text(paths).select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("line"))


def quoted_records(spark: SparkSession, paths: str | list[str], delimiter: str, width: int | None = None) -> DataFrame:
    """source_file, record_number, line: records that may hold line breaks in quotes.

    A file is read by one task; ``delimited_lines`` splits files without such records. ``width``: fields of a record.
    """
    files = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("source_file"), "value")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for file, text in zip(part["source_file"], part["value"]):
                records = [(file, n, r) for n, (_, r) in enumerate(assemble_records(text.removeprefix("\ufeff"), delimiter, width), 1)]
                yield pd.DataFrame(records, columns=["source_file", "record_number", "line"])

    return files.mapInPandas(run, "source_file string, record_number long, line string")


def numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """source_file, record_number, line with physical numbers, from the byte order of each file's splits."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_at"), F.col("value").alias("line")
    )
    sizes = lines.groupBy("source_file", "_split").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("source_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return lines.join(before.select("source_file", "_split", "_first", "_before"), ["source_file", "_split"]).select(
        "source_file", (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("record_number"), "line"
    )


def _typed(value: Column, kind: str) -> Column:
    text = F.trim(value)
    if kind == "boolean":
        return source_bool(value)
    if kind == "date":
        parts = F.split(text, "-")
        return F.when(F.size(parts) >= 3, F.concat_ws("-", parts[0], parts[1], parts[2]).try_cast("date"))
    return value if kind == "string" else F.nullif(text, F.lit("")).try_cast(TYPES[kind])


def typed_columns(lines: DataFrame, source: Source | str, line: str = "line") -> DataFrame:
    """The columns of a source, typed, with ``_parse_errors``; a wrong field count wins over all other errors.

    Blank lines are left out. ``_expected_fields``, ``_actual_fields`` and ``_raw`` are set for wrong counts.
    """
    source = SOURCES[source] if isinstance(source, str) else source
    delimiter = "\\" + source.delimiter
    rows = lines.filter(F.trim(line) != "").withColumn("_f", F.split(line, delimiter, -1))
    width = len(source.columns)
    fits = F.size("_f") == width
    values, errors = [], []
    for at, (name, kind) in enumerate(source.columns):
        raw = F.get("_f", at)
        value = _typed(raw, kind)
        values.append(F.when(fits, value).alias(name))
        if kind != "string":
            errors.append(F.when((F.trim(raw) != "") & value.isNull(), F.concat(F.lit(f"{name}: cannot convert '"), raw, F.lit(f"' to {kind}"))))
    required = [F.when(F.trim(F.get("_f", 0)) == "", f"{source.names[0]} is required")] if source.name in ("date", "time") else []
    wrong = F.array(F.lit("field_count_mismatch"))
    all_errors = F.when(~fits, wrong).otherwise(F.array_compact(F.array(*required, *errors)) if required or errors else F.array().cast("array<string>"))
    keep = [c for c in lines.columns if c != line]
    return rows.select(
        *keep, *values, all_errors.alias("_parse_errors"), F.when(~fits, width).alias("_expected_fields"), F.when(~fits, F.size("_f")).alias("_actual_fields"), F.when(~fits, F.col(line)).alias("_raw")
    )


def with_header(spark: SparkSession, paths: str | list[str], delimiter: str = ",") -> DataFrame:
    """Delimited files with a header, all columns strings."""
    return spark.read.option("header", True).option("sep", delimiter).csv(paths)


def count_records(spark: SparkSession, paths: str | list[str], header: bool = False) -> DataFrame:
    """n: lines that are not blank, less one per file with a header, never below 0."""
    per_file = delimited_lines(spark, paths).filter(F.trim("line") != "").groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.coalesce(F.sum(F.greatest(F.col("n") - F.lit(int(header)), F.lit(0))), F.lit(0)).alias("n"))


# -- fixed width ---------------------------------------------------------------------------------------

#: Field widths after the record type, by the public TPC-DI specification.
WIRE = {
    "CMP": (("company_name", 60), ("cik", 10), ("status", 4), ("industry_id", 2), ("sp_rating", 4), ("founding_date", 8), ("addr_line1", 80), ("addr_line2", 80), ("postal_code", 12), ("city", 25), ("state_province", 20), ("country", 24), ("ceo_name", 46), ("description", 150)),
    "SEC": (("symbol", 15), ("issue_type", 6), ("status", 4), ("name", 70), ("ex_id", 6), ("sh_out", 13), ("first_trade_date", 8), ("first_trade_exchg", 8), ("dividend", 12), ("co_name_or_cik", 60)),
    "FIN": (("year", 4), ("quarter", 1), ("qtr_start_date", 8), ("posting_date", 8), ("revenue", 17), ("earnings", 17), ("eps", 12), ("diluted_eps", 12), ("margin", 12), ("inventory", 17), ("assets", 17), ("liabilities", 17), ("sh_out", 13), ("diluted_sh_out", 13), ("co_name_or_cik", 60)),
}


def wire_records(lines: DataFrame, line: str = "line") -> DataFrame:
    """posting_ts, record_type, body of fixed-width wire lines; type '' for lines of 18 characters or fewer."""
    c = F.col(line)
    return lines.filter(F.trim(c) != "").select(
        *[x for x in lines.columns if x != line], F.substring(c, 1, 15).alias("posting_ts"), F.when(F.length(c) > 18, F.substring(c, 16, 3)).otherwise("").alias("record_type"), F.substr(c, F.lit(19)).alias("body")
    )


def wire_fields(records: DataFrame, record_type: str) -> DataFrame:
    """The body of one record type cut into its trimmed fields, '' as null."""
    columns, at = [], 1
    for name, width in WIRE[record_type]:
        columns.append(F.nullif(F.trim(F.substring("body", at, width)), F.lit("")).alias(name))
        at += width
    return records.filter(F.col("record_type") == record_type).select("posting_ts", *columns)


# -- XML and JSON --------------------------------------------------------------------------------------


_PHONE = "struct<C_CTRY_CODE:string,C_AREA_CODE:string,C_LOCAL:string,C_EXT:string>"


def _phone(c: Column) -> Column:
    """``+1 (555) 123-4567 x9`` of the parts that are there; null without a local number."""
    blank = lambda name: F.nullif(F.trim(c[name]), F.lit(""))
    country, area, local, ext = (blank(n) for n in ("C_CTRY_CODE", "C_AREA_CODE", "C_LOCAL", "C_EXT"))
    parts = F.concat_ws(" ", F.concat(F.lit("+"), country), F.concat(F.lit("("), area, F.lit(")")), local, F.concat(F.lit("x"), ext))
    return F.when(local.isNotNull(), parts)


def customer_actions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(customers, accounts) of a customer-management file; accounts carry their action and customer."""
    schema = (
        "_ActionType string, _ActionTS string, Customer struct<_C_ID:string,_C_TAX_ID:string,_C_GNDR:string,_C_TIER:string,_C_DOB:string,"
        "Name:struct<C_L_NAME:string,C_F_NAME:string,C_M_NAME:string>,"
        "Address:struct<C_ADLINE1:string,C_ADLINE2:string,C_ZIPCODE:string,C_CITY:string,C_STATE_PROV:string,C_CTRY:string>,"
        "ContactInfo:struct<C_PRIM_EMAIL:string,C_ALT_EMAIL:string,C_PHONE_1:" + _PHONE + ",C_PHONE_2:" + _PHONE + ",C_PHONE_3:" + _PHONE + ">,"
        "Account:array<struct<_CA_ID:string,_CA_B_ID:string,_CA_TAX_ST:string,CA_NAME:string,CA_B_ID:string>>>"
    )
    actions = spark.read.format("xml").option("rowTag", "TPCDI:Action").schema(schema).load(path)
    customers = actions.select(
        F.col("_ActionType").alias("action_type"), F.col("_ActionTS").alias("action_ts"), F.col("Customer._C_ID").alias("c_id"), F.col("Customer._C_TAX_ID").alias("c_tax_id"),
        F.col("Customer._C_GNDR").alias("c_gndr"), F.col("Customer._C_TIER").alias("c_tier"), F.col("Customer._C_DOB").alias("c_dob"),
        "Customer.Name.*", "Customer.Address.*", "Customer.ContactInfo.C_PRIM_EMAIL", "Customer.ContactInfo.C_ALT_EMAIL",
        *[_phone(F.col(f"Customer.ContactInfo.C_PHONE_{n}")).alias(f"phone{n}") for n in (1, 2, 3)],
    )
    accounts = actions.select(F.col("_ActionType").alias("action_type"), F.col("_ActionTS").alias("action_ts"), F.col("Customer._C_ID").alias("c_id"), F.explode("Customer.Account").alias("a")).select(
        "action_type", "action_ts", "c_id", F.col("a._CA_ID").alias("ca_id"), F.coalesce("a._CA_B_ID", "a.CA_B_ID").alias("ca_b_id"), F.col("a._CA_TAX_ST").alias("ca_tax_st"), F.col("a.CA_NAME").alias("ca_name")
    )
    return customers, accounts


#: Members that hold the records of a JSON document, in the order they are looked for.
RECORD_MEMBERS = ("results", "data", "records", "items", "features", "rows", "readings", "feed")


def extract_records(payload: object) -> list:
    """The records of a JSON document: the list itself, or the first member that holds some, else the document."""
    if isinstance(payload, list):
        return payload
    if isinstance(payload, dict):
        for name in RECORD_MEMBERS:
            if isinstance(payload.get(name), list):
                return payload[name]
            if isinstance(payload.get(name), dict):
                return extract_records(payload[name])
    return [payload]


def json_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """source_file, record (JSON text) of whole JSON documents, a row per record."""
    files = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("source_file"), "value")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [(f, json.dumps(r, sort_keys=True)) for f, v in zip(part["source_file"], part["value"]) for r in extract_records(json.loads(v))]
            yield pd.DataFrame(rows, columns=["source_file", "record"])

    return files.mapInPandas(run, "source_file string, record string")


def read_artifact(spark: SparkSession, path: str, row_tag: str = "row") -> DataFrame:
    """A file by its suffix: jsonl, json or geojson, csv, xml, parquet, orc."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "jsonl":
        return spark.read.json(path)
    if suffix in ("json", "geojson"):
        return json_documents(spark, path)
    if suffix == "csv":
        df = with_header(spark, path)
        return df.toDF(*[clean_name(c) or "unnamed_column" for c in df.columns])
    if suffix in ("xml", "xsd"):
        return spark.read.format("xml").option("rowTag", row_tag).option("attributePrefix", "@").option("valueTag", "#text").load(path)
    if suffix in ("parquet", "orc"):
        return spark.read.format(suffix).load(path)
    raise ValueError(f"no scan for .{suffix}")


def partitioned_json(spark: SparkSession, path: str, schema: str | None = None, **partitions: object) -> DataFrame:
    """JSON lines under ``key=value`` folders; the named partitions are pruned, not read."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.json(path)
    for name, value in partitions.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def audit_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """dataset, batch, date, attribute, value, number of a generator's audit files, clean and trimmed."""
    rows = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(paths)
    names = {clean_name(c): c for c in rows.columns}
    pick = lambda *options: next((F.col(f"`{names[o]}`") for o in options if o in names), F.lit(None).cast("string"))
    return rows.select(
        pick("dataset", "data_set").alias("dataset"), pick("batchid", "batch_id").try_cast("int").alias("batch"), pick("date").try_cast("date").alias("date"), pick("attribute").alias("attribute"),
        pick("value").try_cast("bigint").alias("value"), pick("dvalue").try_cast("double").alias("number"),
    )


def first_readable(spark: SparkSession, path: str, encodings: tuple[str, ...] = ("UTF-8", "windows-1252")) -> str:
    """The first of ``encodings`` in which no line of the files holds a replacement character, else the last."""
    for encoding in encodings[:-1]:
        if delimited_lines(spark, path, encoding).filter(F.col("line").contains("\ufffd")).isEmpty():
            return encoding
    return encodings[-1]


def report_totals(spark: SparkSession, path: str) -> DataFrame:
    """name, total of the ``name: 1,234`` lines of a generator's report."""
    lines = spark.read.text(path)
    name, total = F.regexp_extract("value", r"^\s*([A-Za-z][\w ]*?)\s*[:=]\s*([0-9][0-9,]*)", 1), F.regexp_extract("value", r"^\s*([A-Za-z][\w ]*?)\s*[:=]\s*([0-9][0-9,]*)", 2)
    return lines.select(name.alias("name"), F.regexp_replace(total, ",", "").try_cast("bigint").alias("total")).filter("name <> '' AND total IS NOT NULL")
