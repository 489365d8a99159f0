"""Rows that fail to parse: typed records beside the lines that fail and why.

Records are parsed with the strict CSV reader inside ``mapInArrow`` (one pass, no shuffle). Structural
exceptions are caught before any typed field constructor runs, so the reasons have a fixed order:
``broken_quoting``, ``field_count_mismatch``, ``invalid_value``.

Defined cases
    null line, or nothing but blanks and delimiters   skipped, neither record nor failure
    null or empty delimiter                           the line is one field
    source without layout                             ``field_count_mismatch``
    repeated lines                                    each is reported under its own id
    line breaks                                       data inside a quoted field; in an unquoted field plain text
    one carriage return at the end                    not part of the line
    empty table                                       empty result; extra columns are carried through untouched
"""

from __future__ import annotations

import bisect
import csv
import datetime as dt
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeq.session import bounded_rows

BROKEN, COUNT, VALUE = "broken_quoting", "field_count_mismatch", "invalid_value"
#: Layouts are metadata; more columns than this are refused.
MAX_LAYOUT_ROWS = 100_000
SQL_TYPES = {"integer": "bigint", "decimal": "double", "date": "date", "timestamp": "timestamp_ntz", "string": "string"}

_INTEGER = re.compile(r"[+-]?[0-9]+")
_DECIMAL = re.compile(r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)")
_DATE = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")
_TIMESTAMP = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}")


def _integer(text: str) -> None:
    if not _INTEGER.fullmatch(text):
        raise ValueError("not an integer")
    digits = text.lstrip("+-").lstrip("0")
    if len(digits) > 19 or not -(2**63) <= int(text[0].replace("+", "") + text[1:]) < 2**63:
        raise ValueError("beyond 64 bits")


def _decimal(text: str) -> None:
    if not _DECIMAL.fullmatch(text):
        raise ValueError("not a decimal")


def _date(text: str) -> None:
    if not _DATE.fullmatch(text):
        raise ValueError("not a date")
    dt.date(int(text[:4]), int(text[5:7]), int(text[8:]))


def _timestamp(text: str) -> None:
    if not _TIMESTAMP.fullmatch(text):
        raise ValueError("not a timestamp")
    dt.datetime(int(text[:4]), int(text[5:7]), int(text[8:10]), int(text[11:13]), int(text[14:16]), int(text[17:]))


CONSTRUCTORS = {"integer": _integer, "decimal": _decimal, "date": _date, "timestamp": _timestamp}


def assemble_records(text: str, delimiter: str, width: int | None = None) -> Iterator[tuple[int, str]]:
    """(number of its first physical line, record) of a file's text.

    A quote opens a field only as the field's first character; a line break inside it belongs to the record. A
    record of several lines holds only if its quotes close, are followed by the delimiter or the line's end, and
    give ``width`` fields where that is known. Otherwise its first line stands alone and the next line begins anew,
    so that one open quote costs one line and not the rest of the file. Every quote run is looked at once.
    """
    delimiter = delimiter or "\x1f"
    runs = quote_runs(text)
    at, number = 0, 0
    while at < len(text):
        number += 1
        line_end = text.find("\n", at)
        line_end = len(text) if line_end < 0 else line_end
        end = line_end
        if text.find('"', at, line_end) >= 0:
            far = record_end(text, at, delimiter, width, runs)
            end = line_end if far is None else far
        record = text[at:end]
        yield number, record
        number += record.count("\n")
        at = end + 1


def quote_runs(text: str) -> tuple[list[int], dict[int, int]]:
    """(starts of the quote runs of odd length, start -> end of every run). Inside a field, an odd run closes it."""
    ends = {m.start(): m.end() for m in re.finditer('"+', text)}
    return [start for start, end in ends.items() if (end - start) % 2], ends


def record_end(text: str, at: int, delimiter: str, width: int | None = None, runs: tuple[list[int], dict[int, int]] | None = None) -> int | None:
    """Where the record that begins at ``at`` ends, None where its quoting does not hold or it has several lines but not ``width`` fields."""
    closing, ends = runs or quote_runs(text)
    first, fields = at, 0
    while True:
        fields += 1
        if text.startswith('"', at):
            run = ends[at]
            if (run - at) % 2:  # the quotes behind the opening one are pairs: the field goes on to the next odd run
                n = bisect.bisect_left(closing, run)
                if n == len(closing):
                    return None
                run = ends[closing[n]]
            at = run
            if not (at == len(text) or text.startswith((delimiter, "\n", "\r\n"), at) or (at + 1 == len(text) and text[at] == "\r")):
                return None
            if width is not None and fields > width and "\n" in text[first:at]:
                return None
        else:
            line_end = text.find("\n", at)
            line_end = len(text) if line_end < 0 else line_end
            after = text.find(delimiter, at, line_end)
            at = line_end if after < 0 else after
        if text.startswith("\r\n", at) or (at + 1 == len(text) and text[at] == "\r"):
            at += 1
        if at == len(text) or text[at] == "\n":
            several = "\n" in text[first:at]
            return None if several and width is not None and fields != width else at
        at += len(delimiter)


def split_record(line: str, delimiter: str | None) -> list[str] | None:
    """The fields of one record, or None where it is skipped; ``csv.Error`` where its quoting is broken."""
    if line.endswith("\n"):
        line = line[:-1]
    if line.endswith("\r"):
        line = line[:-1]
    delimiter = delimiter or "\x1f"
    if not line.replace(delimiter, "").strip():
        return None
    if len(delimiter) > 1:
        line, delimiter = line.replace(delimiter, "\x1f"), "\x1f"
    if '"' not in line:
        return line.split(delimiter)
    if record_end(line, 0, delimiter) is None:
        raise csv.Error("a quoted field does not close before a delimiter or the end")
    marks = {}
    for breaker in "\n\r":  # the reader would end the record there; the record is assembled already
        if breaker in line:
            code = next(c for c in range(0xE000, 0xF8FF) if chr(c) not in line)
            marks[chr(code)] = breaker
            line = line.replace(breaker, chr(code))
    fields = next(csv.reader([line], delimiter=delimiter, strict=True))
    for mark, breaker in marks.items():
        fields = [f.replace(mark, breaker) for f in fields]
    return fields


def judge(line: str | None, delimiter: str | None, kinds: tuple[str, ...]) -> tuple[list[str] | None, str | None, str | None]:
    """(fields, reason, detail) of one record; (None, None, None) where it is skipped."""
    if line is None:
        return None, None, None
    try:
        fields = split_record(line, delimiter)
    except csv.Error as error:
        return None, BROKEN, str(error)
    if fields is None:
        return None, None, None
    if len(fields) != len(kinds):
        return None, COUNT, f"expected {len(kinds)} fields, found {len(fields)}"
    for at, kind in enumerate(kinds):
        make = CONSTRUCTORS.get(kind)
        if make is None:
            if "�" in fields[at]:
                return None, VALUE, f"field {at + 1}: replacement character"
            continue
        fields[at] = fields[at].strip()
        if fields[at]:
            try:
                make(fields[at])
            except ValueError as error:
                return None, VALUE, f"field {at + 1}: {error}"
    return fields, None, None


def layouts_of(layouts: DataFrame) -> dict[str, list[tuple[str, str]]]:
    """source -> [(column, value type)] in column order."""
    out: dict[str, list] = {}
    for r in bounded_rows(layouts.select("source_name", "col_no", "column_name", "value_type").distinct(), MAX_LAYOUT_ROWS, "source_layouts"):
        out.setdefault(r[0], []).append((r[1], r[2], r[3]))
    return {source: [(c, k) for _, c, k in sorted(cols)] for source, cols in out.items()}


def parse_lines(lines: DataFrame, layouts: DataFrame, id_col: str = "line_id") -> DataFrame:
    """``lines`` (id, source_name, delimiter, raw_line) judged.

    Result: id, source_name, ``_fields`` array<string> (valid rows), ``_reason``, ``_parse_errors``
    array<string>. Skipped lines are absent.
    """
    by_source = {s: tuple(k for _, k in cols) for s, cols in layouts_of(layouts).items()}
    picked = lines.select(F.col(id_col), "source_name", "delimiter", "raw_line")
    schema = T.StructType(
        [
            T.StructField(id_col, picked.schema[id_col].dataType),
            T.StructField("source_name", T.StringType()),
            T.StructField("_fields", T.ArrayType(T.StringType())),
            T.StructField("_reason", T.StringType()),
            T.StructField("_parse_errors", T.ArrayType(T.StringType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(2**31 - 1)
        for batch in batches:
            keep, all_fields, reasons, errors = [], [], [], []
            sources = batch.column(1).to_pylist()
            for at, (source, delimiter, line) in enumerate(zip(sources, batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                fields, reason, detail = judge(line, delimiter, by_source.get(source, ()))
                if fields is None and reason is None:
                    continue
                keep.append(at)
                all_fields.append(fields)
                reasons.append(reason)
                errors.append([reason, detail] if reason else [])
            taken = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(all_fields, pa.list_(pa.string())), pa.array(reasons, pa.string()), pa.array(errors, pa.list_(pa.string()))],
                names=[id_col, "source_name", "_fields", "_reason", "_parse_errors"],
            )

    return picked.mapInArrow(run, schema)


def failures(judged: DataFrame, id_col: str = "line_id") -> DataFrame:
    """The quarantine side: id and reason."""
    return judged.filter(F.col("_reason").isNotNull()).select(id_col, F.col("_reason").alias("reason"))


def typed_records(judged: DataFrame, layouts: DataFrame, source: str, id_col: str = "line_id") -> DataFrame:
    """The load side: typed columns of one source; empty values are null."""
    columns: list[Column] = []
    for at, (name, kind) in enumerate(layouts_of(layouts).get(source, [])):
        value = F.col("_fields")[at]
        if kind != "string":
            value = F.nullif(value, F.lit("")).try_cast(SQL_TYPES.get(kind, "string"))
        columns.append(value.alias(name))
    good = judged.filter((F.col("source_name") == source) & F.col("_reason").isNull())
    return good.select(F.col(id_col), *columns)


def assembled(lines: DataFrame, layouts: DataFrame, order: list[str]) -> DataFrame:
    """source_file, source_name, delimiter, record_number, raw_line: the records of each file, from its physical lines.

    ``lines`` (source_file, source_name, delimiter, line) are ordered by ``order`` in a file. A file is assembled in one
    task; files that hold no quotes need no assembly and are better read by ``scans.delimited_lines``, which splits them.
    """
    widths = {s: len(cols) for s, cols in layouts_of(layouts).items()}

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(order, na_position="first", kind="stable")
        source, delimiter = part["source_name"].iloc[0], part["delimiter"].iloc[0]
        records = assemble_records("\n".join(part["line"].fillna("")), delimiter, widths.get(source))
        out = pd.DataFrame(records, columns=["record_number", "raw_line"])
        return out.assign(source_file=part["source_file"].iloc[0], source_name=source, delimiter=delimiter)

    return lines.groupBy("source_file", "source_name", "delimiter").applyInPandas(run, "source_file string, source_name string, delimiter string, record_number long, raw_line string")
