"""Schemas that drift between files: one consistent table and a log of every change.

File schemas are read in parallel (each partition folds its records into per-file field facts), compared
with the registered fields, and folded through a type-promotion lattice into one union schema per source.
Renames come from content: a channel's files repeat records of the file before, so a registered field that
vanished is found under the unregistered name that holds the same values in the repeated records.

Lattice: integer < number < string, boolean < string, object and array < string (as JSON). A value counts
with the type of its content: ``"12"`` promotes like 12, a wrapper ``{"val": x}`` or ``[x]`` like x.

Defined cases
    null or unparsable payload, or no object    a record without fields
    null channel or file name                   read as ''
    repeated rows, a record key twice in a file one of them is compared (the smallest payload)
    null or '' against null or ''               no evidence for or against a rename
    several candidates for a field              most equal values, then nearest name, then first name
    source without registered fields            no changes reported
    empty tables                                empty report
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from decimal import Decimal, InvalidOperation

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeq.session import bounded_rows, cut, small_side

FILE = ["source_name", "channel", "file_seq", "file_name"]
#: Registered fields are metadata; more are refused.
MAX_FIELDS = 100_000
PROMOTED = ["null", "boolean", "integer", "number", "string"]
SQL_TYPES = {"integer": "bigint", "number": "double", "boolean": "boolean", "string": "string", "null": "string"}


#: What any finite number begins with; other texts need no attempt to read one.
_NUMERIC = re.compile(r"\s*[+-]?\.?\d")


# -- single values -------------------------------------------------------------------------------------


def json_type(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        return "integer"
    if isinstance(value, (float, Decimal)):
        return "number"
    return {str: "string", dict: "object", list: "array"}[type(value)]


def unwrapped(value: object) -> object:
    """The content of a one-element list or of an object with a ``val`` or ``value`` member."""
    if isinstance(value, list) and len(value) == 1:
        return unwrapped(value[0])
    if isinstance(value, dict):
        for name in ("val", "value"):
            if name in value:
                return unwrapped(value[name])
    return value


def content(value: object) -> str | None:
    """A value as text that is equal for equal content of whatever type; None where it is empty."""
    value = unwrapped(value)
    if value is None or value == "":
        return None
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (dict, list)):
        return json.dumps(value, sort_keys=True, default=str)
    if isinstance(value, str) and not _NUMERIC.match(value):
        return value
    try:
        number = Decimal(str(value).strip())
        if number.is_finite() and -400 < number.adjusted() < 400:
            return format(number.normalize() + 0, "f")
    except InvalidOperation:
        pass
    return str(value)


def content_type(value: object) -> str:
    """Where the value's content stands in the lattice."""
    value = unwrapped(value)
    if value is None or value == "":
        return "null"
    kind = json_type(value)
    if kind in ("object", "array"):
        return "string"
    if kind == "string":
        if not _NUMERIC.match(value):
            return "string"
        try:
            number = Decimal(str(value).strip())
        except InvalidOperation:
            return "string"
        if not number.is_finite():
            return "string"
        return "integer" if str(value).strip().lstrip("+-").isascii() and str(value).strip().lstrip("+-").isdigit() and str(int(number)) == str(value) else "number" if str(number) == str(value) else "string"
    if kind == "integer" and not -(2**63) <= int(value) < 2**63:
        return "number"
    return kind


def parsed(payload: str | None) -> dict:
    try:
        record = json.loads(payload) if payload else {}
    except (ValueError, RecursionError):
        return {}
    return record if isinstance(record, dict) else {}


def promote(kinds: Column) -> Column:
    """The least type above all of ``kinds`` (array of lattice names)."""
    some = F.array_remove(kinds, "null")
    mixed = F.array_contains(some, "boolean") & (F.size(some) > 1)
    return (
        F.when(F.size(some) == 0, "null")
        .when(F.array_contains(some, "string") | mixed, "string")
        .when(F.array_contains(some, "boolean"), "boolean")
        .when(F.array_contains(some, "number"), "number")
        .otherwise("integer")
    )


# -- file schemas --------------------------------------------------------------------------------------


def normal_records(records: DataFrame) -> DataFrame:
    """The columns in use, keys never null."""
    return records.select(
        "rec_id", F.coalesce("source_name", F.lit("")).alias("source_name"), F.coalesce("channel", F.lit("")).alias("channel"),
        F.coalesce(F.col("file_seq").cast("long"), F.lit(0)).alias("file_seq"), F.coalesce("file_name", F.lit("")).alias("file_name"), "payload",
    )


def _facts(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        files: dict[tuple, Counter] = {}
        for *file, payload in zip(*(part[c] for c in FILE), part["payload"]):
            seen = files.setdefault(tuple(file), Counter())
            for field, value in parsed(payload).items():
                seen[field, "null" if value == "" else json_type(value), content_type(value)] += 1
        rows = [(*file, *what, n) for file, seen in files.items() for what, n in seen.items()]
        yield pd.DataFrame(rows, columns=[*FILE, "field", "kind", "content_kind", "n"])


def file_facts(records: DataFrame) -> DataFrame:
    """FILE, field, kinds, content_kinds, n: what each file holds under each name."""
    raw = records.select(*FILE, "payload").mapInPandas(
        _facts, "source_name string, channel string, file_seq long, file_name string, field string, kind string, content_kind string, n long"
    )
    return raw.groupBy(*FILE, "field").agg(F.collect_set("kind").alias("kinds"), F.collect_set("content_kind").alias("content_kinds"), F.sum("n").alias("n"))


def ranked_files(records: DataFrame) -> DataFrame:
    """FILE and the file's place in its channel."""
    w = Window.partitionBy("channel").orderBy("file_seq", "file_name", "source_name")
    return records.select(*FILE).distinct().withColumn("place", F.row_number().over(w))


# -- renames -------------------------------------------------------------------------------------------


def record_key(schema_rows: list, columns: str = "payload") -> Column:
    """The text of a record's key fields, null where none is there."""
    out = F.lit(None).cast("string")
    for source in sorted({r[0] for r in schema_rows}):
        names = sorted(r[1] for r in schema_rows if r[0] == source and r[3])
        if names:
            values = [F.get_json_object(F.col(columns), f"$['{n}']") for n in names]
            key = F.to_json(F.array(*[F.coalesce(v, F.lit("")) for v in values]))
            out = F.when(F.col("source_name") == source, F.when(F.coalesce(*values).isNotNull(), key)).otherwise(out)
    return out


def _evidence(registered: dict[str, set[str]]):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found: dict[tuple, list[int]] = {}
            for source, channel, place, old, new in zip(part["source_name"], part["channel"], part["place"], part["old"], part["new"]):
                before, after = parsed(old), parsed(new)
                known = registered.get(source, set())
                fresh = {u: content(v) for u, v in after.items() if u not in known}
                gone = {p: content(v) for p, v in before.items() if p not in after} if fresh else {}
                for p, a in gone.items():
                    for u, b in fresh.items():
                        if a is not None or b is not None:
                            found.setdefault((channel, place, p, u), [0, 0])[int(a != b)] += 1
            yield pd.DataFrame([(*k, *v) for k, v in found.items()], columns=["channel", "place", "old_name", "candidate", "agree", "differ"])

    return run


def rename_evidence(records: DataFrame, files: DataFrame, suspects: DataFrame, schema_rows: list) -> DataFrame:
    """channel, place, old_name, candidate, agree: names whose values agree in all repeated records."""
    registered: dict[str, set[str]] = {}
    for r in schema_rows:
        registered.setdefault(r[0], set()).add(r[1])
    keyed = records.join(files, FILE).select("source_name", "channel", "place", record_key(schema_rows).alias("record_key"), "payload").filter("record_key IS NOT NULL")
    places = small_side(cut(suspects.select("channel", "place").distinct()))
    # the records of suspected files and of those before them, once
    around = places.select("channel", F.explode(F.array("place", F.col("place") - 1)).alias("place")).distinct()
    near = keyed.join(small_side(around), ["channel", "place"], "left_semi")
    once = cut(near.groupBy("source_name", "channel", "place", "record_key").agg(F.min("payload").alias("payload")))
    new = once.join(places, ["channel", "place"], "left_semi").withColumnRenamed("payload", "new")
    old = once.withColumn("place", F.col("place") + 1).join(places, ["channel", "place"], "left_semi").withColumnRenamed("payload", "old")
    both = new.join(old, ["source_name", "channel", "place", "record_key"]).select("source_name", "channel", "place", "old", "new")
    counted = both.mapInPandas(_evidence(registered), "channel string, place int, old_name string, candidate string, agree long, differ long")
    summed = counted.groupBy("channel", "place", "old_name", "candidate").agg(F.sum("agree").alias("agree"), F.sum("differ").alias("differ"))
    return summed.filter("agree > 0 AND differ = 0").drop("differ")


def _best(evidence: DataFrame) -> DataFrame:
    """One candidate per field and one field per candidate in a file."""
    order = [F.desc("agree"), F.levenshtein(F.lower("field"), F.lower("candidate")), "field", "candidate"]
    by_field = Window.partitionBy("channel", "place", "field").orderBy(*order)
    by_candidate = Window.partitionBy("channel", "place", "candidate").orderBy(*order)
    first = evidence.withColumn("a", F.row_number().over(by_field)).filter("a = 1").drop("a")
    return first.withColumn("b", F.row_number().over(by_candidate)).filter("b = 1").drop("b")


def _spread(starts: DataFrame, missing: DataFrame, extra: DataFrame) -> DataFrame:
    """From the file with evidence through the following files while the field is missing and the name is there."""
    names = starts.select("channel", "field", "candidate").distinct()
    holds = missing.join(names, ["channel", "field"]).join(extra, ["channel", "place", "candidate"], "left_semi")
    marked = holds.join(starts.select("channel", "place", "field", "candidate", F.lit(True).alias("start")), ["channel", "place", "field", "candidate"], "left")
    w = Window.partitionBy("channel", "field", "candidate").orderBy("place")
    islands = marked.withColumn("island", F.col("place") - F.row_number().over(w))
    within = Window.partitionBy("channel", "field", "candidate", "island").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    active = islands.withColumn("since", F.max(F.when(F.col("start"), F.col("place"))).over(within)).filter("since IS NOT NULL")
    latest = Window.partitionBy("channel", "place", "field").orderBy(F.desc("since"), "candidate")
    return active.withColumn("r", F.row_number().over(latest)).filter("r = 1").select("channel", "place", "field", "candidate")


def renames(evidence: DataFrame, missing: DataFrame, extra: DataFrame) -> DataFrame:
    """channel, place, field, candidate: the renames that hold in each file.

    ``missing``: channel, place, field. ``extra``: channel, place, candidate. A rename from one unregistered
    name to another is followed back to the registered field, round by round until none is left.
    """
    lost = evidence.withColumnRenamed("old_name", "field").join(missing, ["channel", "place", "field"], "left_semi")
    starts = cut(_best(lost.select("channel", "place", "field", "candidate", "agree")))
    moved = cut(evidence.join(extra.select("channel", F.col("candidate").alias("old_name")).distinct(), ["channel", "old_name"], "left_semi"))
    active = cut(_spread(starts, missing, extra))
    while not moved.isEmpty():
        step = active.select("channel", (F.col("place") + 1).alias("place"), "field", F.col("candidate").alias("old_name"))
        onward = moved.join(step, ["channel", "place", "old_name"]).join(missing, ["channel", "place", "field"], "left_semi").select("channel", "place", "field", "candidate", "agree")
        fresh = cut(_best(onward).join(starts, ["channel", "place", "field"], "left_anti"))
        if fresh.isEmpty():
            break
        starts = cut(starts.unionByName(fresh))
        active = cut(_spread(starts, missing, extra))
    return active


# -- report --------------------------------------------------------------------------------------------


class Drift:
    """File schemas of ``records`` against ``schema`` (source_name, field_name, field_type, is_key)."""

    def __init__(self, records: DataFrame, schema: DataFrame):
        self.records = normal_records(records)
        self.schema = schema.select("source_name", "field_name", "field_type", F.coalesce("is_key", F.lit(False)).alias("is_key")).filter("source_name IS NOT NULL AND field_name IS NOT NULL").distinct()
        self.schema_rows = bounded_rows(self.schema, MAX_FIELDS, "feed_schema")
        self.files = cut(ranked_files(self.records))
        # records meet the list of files without moving, so that one file may hold most of them
        self.near_files = small_side(self.files)
        self.facts = cut(file_facts(self.records).join(self.near_files, FILE))
        fields = F.broadcast(self.schema.withColumnRenamed("field_name", "field"))
        expected = self.files.join(fields, "source_name")
        self.expected = expected
        known = self.schema.select("source_name", F.col("field_name").alias("field"))
        self.missing = cut(expected.join(self.facts.select("channel", "place", "field"), ["channel", "place", "field"], "left_anti").select("channel", "place", "field"))
        registered_source = F.broadcast(self.schema.select("source_name").distinct())
        self.extra = cut(
            self.facts.join(registered_source, "source_name", "left_semi").join(F.broadcast(known), ["source_name", "field"], "left_anti")
            .select("channel", "place", F.col("field").alias("candidate"))
        )
        suspects = self.missing.join(self.extra, ["channel", "place"], "left_semi")
        evidence = cut(rename_evidence(self.records, self.near_files, suspects, self.schema_rows))
        self.renames = renames(evidence, self.missing, self.extra)

    def under(self) -> DataFrame:
        """Facts of registered fields, each under the name the file uses: adds field_name, field_type."""
        at = self.expected.join(self.renames, ["channel", "place", "field"], "left")
        named = at.select("channel", "place", F.col("field").alias("field_name"), "field_type", F.coalesce("candidate", "field").alias("field"))
        return named.join(self.facts, ["channel", "place", "field"])

    def changes(self) -> DataFrame:
        """file_name, change_kind, field_name, candidate_field."""
        file = ["channel", "place"]
        renamed = self.renames.select(*file, F.lit("rename").alias("change_kind"), F.col("field").alias("field_name"), F.col("candidate").alias("candidate_field"))
        gone = self.missing.join(self.renames, [*file, "field"], "left_anti").select(*file, F.lit("missing_field").alias("change_kind"), F.col("field").alias("field_name"), F.lit("").alias("candidate_field"))
        new = self.extra.join(self.renames, [*file, "candidate"], "left_anti").select(*file, F.lit("new_field").alias("change_kind"), F.col("candidate").alias("field_name"), F.lit("").alias("candidate_field"))
        typed = self.under()
        values = F.array_remove("kinds", "null")
        fits = F.array_contains("kinds", F.col("field_type")) | ((F.col("field_type") == "number") & F.array_contains("kinds", "integer"))
        other = typed.filter((F.size(values) > 0) & ~fits).select(*file, F.lit("type_change").alias("change_kind"), "field_name", F.lit("").alias("candidate_field"))
        all_changes = renamed.unionByName(gone).unionByName(new).unionByName(other)
        return all_changes.join(self.files, file).select("source_name", "channel", "file_seq", "file_name", "change_kind", "field_name", "candidate_field")

    def change_log(self) -> DataFrame:
        """``changes`` in the order of the files of a channel."""
        return self.changes().orderBy("channel", "file_seq", "file_name", "change_kind", "field_name", "candidate_field")

    def union_schema(self) -> DataFrame:
        """source_name, field_name, field_type, union_type, files: the lattice fold over all files."""
        kinds = self.under().groupBy("source_name", "field_name", "field_type").agg(
            F.array_distinct(F.flatten(F.collect_set("content_kinds"))).alias("kinds"), F.count(F.lit(1)).alias("files")
        )
        full = self.schema.join(kinds.select("source_name", "field_name", "kinds", "files"), ["source_name", "field_name"], "left")
        seen = F.array_union(F.coalesce("kinds", F.array().cast("array<string>")), F.array("field_type"))
        return full.select("source_name", "field_name", "field_type", promote(seen).alias("union_type"), F.coalesce("files", F.lit(0)).alias("files"))

    def table(self, source: str) -> DataFrame:
        """rec_id, file_name and the registered fields of one source, cast to the union schema."""
        types = bounded_rows(self.union_schema().filter(F.col("source_name") == source), MAX_FIELDS, "the union schema")
        used = self.files.join(self.renames, ["channel", "place"]).groupBy(*FILE).agg(F.map_from_entries(F.collect_set(F.struct("field", "candidate"))).alias("used"))
        rows = self.records.filter(F.col("source_name") == source).join(small_side(cut(used)), FILE, "left")
        columns = []
        for r in sorted(types, key=lambda r: r["field_name"]):
            name = r["field_name"]
            own = F.get_json_object("payload", f"$['{name}']")
            other = F.call_function("get_json_object", F.col("payload"), F.concat(F.lit("$['"), F.get(F.map_values(F.map_filter("used", lambda k, _: k == name)), 0), F.lit("']")))  # noqa: B023
            value = F.coalesce(own, other)
            inner = (
                F.when(value.startswith("{"), F.coalesce(F.get_json_object(value, "$.val"), F.get_json_object(value, "$.value"), value))
                .when(value.startswith("[") & F.get_json_object(value, "$[1]").isNull(), F.coalesce(F.get_json_object(value, "$[0]"), value))
                .otherwise(value)
            )
            kind = SQL_TYPES[r["union_type"]]
            columns.append((inner if kind == "string" else F.nullif(F.trim(inner), F.lit("")).try_cast(kind)).alias(name))
        return rows.select("rec_id", "file_name", *columns)
