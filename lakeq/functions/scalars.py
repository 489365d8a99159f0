"""Scalar helpers, each a column expression or a driver-side rule on names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "\\N"


def is_missing(c: Column) -> Column:
    """Null or ''."""
    return c.isNull() | (c.cast("string") == "")


def is_blank(c: Column) -> Column:
    """Null or nothing but blanks."""
    return c.isNull() | (F.trim(c.cast("string")) == "")


def safe_str(c: Column) -> Column:
    """Null as '', trimmed, lower case."""
    return F.lower(F.trim(F.coalesce(c.cast("string"), F.lit(""))))


def audit_bool(c: Column) -> Column:
    """true, 1, yes and t are true, everything else false."""
    return safe_str(c).isin("true", "1", "yes", "t")


def source_bool(c: Column) -> Column:
    """true/1/t/yes and false/0/f/no; null otherwise."""
    s = safe_str(c)
    return F.when(s.isin("true", "1", "t", "yes"), True).when(s.isin("false", "0", "f", "no"), False)


def json_bool(c: Column) -> Column:
    """true/1/yes/y and false/0/no/n; null otherwise."""
    s = safe_str(c)
    return F.when(s.isin("true", "1", "yes", "y"), True).when(s.isin("false", "0", "no", "n"), False)


def json_integer(c: Column) -> Column:
    """An integral number in any spelling, else null."""
    d = F.trim(c).try_cast("double")
    return F.when(d == F.floor(d), d.try_cast("bigint"))


def clean_name(name: str) -> str:
    """Lower case, runs of other characters than letters and digits as one underscore."""
    return re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_")


def entity_text(c: Column) -> Column:
    """Lower case letters and digits, single blanks between."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c.cast("string"), F.lit(""))), "[^a-z0-9]+", " "))


def canonical_id(entity_type: str, key: Column) -> Column:
    return F.concat(F.lit("ceid_"), F.substring(F.sha2(F.concat(F.lit(f"{entity_type}|"), key), 256), 1, 16))


def signature(fields: dict[str, Column]) -> Column:
    """``a=x|b=y`` of the fields that have a value."""
    return F.concat_ws("|", *[F.when(c != "", F.concat(F.lit(f"{n}="), c)) for n, c in fields.items()])


def geo_score(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Nearness by the sum of degrees apart; null where a coordinate is."""
    apart = F.abs(lat1 - lat2) + F.abs(lon1 - lon2)
    return F.when(apart.isNull(), None).when(apart <= 0.0005, 1.0).when(apart <= 0.005, 0.9).when(apart <= 0.05, 0.7).otherwise(0.0)


def text_pattern(c: Column) -> Column:
    """datetime, date, uuid, email, url, coordinate, or null."""
    return (
        F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"), "datetime")
        .when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), "date")
        .when(c.rlike(r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"), "uuid")
        .when(c.rlike(r"(?s)@[^@]*\.[^@]*$"), "email")
        .when(c.rlike(r"^https?://"), "url")
        .when(c.rlike(r"^-?\d+\.\d+"), "coordinate")
    )


def record_hash(*columns: str) -> Column:
    """SHA-256 of the row as JSON with its columns in name order."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def masked(c: Column) -> Column:
    """Secrets in URLs and headers blanked out."""
    hidden = F.regexp_replace(c, r"(?i)([?&](?:api_?key|token|access_token|password|secret|signature)=)[^&\s]+", "$1***")
    hidden = F.regexp_replace(hidden, r"(?i)\b(bearer|basic)\s+[A-Za-z0-9._~+/=-]+", "$1 ***")
    return F.regexp_replace(hidden, r"(://[^:/@\s]+:)[^@/\s]+@", "$1***@")


# Parts of a column's name -> what it holds, in this order; the first two are endings.
SEMANTIC_ENDINGS = (("_sk", "foreign_key"), ("_id", "identifier"))
SEMANTIC_PARTS = (
    ("name first last", "person_name"), ("email", "email"), ("date time", "temporal"), ("price cost amount profit tax revenue coupon", "monetary_amount"),
    ("quantity count number", "quantity"), ("flag", "categorical"),
)
# Parts of a column's name -> the stand-in for a lost value, in this order.
DEFAULT_PARTS = (("_id _key sk_ pk_ fk_", "0"), ("_dts _date _time timestamp", "now"), ("_price _amount _qty _quantity _volume", "0"), ("_flag is_ has_", "false"))


def semantic_type(name: str) -> str:
    """What a column holds, told by its name."""
    lower = name.lower()
    ending = next((kind for end, kind in SEMANTIC_ENDINGS if name.endswith(end)), None)
    return ending or next((kind for parts, kind in SEMANTIC_PARTS if any(p in lower for p in parts.split())), "unknown")


def default_value(name: str) -> Column:
    """A stand-in for a value that is gone, told by its column's name: 0, the time of the query, false, or ''."""
    lower = name.lower()
    found = next((value for parts, value in DEFAULT_PARTS if any(p in lower for p in parts.split())), "")
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss") if found == "now" else F.lit(found)


# Hours below which an interval is told in a unit, hours of the unit, its sign.
INTERVALS = ((1, 1 / 60, "m"), (24, 1, "h"), (7 * 24, 24, "d"), (4 * 7 * 24, 7 * 24, "w"), (12 * 30 * 24, 30 * 24, "mo"), (float("inf"), 365 * 24, "y"))


def humanised_frequency(seconds: float) -> str:
    """``every_15m``, ``every_2h``, ``every_3w``: whole units, rounded down; below a minute in seconds."""
    if seconds <= 0:
        return "on_demand"
    if seconds < 60:
        return f"every_{int(seconds)}s"
    hours = seconds / 3600
    _, size, sign = next(i for i in INTERVALS if hours < i[0])
    return f"every_{int(hours / size + 1e-9)}{sign}"


# Tokens that mean a missing value.
MISSING_TOKENS = ("", "null", "n/a", "unknown", "\\n")
# Parts of a key's name that hold times, names that do not, the form of a time.
TIME_PARTS, NOT_TIMES = ("time", "date", "lastupdated"), ("timezone", "time_zone", "timeformat", "time_format")
TIME_FORM = r"^\d{4}-\d{2}-\d{2}"


def is_missing_token(c: Column) -> Column:
    return c.isNull() | F.lower(F.trim(c)).isin(*MISSING_TOKENS)


def first_timestamp(df_columns: list[str]) -> Column:
    """The first value, in column order, of a column named like a time that looks like one; null where there is none."""
    named = [c for c in df_columns if c.lower() not in NOT_TIMES and any(p in c.lower() for p in TIME_PARTS)]
    values = [F.col(f"`{c}`").cast("string") for c in named]
    return F.coalesce(*[F.when(v.rlike(TIME_FORM), v) for v in values], F.lit(None).cast("string"))


def record_id(ingestion_type: Column, source: Column, dataset: Column, run: Column, chunk: Column, path: Column, index: Column, payload: Column) -> Column:
    """SHA-256 over the eight parts of a record's origin, null parts empty."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (ingestion_type, source, dataset, run, chunk, path, index, payload)]
    return F.sha2(F.concat(*parts), 256)


def short_hash(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 16)


def template_annotation(name: str, templates: dict[str, dict]) -> dict | None:
    """The template of a field: by its name, else the first whose name is part of it or holds it."""
    lower = name.lower()
    return templates.get(lower) or next((t for key, t in templates.items() if key in lower or lower in key), None)


def time_range(c: Column) -> tuple[Column, Column]:
    """Aggregates: the first and the last of the texts that look like times."""
    known = F.when(c.rlike(TIME_FORM), c)
    return F.min(known), F.max(known)


def month_starts(first: Column, last: Column) -> Column:
    """The first days of the months from one date to another."""
    return F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("INTERVAL 1 MONTH"))
