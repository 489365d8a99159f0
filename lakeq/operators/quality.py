"""Data-quality measures and rules, each a single aggregate or a projection."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeq.functions.scalars import clean_name, is_blank, is_missing


def missing_ratio(df: DataFrame, required: list[str]) -> Column:
    """Missing cells over all required cells; 0 for no rows. An aggregate for ``df.agg``."""
    cells = reduce(lambda a, b: a + b, [F.count_if(is_missing(F.col(c))) for c in required])
    return F.coalesce(F.try_divide(cells, F.count(F.lit(1)) * len(required)), F.lit(0.0))


def null_profile(df: DataFrame, places: int = 4) -> DataFrame:
    """column_name, nulls, ratio of the columns with blanks: one pass, then unpivoted."""
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(is_blank(F.col(f"`{c}`"))).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("nulls")) for i, c in enumerate(df.columns)])
    return counts.select("n", F.inline(rows)).filter("nulls > 0").select("column_name", "nulls", F.bround(F.col("nulls") / F.col("n"), places).alias("ratio"))


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """rows, duplicates (rows beyond the first of a key, null being a key), ratio."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates")).withColumn(
        "ratio", F.coalesce(F.try_divide("duplicates", "rows"), F.lit(0.0))
    )


def freshness(timestamp: Column, reference: Column, max_age_hours: float) -> Column:
    """Share of rows at most so old; the future is fresh, null is not. An aggregate."""
    age = (F.unix_micros(reference.cast("timestamp")) - F.unix_micros(timestamp.cast("timestamp"))) / 3_600_000_000
    return F.coalesce(F.try_divide(F.count_if(age <= max_age_hours), F.count(F.lit(1))), F.lit(0.0))


def readiness(missing: Column, duplicates: Column, schema_valid: Column, fresh: Column, places: int = 4) -> Column:
    """Weighted score of the four measures within 0 and 1."""
    score = 0.30 * (1 - missing) + 0.20 * (1 - duplicates) + 0.30 * schema_valid.cast("double") + 0.20 * fresh
    return F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), places)


def threshold_violations(missing: Column, duplicates: Column, fresh: Column, schema_valid: Column, max_missing: float, max_duplicates: float, min_fresh: float) -> Column:
    """Names of the gates that a data set fails, in fixed order."""
    return F.array_compact(
        F.array(
            F.when(~schema_valid, "schema_invalid"), F.when(missing > max_missing, "missing_ratio"),
            F.when(duplicates > max_duplicates, "duplicate_ratio"), F.when(fresh < min_fresh, "freshness_score"),
        )
    )


# -- rules ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """not_null, in_range (min, max), regex (pattern), in_set (values), unique (no effect on single rows)."""

    name: str
    column: str
    kind: str
    severity: str = "error"
    params: dict = field(default_factory=dict)

    def passed(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            return ~is_missing(c)
        if self.kind == "in_range":
            low, high = self.params.get("min"), self.params.get("max")
            inside = F.lit(True)
            inside = inside & (c >= low) if low is not None else inside
            inside = inside & (c <= high) if high is not None else inside
            return F.coalesce(inside, F.lit(True))
        if self.kind == "regex":
            return F.coalesce(is_missing(c) | c.cast("string").rlike(f"^(?:{self.params['pattern']})"), F.lit(True))
        if self.kind == "in_set":
            return F.coalesce(c.isin(*self.params["values"]), F.lit(True))
        return F.lit(True)


def evaluate_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """rule, severity, checked, failed: all rules in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(~r.passed()).alias(f"r{i}") for i, r in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.col(f"r{i}").alias("failed")) for i, r in enumerate(rules)])
    return counts.select(F.col("n").alias("checked"), F.inline(rows))


def failing_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows that fail a rule of error severity, with the rules' names."""
    names = F.array_compact(F.array(*[F.when(~r.passed(), r.name) for r in rules if r.severity == "error"]))
    return df.withColumn("failed_rules", names).filter(F.size("failed_rules") > 0)


@dataclass(frozen=True)
class Expectation:
    """row_count, exists, not_null, unique, in_set, between, parseable."""

    kind: str
    column: str = ""
    params: dict = field(default_factory=dict)


def expectation_suite(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """expectation, column_name, success, unexpected, percent.

    One aggregate for all but unique keys; each of those is a count per key (``params['columns']`` for keys of several
    columns; null keys are no duplicates), so no row is multiplied for it.
    """
    have, aggregates, parts, plain = set(df.columns), [F.count(F.lit(1)).alias("n")], [], []
    for i, e in enumerate(suite):
        c = F.col(e.column) if e.column in have else None
        if e.kind == "unique":
            keys = e.params.get("columns", [e.column])
            if all(k in have for k in keys):
                known = F.lit(True)
                for k in keys:
                    known = known & F.col(k).isNotNull()
                counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
                parts.append(counted.agg(F.lit(i).alias("at"), F.coalesce(F.sum(F.when(known, F.col("c") - 1)), F.lit(0)).alias("unexpected"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")))
                continue
            bad = F.lit(1)
        elif e.kind == "row_count":
            bad = F.when(F.count(F.lit(1)) >= e.params.get("min", 1), 0).otherwise(1)
        elif c is None or e.kind == "exists":
            bad = F.lit(0 if c is not None else 1)
        elif e.kind == "not_null":
            bad = F.count_if(is_missing(c))
        elif e.kind == "in_set":
            bad = F.count_if(~c.isin(*e.params["values"]))
        elif e.kind == "between":
            bad = F.count_if(~c.between(e.params["min"], e.params["max"]))
        else:
            bad = F.count_if(~is_missing(c) & c.cast("string").try_cast("timestamp").isNull())
        aggregates.append(bad.cast("long").alias(f"e{i}"))
        plain.append(i)
    rows = F.array(*[F.struct(F.lit(i).alias("at"), F.col(f"e{i}").alias("unexpected")) for i in plain]) if plain else F.array().cast("array<struct<at:int,unexpected:bigint>>")
    out = df.agg(*aggregates).select(F.inline(rows), "n").select("at", "unexpected", "n")
    for part in parts:
        out = out.unionByName(part)
    names = F.array(*[F.struct(F.lit(e.kind).alias("expectation"), F.lit(e.column or "+".join(e.params.get("columns", []))).alias("column_name")) for e in suite])
    named = out.select(F.get(names, F.col("at")).alias("e"), "unexpected", "n").select("e.*", "unexpected", "n")
    percent = F.when(F.col("expectation").isin("row_count", "exists"), F.lit(0.0)).otherwise(F.coalesce(F.try_divide(F.col("unexpected") * 100.0, F.col("n")), F.lit(0.0)))
    return named.select("expectation", "column_name", (F.col("unexpected") == 0).alias("success"), "unexpected", percent.alias("percent"))


def suite_of(required: list[str], keys: list[str], sets: dict[str, list] | None = None) -> list[Expectation]:
    """The suite a contract implies; a key of several columns is unique as a whole."""
    out = [Expectation("row_count")]
    out += [Expectation(kind, c) for c in required for kind in ("exists", "not_null")]
    if keys:
        out.append(Expectation("unique", keys[0]) if len(keys) == 1 else Expectation("unique", "", {"columns": keys}))
    return out + [Expectation("in_set", c, {"values": v}) for c, v in (sets or {}).items()]


def rules_of(entries: list[dict]) -> list[Rule]:
    """Rules from parsed configuration: name, column, type, severity and the parameters of the type."""
    return [Rule(e["name"], e.get("column", ""), e.get("type", ""), e.get("severity", "error"), {k: v for k, v in e.items() if k not in ("name", "column", "type", "severity")}) for e in entries]


def load_rules(path: str) -> list[Rule]:
    """Rules from the ``rules`` list of a YAML file."""
    import yaml

    with open(path) as file:
        return rules_of((yaml.safe_load(file) or {}).get("rules", []))


def normal_schema(schema: dict) -> dict:
    """A JSON schema with clean column names."""
    return {**schema, "properties": {clean_name(k): v for k, v in schema.get("properties", {}).items()}, "required": [clean_name(k) for k in schema.get("required", [])]}


# -- schema --------------------------------------------------------------------------------------------

COERCIONS = {"integer": "bigint", "number": "double", "boolean": "boolean", "string": "string"}


FORMATS = {
    "date": lambda c: c.rlike(r"^\d{4}-\d{2}-\d{2}$") & c.try_cast("date").isNotNull(),
    "date-time": lambda c: c.rlike(r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}") & c.try_cast("timestamp").isNotNull(),
    "email": lambda c: c.rlike(r"^[^@\s]+@[^@\s]+$"),
    "uri": lambda c: c.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:\S+$"),
}


def compile_schema(schema: dict, dtypes: dict[str, str] | None = None) -> list[tuple[str, Column]]:
    """(message, failed) for each check of a JSON schema over string or typed columns.

    Objects and arrays are checked where a column holds them as JSON text (``dtypes`` tells, strings by default).
    """
    dtypes = dtypes or {}
    checks = []
    for name, spec in schema.get("properties", {}).items():
        c = F.col(name)
        kinds = spec.get("type", "string")
        kind = next((k for k in ([kinds] if isinstance(kinds, str) else kinds) if k != "null"), "string")
        nullable = name not in schema.get("required", []) or (not isinstance(kinds, str) and "null" in kinds)
        if not nullable:
            checks.append((f"{name} is required", c.isNull()))
        if kind in ("integer", "number"):
            number = c.cast("string").try_cast("double")
            bad = number.isNull() if kind == "number" else number.isNull() | (number != F.floor(number))
            checks.append((f"{name} is not of type {kind}", c.isNotNull() & bad))
            for word, test in (("minimum", lambda v: number < v), ("maximum", lambda v: number > v)):
                if word in spec:
                    checks.append((f"{name} violates {word}", F.coalesce(test(spec[word]), F.lit(False))))
        if kind == "boolean":
            checks.append((f"{name} is not of type boolean", c.isNotNull() & ~F.lower(c.cast("string")).isin("true", "false")))
        if kind in ("object", "array") and "string" in dtypes.get(name, "string"):
            opened = F.expr(f"try_parse_json(CAST(`{name}` AS STRING))")
            checks.append((f"{name} is not of type {kind}", c.isNotNull() & ~F.coalesce(F.startswith(F.schema_of_variant(opened), F.lit(kind.upper())), F.lit(False))))
        if spec.get("format") in FORMATS:
            text = c.cast("string")
            checks.append((f"{name} is no {spec['format']}", c.isNotNull() & ~F.coalesce(FORMATS[spec["format"]](text), F.lit(False))))
        if "enum" in spec:
            checks.append((f"{name} is not one of the enumeration", c.isNotNull() & ~c.isin(*spec["enum"])))
        if "pattern" in spec:
            checks.append((f"{name} does not match its pattern", c.isNotNull() & ~c.cast("string").rlike(spec["pattern"])))
    return checks


def schema_errors(df: DataFrame, schema: dict, most: int | None = 20) -> DataFrame:
    """message, rows of the first ``most`` checks that fail (None: all), unknown columns first: a report, not a filter."""
    unknown = [c for c in df.columns if schema.get("additionalProperties") is False and c not in schema.get("properties", {})]
    lacking = [c for c in schema.get("properties", {}) if c not in df.columns]
    checks = [(f"{c} is unexpected", F.lit(True)) for c in unknown]
    checks += [(m, bad) for m, bad in compile_schema({**schema, "properties": {k: v for k, v in schema.get("properties", {}).items() if k in df.columns}}, dict(df.dtypes))]
    checks += [(f"{c} is absent", F.lit(True)) for c in lacking if c in schema.get("required", [])]
    counts = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, bad) in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(m).alias("message"), F.col(f"c{i}").alias("rows")) for i, (m, _) in enumerate(checks)])
    return counts.select(F.inline(rows)).filter("rows > 0").orderBy("at").limit(len(checks) if most is None else most).drop("at")


def coerce(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Columns cast to their JSON type where they can be, left null and named in ``_parse_errors`` where not."""
    values, errors = [], []
    for name in df.columns:
        kind = kinds.get(name, "string")
        text = F.trim(F.col(name).cast("string"))
        value = text.try_cast(COERCIONS[kind]) if kind != "string" else F.col(name)
        values.append(value.alias(name))
        if kind != "string":
            errors.append(F.when((text != "") & value.isNull(), F.concat(F.lit(f"{name}: cannot convert '"), F.col(name), F.lit(f"' to {kind}"))))
    return df.select(*values, F.array_compact(F.array(*errors)).alias("_parse_errors") if errors else F.array().cast("array<string>").alias("_parse_errors"))


# -- auto fix ------------------------------------------------------------------------------------------


def auto_fix(df: DataFrame, fill: dict[str, str] | None = None, rename: dict[str, str] | None = None) -> DataFrame:
    """Trim, rename to clean names (given names first), merge colliding columns (first value wins), fill what is missing."""
    rename, groups = rename or {}, {}
    for c in df.columns:
        groups.setdefault(rename.get(c, clean_name(c)), []).append(c)
    columns = []
    for name, sources in groups.items():
        parts = [F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) for c in sources]
        value = F.coalesce(*parts)
        if fill and name in fill:
            value = F.coalesce(value, F.lit(fill[name]))
        columns.append(value.alias(name))
    return df.select(*columns)


def auto_fix_counters(df: DataFrame, fill: dict[str, str] | None = None) -> DataFrame:
    """records, trimmed, filled, changed: what ``auto_fix`` does to the strings."""
    text = [F.col(f"`{c}`").cast("string") for c in df.columns]
    trimmed = reduce(lambda a, b: a + b, [F.when(c != F.trim(c), 1).otherwise(0) for c in text])
    filled = reduce(lambda a, b: a + b, [F.when(is_blank(F.col(f"`{c}`")), 1).otherwise(0) for c in df.columns if clean_name(c) in (fill or {})], F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("records"), F.coalesce(F.sum(trimmed), F.lit(0)).alias("trimmed"), F.coalesce(F.sum(filled), F.lit(0)).alias("filled"),
        F.count_if((trimmed > 0) | (filled > 0)).alias("changed"),
    )
