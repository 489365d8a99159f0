"""Readings of timestamp texts as column expressions.

``readings`` gives every valid interpretation of a text as an array of structs, all inside the JVM: a text is
matched once against its family's pattern, which rewrites it to named parts, and each family turns the parts
into one or more instants. Nothing depends on the session's time zone.
"""

from __future__ import annotations

import datetime as dt
import zoneinfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeq.session import bounded_rows

DAY = 86_400_000_000
#: Feeds are metadata; more are refused.
MAX_FEEDS = 100_000
#: Cost of another order of day and month than the source's slash dates had before, and of a step back in time.
SWITCH, BACKWARD = 4.0, 1.0
#: Prior cost of a reading that a feed's registration, the plain sense of digits or the rule for a repeated local
#: hour speaks against: more than the two transitions of a record can save, so such a rule holds where it speaks.
AGAINST = 16.0
NORMAL_INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}Z$"
NORMAL_DATE = r"^\d{4}-\d{2}-\d{2}$"

_TAIL = (
    r"(?:[Tt ,]\s*(\d{1,2})[:.](\d{2})(?:[:.](\d{2})(?:[.,](\d+))?)?(?:\s*([AaPp])[Mm](?![A-Za-z]))?"
    r"\s*(Z|z|[+-]\d{2}(?::?\d{2})?|[A-Za-z]{2,5}|[A-Za-z_]+(?:/[A-Za-z_+\-0-9]+)+)?(?:\[([^\]|]+)\])?)?$"
)
_REST = "$4|$5|$6|$7|$8|$9|$10"
#: family -> (pattern, parts: year|month|day|hour|minute|second|fraction|am or pm|zone|zone in brackets)
FAMILIES = {
    "ymd": (r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})" + _TAIL, f"$1|$2|$3|{_REST}"),
    "slash": (r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4}|\d{2})" + _TAIL, f"$3|$1|$2|{_REST}"),
    "day_name": (r"^(?:[A-Za-z]{3,9},\s*)?(\d{1,2})[- ]([A-Za-z]{3,9})[-, ]\s*(\d{4}|\d{2})" + _TAIL, f"$3|$2|$1|{_REST}"),
    "name_day": (r"^(?:[A-Za-z]{3,9},\s*)?([A-Za-z]{3,9})\.? (\d{1,2}),? (\d{4})" + _TAIL, f"$3|$1|$2|{_REST}"),
    "point": (r"^(\d{1,2})\.(\d{1,2})\.(\d{4}|\d{2})" + _TAIL, f"$3|$2|$1|{_REST}"),
    "compact": (r"^(\d{4})(\d{2})(\d{2})[T-](\d{2})(\d{2})(?:(\d{2})(?:[.,](\d+))?)?()(Z|[+-]\d{2}(?::?\d{2})?)?()$", f"$1|$2|$3|{_REST}"),
    "ordinal": (r"^(\d{4})-(\d{3})()" + _TAIL, f"$1|$2|$3|{_REST}"),
    "week": (r"^(\d{4})-?W(\d{2})-?(\d)" + _TAIL, f"$1|$2|$3|{_REST}"),
}
READING = "struct<fmt:string,instant:bigint,day:bigint,prior:double>"


def abbreviations(zone: str) -> dict[str, int]:
    """Abbreviation -> minutes east of UTC in a zone, as of 1990 to 2037, the later use winning."""
    out: dict[str, int] = {}
    info = zoneinfo.ZoneInfo(zone)
    for year in range(1990, 2038):
        for month in range(1, 13):
            at = dt.datetime(year, month, 15, tzinfo=info)
            out[at.tzname().upper()] = int(at.utcoffset().total_seconds() // 60)
    return out


def feed_table(zones: DataFrame) -> DataFrame:
    """feed_code, zone_name, day_first, abbreviations: bounded metadata, safe to broadcast. Unknown zones read as UTC."""
    known = zoneinfo.available_timezones()
    feeds = {}
    for r in bounded_rows(zones.select("feed_code", "zone_name", "day_first").filter("feed_code IS NOT NULL").distinct(), MAX_FEEDS, "feed_zones"):
        zone = r[1] if r[1] in known else "UTC"
        feeds[r[0]] = (r[0], zone, r[2], abbreviations(zone))
    return zones.sparkSession.createDataFrame(list(feeds.values()), "feed_code string, zone_name string, day_first boolean, abbreviations map<string,int>").coalesce(1)


def _int(c: Column) -> Column:
    return c.try_cast("int")


def _day(year: Column, month: Column, day: Column) -> Column:
    """Days since 1970, null where there is no such date."""
    return F.unix_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")).try_cast("date"))


def to_instant(local: Column, zone: Column) -> Column:
    """A local time in a zone as UTC microseconds: the first of two, and before a gap's change."""
    return F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local), zone))


def to_local(instant: Column, zone: Column) -> Column:
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(instant), zone))


def second_instant(first: Column, local: Column, zone: Column) -> Column:
    """The later instant of a local time that occurs twice, else null."""
    later = first + 3 * 3_600_000_000
    other = local - (to_local(later, zone) - later)
    return F.when((other > first) & (to_local(other, zone) == local), other)


def with_readings(rows: DataFrame, text: str = "text", out: str = "readings", folds: Column | None = None) -> DataFrame:
    """Adds array<READING> of the valid interpretations of ``text``; rows also hold zone_name, day_first, abbreviations.

    ``folds``: where a local time that occurs twice has both readings (everywhere, unless said).

    ``instant`` in UTC microseconds; ``day`` the calendar date as days since 1970 (as written, or in the
    feed's zone where the text names an instant); ``prior`` the cost of the reading by itself. Each step is a
    projection of its own, so that shared parts are computed once and the expressions stay small.
    """
    t = F.btrim(F.col(text), F.lit(" \t\r\n"))
    rewritten = F.lit(None).cast("string")
    for family, (pattern, parts) in reversed(FAMILIES.items()):
        rewritten = F.when(t.rlike(pattern), F.regexp_replace(t, pattern, f"{family}|{parts}")).otherwise(rewritten)
    bare = t.rlike(r"^-?\d{1,19}$")
    split = rows.withColumn("_digits", F.when(bare, t)).withColumn("_parts", F.when(~bare, F.split(rewritten, r"\|", -1)))
    written = split.withColumn("_written", _written_days()).withColumn("_clock", _clock()).withColumn("_zone", _zone())
    # local time -> instant, one small struct after the other
    local = written.withColumn(
        "_local",
        F.transform("_written", lambda w: F.struct(w["fmt"].alias("fmt"), w["day"].cast("bigint").alias("day"), w["prior"].alias("prior"), (w["day"].cast("bigint") * DAY + F.col("_clock")).alias("local"))),
    )
    z = F.col("_zone")
    timed = local.withColumn(
        "_timed",
        F.transform(
            "_local",
            lambda w: F.struct(
                w["fmt"].alias("fmt"), w["day"].alias("day"), w["prior"].alias("prior"), w["local"].alias("local"),
                F.when(z["offset"].isNotNull(), w["local"] - z["offset"].cast("bigint") * 60_000_000).otherwise(to_instant(w["local"], z["region"])).alias("instant"),
            ),
        ),
    )
    again = F.transform(
        F.filter("_timed", lambda w: w["instant"].isNotNull()),
        lambda w: F.struct(
            w["fmt"].alias("fmt"), w["day"].alias("day"), (w["prior"] + AGAINST).alias("prior"), w["local"].alias("local"),
            second_instant(w["instant"], w["local"], z["region"]).alias("instant"),
        ),
    )
    twice = z["offset"].isNull() & z["region"].isNotNull() & (F.lit(True) if folds is None else folds)
    timed = timed.withColumn("_again", F.when(twice, again)).withColumn("_timed", F.when(F.col("_again").isNull(), F.col("_timed")).otherwise(F.concat("_timed", "_again"))).drop("_again")
    from_parts = F.transform(
        "_timed", lambda w: _reading(w["fmt"], w["instant"], F.when(z["named"], F.floor(to_local(w["instant"], F.col("zone_name")) / DAY)).otherwise(w["day"]), w["prior"])
    )
    both = timed.withColumn("_read", from_parts).withColumn("_units", F.when(F.col("_digits").isNotNull(), _epoch())).withColumn("_wall", F.when(F.col("_digits").isNotNull(), _wall()))
    zone = F.col("zone_name")
    from_digits = F.array(
        _reading(F.lit("date digits"), to_instant(F.col("_wall"), zone), F.floor(F.col("_wall") / DAY), F.when(F.length("_digits") == 10, AGAINST).otherwise(0.0)),
        _reading(
            F.lit("since 1970"), F.col("_units"), F.floor(to_local(F.col("_units"), zone) / DAY),
            F.when(F.col("_wall").isNotNull() & (F.length("_digits") != 10), AGAINST).otherwise(0.0),
        ),
    )
    every = both.withColumn(out, F.coalesce(F.when(F.col("_digits").isNotNull(), from_digits).otherwise(F.col("_read")), F.array().cast(f"array<{READING}>")))
    kept = every.withColumn(out, F.filter(out, lambda r: r["instant"].isNotNull() & r["day"].isNotNull()))
    return kept.drop("_digits", "_parts", "_written", "_clock", "_zone", "_local", "_timed", "_read", "_units", "_wall")


def _reading(fmt: Column, instant: Column, day: Column, prior: Column) -> Column:
    return F.struct(fmt.alias("fmt"), instant.cast("bigint").alias("instant"), day.cast("bigint").alias("day"), prior.cast("double").alias("prior"))


def _part(n: int) -> Column:
    return F.get("_parts", n)


def _written_days() -> Column:
    """array<struct<fmt, day, prior>> of the dates that the parts can mean; invalid ones have no day."""
    family, y, mo, d = (_part(i) for i in range(4))
    year = F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)
    at_name = F.instr(F.lit("JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC"), F.upper(F.substring(mo, 1, 3)))
    named = F.when((at_name > 0) & (at_name % 4 == 1), ((at_name + 3) / 4).cast("int").cast("string"))
    monday = F.unix_date(F.date_trunc("week", F.concat(y, F.lit("-01-04")).try_cast("date")).cast("date"))
    next_monday = F.unix_date(F.date_trunc("week", F.concat((_int(y) + 1).cast("string"), F.lit("-01-04")).try_cast("date")).cast("date"))
    week_day = monday + (_int(mo) - 1) * 7 + _int(d) - 1
    first = F.unix_date(F.concat(y, F.lit("-01-01")).try_cast("date"))
    last = F.unix_date(F.concat(y, F.lit("-12-31")).try_cast("date"))
    day_of_year = first + _int(mo) - 1

    def means(fmt: str, day: Column, prior: Column | None = None) -> Column:
        return F.struct(F.lit(fmt).alias("fmt"), day.cast("int").alias("day"), (F.lit(0.0) if prior is None else prior).alias("prior"))

    against = lambda registered: F.when(F.col("day_first") == registered, AGAINST).otherwise(0.0)
    return (
        F.when(family == "slash", F.array(means("day/month", _day(year, d, mo), against(False)), means("month/day", _day(year, mo, d), against(True))))
        .when(family == "ymd", F.array(means("year-month-day", _day(year, mo, d))))
        .when(family == "point", F.array(means("day.month", _day(year, mo, d))))
        .when(family == "day_name", F.array(means("day name", _day(year, named, d))))
        .when(family == "name_day", F.array(means("name day", _day(year, named, d))))
        .when(family == "compact", F.array(means("compact", _day(year, mo, d))))
        .when(family == "ordinal", F.array(means("ordinal", F.when((_int(mo) >= 1) & (day_of_year <= last), day_of_year))))
        .when(family == "week", F.array(means("week", F.when(_int(d).between(1, 7) & (_int(mo) >= 1) & (week_day < next_monday), week_day))))
    )


def _clock() -> Column:
    """Microseconds of the day, missing parts zero, null where there is no such time."""
    h, mi, s, frac, ap = (_part(i) for i in range(4, 9))
    hour = F.coalesce(_int(h), F.lit(0))
    hour = F.when(F.upper(ap) == "P", F.when(hour.between(1, 12), hour % 12 + 12)).when(F.upper(ap) == "A", F.when(hour.between(1, 12), hour % 12)).otherwise(hour)
    minute, second = F.coalesce(_int(mi), F.lit(0)), F.coalesce(_int(s), F.lit(0))
    micros = F.coalesce(_int(F.rpad(F.substring(frac, 1, 6), 6, "0")), F.lit(0))
    return F.when((hour < 24) & (minute < 60) & (second < 60), (hour * 3600 + minute * 60 + second).cast("bigint") * 1_000_000 + micros)


def _zone() -> Column:
    """struct<offset, region, named>: minutes east where written, else the region; named: the text names an instant."""
    z, bracket = _part(9), _part(10)
    known = ", ".join(f"'{r}'" for r in sorted(zoneinfo.available_timezones()) if "/" in r)  # one call, not one for each
    sign = F.when(F.substring(z, 1, 1) == "-", -1).otherwise(1)
    written = sign * (_int(F.substring(z, 2, 2)) * 60 + F.coalesce(_int(F.regexp_extract(z, r"^[+-]\d{2}:?(\d{2})$", 1)), F.lit(0)))
    offset = F.when(z.rlike(r"^[+-]\d{2}"), written).when(
        z != "", F.coalesce(F.try_element_at(F.col("abbreviations"), F.upper(z)), F.when(F.upper(z).isin("Z", "UTC", "GMT"), 0))
    )
    region = F.expr(
        f"CASE WHEN get(_parts, 9) <> '' THEN CASE WHEN get(_parts, 9) IN ({known}) THEN get(_parts, 9) END"
        f" WHEN get(_parts, 10) = '' THEN zone_name WHEN get(_parts, 10) IN ('UTC', 'GMT', {known}) THEN get(_parts, 10) END"
    )
    return F.struct(offset.alias("offset"), region.alias("region"), ((z != "") | (bracket != "")).alias("named"))


def _epoch() -> Column:
    """Bare digits as units since 1970 UTC: days, seconds, milli-, micro- or nanoseconds by their number."""
    t, size = F.col("_digits"), F.length("_digits")
    number = t.try_cast("bigint")
    return (
        F.when(size <= 5, number * DAY)
        .when(size <= 11, number * 1_000_000)
        .when(size <= 14, number * 1000)
        .when(size <= 17, number)
        .otherwise(F.expr("try_cast(_digits AS bigint) div 1000"))
    )


def _wall() -> Column:
    """Bare digits as those of a date and time: local microseconds, null where there is none."""
    t, size = F.col("_digits"), F.length("_digits")
    piece = lambda a, n, least: F.when(size >= least, _int(F.substring(t, a, n))).otherwise(0)
    hour, minute, second = piece(9, 2, 10), piece(11, 2, 12), piece(13, 2, 14)
    day = F.when(size.isin(8, 10, 12, 14, 17), _day(F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2)))
    clock = F.when((hour < 24) & (minute < 60) & (second < 60), (hour * 3600 + minute * 60 + second).cast("bigint") * 1000 + piece(15, 3, 17))
    return day.cast("bigint") * DAY + clock * 1000


def instant_text(micros: Column) -> Column:
    """YYYY-MM-DDTHH:MM:SS.ffffffZ"""
    second = F.pmod(F.floor(micros / 1_000_000), F.lit(86_400))
    two = lambda c: F.lpad(c.cast("int").cast("string"), 2, "0")
    day = F.date_from_unix_date(F.floor(micros / DAY).cast("int")).cast("string")
    return F.concat(
        day, F.lit("T"), two(F.floor(second / 3600)), F.lit(":"), two(F.floor(second / 60) % 60), F.lit(":"), two(second % 60), F.lit("."),
        F.lpad(F.pmod(micros, F.lit(1_000_000)).cast("string"), 6, "0"), F.lit("Z"),
    )


def date_text(days: Column) -> Column:
    return F.date_from_unix_date(days.cast("int")).cast("string")
