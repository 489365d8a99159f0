import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeq.functions import temporal
from lakeq.operators import timestamps as ts
from tests.conftest import rows

ZONES = [("NYA", "America/New_York", False), ("LDN", "Europe/London", True), ("UNK", "Nowhere/At_All", None), ("TKY", "Asia/Tokyo", False)]
ROW = "rec_id long, feed_code string, text string, norm string, readings string"


def read(spark, given, kind, zones=ZONES):
    table = spark.createDataFrame([(i, f, t, "n", "r") for i, (f, t) in enumerate(given)], ROW)
    out = ts.normalise(ts.source_rows(table, "t", "text", kind), spark.createDataFrame(zones, "feed_code string, zone_name string, day_first boolean"))
    return [r.norm for r in sorted(out.collect(), key=lambda r: r.rec_id)]


INSTANTS = [
    ("NYA", "2014-03-22T02:40:11.000000Z", "2014-03-22T02:40:11.000000Z"),
    ("NYA", " 2014-03-22t02:40:11z ", "2014-03-22T02:40:11.000000Z"),
    ("NYA", "2014-11-02 01:30:00", "2014-11-02T05:30:00.000000Z"),  # twice: the first
    ("NYA", "2014-11-02 01:30:00 EST", "2014-11-02T06:30:00.000000Z"),
    ("NYA", "2014-03-09 02:30:00", "2014-03-09T07:30:00.000000Z"),  # skipped: offset before
    ("LDN", "2014-07-01 12:00:00 BST", "2014-07-01T11:00:00.000000Z"),
    ("NYA", "2014-06-22 14:44:58 America/New_York", "2014-06-22T18:44:58.000000Z"),
    ("TKY", "2014-06-22T14:44:58-04:00[America/New_York]", "2014-06-22T18:44:58.000000Z"),
    ("LDN", "02/03/2014 01:02:03 pm", "2014-03-02T13:02:03.000000Z"),
    ("NYA", "02/03/2014 12:02:03 AM", "2014-02-03T05:02:03.000000Z"),
    ("TKY", "02-APR-13 03.14.23 PM", "2013-04-02T06:14:23.000000Z"),
    ("LDN", "Wed, 26 Mar 2014 16:42:56 -0400", "2014-03-26T20:42:56.000000Z"),
    ("LDN", "Aug 4, 2014 10:29:39 AM", "2014-08-04T09:29:39.000000Z"),
    ("TKY", "20120828084026", "2012-08-27T23:40:26.000000Z"),
    ("TKY", "20131016-015411", "2013-10-15T16:54:11.000000Z"),
    ("NYA", "20150516T155416Z", "2015-05-16T15:54:16.000000Z"),
    ("NYA", "1426752779", "2015-03-19T08:12:59.000000Z"),
    ("NYA", "1381161406901", "2013-10-07T15:56:46.901000Z"),
    ("NYA", "1400704847000001", "2014-05-21T20:40:47.000001Z"),
    ("NYA", "1400704847000001999", "2014-05-21T20:40:47.000001Z"),
    ("NYA", "2012-10-22T04:57:39.123456789Z", "2012-10-22T04:57:39.123456Z"),
    ("LDN", "2014-11-10 12:12:06,123", "2014-11-10T12:12:06.123000Z"),
    ("NYA", "2013-08-02 12:20:59-04", "2013-08-02T16:20:59.000000Z"),
    ("NYA", "2013-08-02 12:20", "2013-08-02T16:20:00.000000Z"),
    ("NYA", "2015-02-30T00:00:00.000000Z", None),
    ("NYA", "2015-02-28T25:00:00Z", None),
    ("NYA", "13/13/2014 10:00:00", None),
    ("NYA", "hello", None),
    ("NYA", "", None),
    ("NYA", "x" * 200_000, None),
    ("NYA", None, None),
    ("UNK", "2014-01-01 10:00:00", "2014-01-01T10:00:00.000000Z"),
    (None, "2014-01-01 10:00:00", "2014-01-01T10:00:00.000000Z"),
    ("NYA", "2014-01-01 10:00:00 XYZ", None),
]
DATES = [
    ("NYA", "2014-01-31", "2014-01-31"), ("NYA", "2014-02-30", None), ("NYA", "03/04/2014", "2014-03-04"), ("LDN", "03/04/2014", "2014-04-03"), ("LDN", "03/04/14", "2014-04-03"),
    ("NYA", "13.06.2014", "2014-06-13"), ("NYA", "20140230", "1970-08-21"), ("NYA", "20140228", "2014-02-28"), ("NYA", "2014-060", "2014-03-01"), ("NYA", "2014-366", None), ("NYA", "2012-366", "2012-12-31"),
    ("NYA", "2014-W01-1", "2013-12-30"), ("NYA", "2015-W53-7", "2016-01-03"), ("NYA", "2014-W53-1", None), ("NYA", "2013-01-08T02:00:00Z", "2013-01-07"), ("TKY", "2013-01-08T20:00:00Z", "2013-01-09"),
    ("TKY", "2013-01-08 20:00:00", "2013-01-08"), ("NYA", "1381201200", "2013-10-07"), ("NYA", "21-MAR-2013", "2013-03-21"), ("NYA", "Feb 6, 2013", "2013-02-06"), ("NYA", "2015-4-2", "2015-04-02"),
]


def test_instants(spark):
    assert read(spark, [x[:2] for x in INSTANTS], "instant") == [x[2] for x in INSTANTS]


def test_dates(spark):
    mine = read(spark, [x[:2] for x in DATES], "date")
    assert mine == [x[2] for x in DATES]


def test_another_session_zone_changes_nothing(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert read(spark, [x[:2] for x in INSTANTS], "instant") == [x[2] for x in INSTANTS]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_order_of_records_decides_where_no_feed_is_registered(spark):
    texts = ["25/03/2014 10:00:00", "04/05/2014 10:00:00", "28/06/2014 10:00:00"]
    assert [n[:10] for n in read(spark, [("NEW", t) for t in texts], "instant")] == ["2014-03-25", "2014-05-04", "2014-06-28"]
    texts = ["03/25/2014 10:00:00", "04/05/2014 10:00:00", "06/28/2014 10:00:00"]
    assert [n[:10] for n in read(spark, [("NEW", t) for t in texts], "instant")] == ["2014-03-25", "2014-04-05", "2014-06-28"]


def test_records_in_normal_form_are_part_of_the_chain(spark):
    texts = ["2014-06-30T10:00:00.000000Z", "07/05/2014 10:00:00", "2014-07-06T10:00:00.000000Z"]
    assert read(spark, [("NEW", t) for t in texts], "instant")[1][:10] == "2014-07-05"
    texts = ["2014-05-06T10:00:00.000000Z", "07/05/2014 10:00:00", "2014-05-08T10:00:00.000000Z"]
    assert read(spark, [("NEW", t) for t in texts], "instant")[1][:10] == "2014-05-07"


def test_a_registered_order_outweighs_the_path(spark):
    texts = ["2014-06-30T10:00:00.000000Z", "07/05/2014 10:00:00", "2014-07-06T10:00:00.000000Z", "25/12/2014 10:00:00"]
    assert read(spark, [("LDN", t) for t in texts], "instant")[1][:10] == "2014-05-07"
    assert temporal.AGAINST > 2 * (ts.SWITCH + ts.BACKWARD)


def test_a_repeated_hour_has_two_readings(spark):
    frame = spark.createDataFrame([("2014-11-02 01:30:00", "America/New_York", None), ("2014-11-02 03:30:00", "America/New_York", None)], "text string, zone_name string, day_first boolean")
    got = temporal.with_readings(frame.withColumn("abbreviations", F.create_map().cast("map<string,int>"))).collect()
    assert [[(r.instant, r.prior) for r in row.readings] for row in got] == [[(1414906200000000, 0.0), (1414909800000000, temporal.AGAINST)], [(1414917000000000, 0.0)]]


def best_cost(records):
    return min(cost(records, picks) for picks in itertools.product(*[range(len(r)) for r in records]))


def cost(records, picks):
    """Of a whole path, record by record; the order carried in at the start is free."""
    total, order, before = 0.0, None, None
    for readings, i in zip(records, picks):
        fmt, t, prior = readings[i]
        total += prior + (ts.BACKWARD if before is not None and before > t else 0.0)
        if "/" in fmt:
            total += ts.SWITCH if order not in (None, fmt) else 0.0
            order = fmt
        before = t
    return total


def random_records(rng, n):
    out = []
    for _ in range(n):
        kind = rng.choice(["plain", "plain", "certain", "open", "fold"])
        t = rng.randint(0, 6)
        if kind == "plain":
            out.append([("iso", t, 0.0)])
        elif kind == "certain":
            out.append([(rng.choice(["day/month", "month/day"]), t, 0.0)])
        elif kind == "open":
            against = rng.choice([0.0, 0.0, 1.0, 16.0])
            out.append([("day/month", t, 0.0), ("month/day", rng.randint(0, 6), against)])
        else:
            out.append([("iso", t, 0.0), ("iso", t + 1, rng.choice([0.0, 2.0]))])
    return out


STATES = pa.schema([
    ("src_table", pa.string()), ("feed", pa.string()), ("block", pa.int64()), ("rec_id", pa.int64()), ("text", pa.string()), ("is_date", pa.bool_()), ("fmt", pa.string()), ("t", pa.int64()),
    ("alts", pa.list_(pa.struct([("fmt", pa.string()), ("t", pa.int64()), ("prior", pa.float64())]))),
])


def as_block(records, first, block):
    rows = []
    for n, r in enumerate(records, first):
        one = len(r) == 1
        rows.append(("t", "f", block, n, "x", False, r[0][0] if one else None, r[0][1] if one else None, None if one else [dict(fmt=f, t=t, prior=p) for f, t, p in r]))
    return pa.Table.from_pylist([dict(zip(STATES.names, row)) for row in rows], schema=STATES)


@pytest.mark.parametrize("seed", range(40))
def test_blocks_find_a_cheapest_path(seed):
    """Blocks of uneven size, folded once, against every path."""
    rng = random.Random(seed)
    records = random_records(rng, 9)
    cuts = sorted(rng.sample(range(1, 9), 3))
    blocks = [as_block(records[a:b], a, n) for n, (a, b) in enumerate(zip([0, *cuts], [*cuts, 9]))]
    nodes = [ts._summarise(b) for b in blocks]
    above = lambda part, g: pa.concat_tables(part).append_column("above", pa.array([g] * len(part), pa.int64()))
    groups = [above(nodes[:2], 0), above(nodes[2:], 1)]
    top = ts._top(pa.concat_tables([ts._fold(g) for g in groups]))
    ends = [row for n, g in enumerate(groups) for row in ts._below(g, top.slice(n, 1)).to_pylist()]
    picked = [r for b, e in zip(blocks, ends) for r in sorted(ts._trace(b, pa.Table.from_pylist([e], schema=ts.ENDS)).to_pylist(), key=lambda r: r["rec_id"])]
    picks = [next(i for i, x in enumerate(r) if (x[0], x[1]) == (p["fmt"], p["t"])) for r, p in zip(records, picked)]
    assert np.isclose(cost(records, picks), best_cost(records))


def test_many_blocks_and_one_feed_with_most_records(spark, monkeypatch):
    """Small blocks and folds give the readings of one block; a feed holds two thirds of the records."""
    rng = random.Random(5)
    given = [("NEW" if rng.random() < 0.7 else "OLD", f"{rng.randint(1, 12):02d}/{rng.randint(1, 28):02d}/2014") for _ in range(300)]
    whole = read(spark, given, "date", zones=[])
    monkeypatch.setattr(ts, "BLOCK", 3)
    monkeypatch.setattr(ts, "FAN", 4)
    assert read(spark, given, "date", zones=[]) == whole
    assert all(n[8:] != "" for n in whole)


def test_empty(spark):
    assert read(spark, [], "instant") == []


def test_repeated_and_missing_record_numbers(spark):
    table = spark.createDataFrame([(1, "NYA", "2014-01-01 10:00:00", "", ""), (1, "NYA", "2014-01-01 10:00:00", "", ""), (None, "NYA", "2014-01-01 11:00:00", "", "")], ROW)
    zones = spark.createDataFrame(ZONES, "feed_code string, zone_name string, day_first boolean")
    out = ts.normalise_spelled(ts.source_rows(table, "t", "text", "instant"), zones)
    assert rows(out.select("rec_id", "norm")) == sorted([(1, "2014-01-01T15:00:00.000000Z")] * 2 + [(None, "2014-01-01T16:00:00.000000Z")], key=repr)
