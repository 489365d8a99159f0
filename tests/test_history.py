import random

from lakeq.operators import history
from tests.conftest import rows

CHANGES = "customerid long, batchid long, sk long, effectivedate string, a string, b long, state string, word long"
SNAPSHOTS = "accountid long, batchid long, sk long, a string, b long, bits string"


def same(v):
    return "" if v is None else str(v).strip().lower()


def test_changes_against_brute_force(spark):
    rng = random.Random(3)
    given = [(rng.choice([1, 2, 3, None]), rng.randint(1, 3), i, rng.choice([None, *[f"2015-01-{n:02}" for n in range(1, 9)]]), rng.choice(["x", " X", "y", None, ""]), rng.choice([1, None]), "s", 0) for i in range(160)]
    given += given[:30]
    state, out = {}, set()
    for k, b, sk, day, a, n, *_ in given:
        if k is not None and day is not None:
            state[(k, day)] = max(state.get((k, day), (-1, -1, "")), (b, sk, (same(a), same(n))))
    for k in {k for k, _ in state}:
        days = sorted(day for q, day in state if q == k)
        starts = [x for i, x in enumerate(days) if i == 0 or state[(k, x)][2] != state[(k, days[i - 1])][2]]
        out |= {("c", k, x, starts[i + 1] if i + 1 < len(starts) else "9999-12-31") for i, x in enumerate(starts)}
    df = history.change_history(spark.createDataFrame(given, CHANGES), "c", "customerid", ["a", "b"], rank=("batchid", "sk"))
    assert {tuple(r)[:4] for r in df.collect()} == out and df.count() == len(out)


def test_snapshots_with_gaps_over_more_than_a_word(spark):
    rng = random.Random(4)
    dates = {n: f"{2000 + n // 12}-{n % 12 + 1:02}-01" for n in range(150)}
    given = [(k, n, i, rng.choice(["x", "x ", "X"] if rng.random() < 0.9 else ["y"]), None, "") for i, (k, n) in enumerate((k, n) for k in (1, 2) for n in dates if rng.random() < 0.93)]
    given += [(3, n, n, "z", 1, "") for n in range(150)] + [(None, 1, 1, "q", 1, ""), (4, None, 1, "q", 1, ""), (5, 999, 1, "q", 1, "")]
    out = set()
    for k in (1, 2, 3):
        at = {n: same(a) for q, n, _, a, *_ in given if q == k}
        start = None
        for n in range(151):
            if start is not None and at.get(n) != at[start]:
                out.add(("a", k, dates[start], dates.get(n, "9999-12-31")))
                start = None
            if start is None and n in at:
                start = n
    calendar = spark.createDataFrame(list(dates.items()), "batchid long, batch_date string")
    df = history.snapshot_history(spark.createDataFrame(given, SNAPSHOTS), "a", "accountid", ["a", "b"], calendar, rank="sk")
    assert {tuple(r)[:4] for r in df.collect()} == out


def test_ties_and_returns(spark):
    calendar = spark.createDataFrame([(1, "2015-01-01"), (2, "2015-02-01"), (3, "2015-03-01")], "batchid long, batch_date string")
    given = [(9, 1, 1, "x", 1, ""), (9, 1, 2, "y", 1, ""), (9, 3, 3, "y", 1, ""), (9, 3, 3, "y", 1, "")]
    df = history.snapshot_history(spark.createDataFrame(given, SNAPSHOTS), "a", "accountid", ["a", "b"], calendar, rank="sk").drop("state")
    assert rows(df) == [("a", 9, "2015-01-01", "2015-02-01"), ("a", 9, "2015-03-01", "9999-12-31")]


def test_empty(spark):
    calendar = spark.createDataFrame([], "batchid long, batch_date string")
    assert history.snapshot_history(spark.createDataFrame([], SNAPSHOTS), "a", "accountid", ["a"], calendar, rank="sk").count() == 0
    assert history.change_history(spark.createDataFrame([], CHANGES), "c", "customerid", ["a"], rank=("batchid",)).count() == 0
