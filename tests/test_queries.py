"""Every core query runs; those with SQL give its rows."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from lakeq.plans import catalog


def value(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(value(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con(data):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, data, con, name):
    df = catalog.queries()[name](spark, data)
    mine = bag(df.columns, df.collect())
    assert len(set(df.columns)) == len(df.columns)
    if name in catalog.oracle_sql():
        result = con.execute(catalog.oracle_sql()[name])
        assert mine == bag([c[0] for c in result.description], result.fetchall())


def test_sql_is_of_known_queries():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())


def test_entry(spark):
    assert catalog.flagship(spark, "/root/testdata/sf0.001").columns[:2] == ["window_start", "window_end"]
