"""Every query with a SQL counterpart against DuckDB, on the smallest tables."""

import datetime
import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL and not n[:1] == "p" or n in SQL and not n[1:2].isdigit()])
def test_query(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    r = duck.execute(SQL[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    want = Counter(tuple(str(norm(row[names.index(c)])) for c in cols) for row in r.fetchall())
    assert Counter(tuple(str(norm(row[c])) for c in cols) for row in df.collect()) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
