"""Registered queries: entry smoke, plan shape, and DuckDB oracle at sf0.001."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from staykit.oracle import ORACLE
from staykit.registry import QUERIES
from tests.conftest import SF_SMALL

TABLES = ["orders", "lineitem", "customer", "nation"]


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 43


def test_every_oracle_key_is_a_query():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_duckdb(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    got = df.collect()
    cur = duck.execute(ORACLE[key])
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, got) == rows(names, want)
