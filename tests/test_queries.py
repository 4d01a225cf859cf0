"""Every registered query against its DuckDB oracle on the smallest tables."""

import collections
import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from envlake.plans.bindings import QUERIES
from envlake.plans.oracle import ORACLE_SQL

TABLES = "region nation customer supplier part orders lineitem events embeddings".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows, scols = df.collect(), df.columns
    cur = con.execute(ORACLE_SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(scols) == sorted(dcols)
    order = sorted(scols)
    sc = collections.Counter(tuple(_norm(r[scols.index(c)]) for c in order) for r in srows)
    dc = collections.Counter(tuple(_norm(r[dcols.index(c)]) for c in order) for r in drows)
    assert sc == dc
    assert dc, "an oracle without rows compares nothing"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "event_id" in df.columns
