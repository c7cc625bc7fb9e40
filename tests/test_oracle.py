"""Every catalog query against its DuckDB oracle (driver tables, sf0.001 for
speed; tools/oracle_check.py runs the same comparison at sf0.01)."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as se
from augur.plans.catalog import QUERIES
from augur.plans.oracle import ORACLE_SQL as SQL
from augur.sources.tables import TABLES
from conftest import SF_SMALL


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (int, bool, str)) or v is None:
        return v
    return int(v) if hasattr(v, "__int__") else str(v)


def multiset(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(se.queries()) and set(se.oracle_sql()) <= set(se.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert multiset(srows, scols) == multiset(drows, dcols)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == [
        "question_id", "question_text", "forecaster_count", "median_prediction",
        "mean_prediction", "stddev_prediction", "min_prediction", "max_prediction",
    ]
    assert df.count() > 0
