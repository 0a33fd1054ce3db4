"""Every registered query against its DuckDB statement on the smallest tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from safetylake.plans import catalog

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
# the library's own queries; the optional training-data ones have their own tests
SQL = {k: v for k, v in entry.oracle_sql().items() if k in catalog.QUERIES}
QUERIES = {k: entry.queries()[k] for k in catalog.QUERIES}


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["product_name", "reaction_name", "event_count", "serious_count",
                          "earliest_report", "latest_report"]


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    got = canon(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = con.execute(SQL[key])
    cols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(cols)
    assert got == canon(cols, res.fetchall())
