"""Every registered query against its DuckDB oracle (the driver's gate), at
sf0.001 for speed; tools/oracle_check.py runs the same at sf0.01."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from starmart.plans import registered as R
from conftest import SF_SMALL

NO_SQL = {"snapshot_drift"}  # from sketches; tests/test_consistency.py plants drift
VIEWS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    return v


def _rows(rows, cols):
    order = sorted(cols)
    idx = [cols.index(c) for c in order]
    out = [tuple(_norm(r[i]) for i in idx) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for v in VIEWS:
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{SF_SMALL}/{v}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(R.QUERIES) <= set(E.queries())
    assert set(R.QUERIES) - NO_SQL <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["AgencyID", "AgencyName", "FiscalYear", "n_rows", "n_employees",
                          "total_gross", "total_ot", "total_other", "total_paid"]


@pytest.mark.parametrize("key", sorted(set(R.QUERIES) - NO_SQL))
def test_query_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[key])
    d_cols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(d_cols)
    s_rows = _rows(sdf.collect(), sdf.columns)
    d_rows = _rows(res.fetchall(), d_cols)
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows
