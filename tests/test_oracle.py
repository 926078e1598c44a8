"""Every query with a SQL twin equals its DuckDB result on the smallest driver tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import duck, rows_of  # noqa: E402

KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_duckdb(spark, sf_small, con, key):
    df = E.queries()[key](spark, sf_small)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    dcols, drows = [d[0] for d in res.description], res.fetchall()
    sc, sr = rows_of(scols, srows)
    dc, dr = rows_of(dcols, drows)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
