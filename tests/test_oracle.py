"""Every query with an oracle agrees with DuckDB on sf0.001 (order-free,
exact values: the queries round what summation order could change)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from quarry.sources.tables import TABLES
from tests.conftest import SF001

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    yield c
    c.close()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0.0 else v)
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    return v


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF001)
    cols = df.columns
    got = sorted(repr(tuple(_norm(v) for v in r)) for r in df.collect())
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    want = sorted(repr(tuple(_norm(r[i]) for i in idx)) for r in cur.fetchall())
    assert got == want
