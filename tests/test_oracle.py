"""Every registered query equals its DuckDB oracle (rows, column names, values)."""

import hashlib
import math
import os

import duckdb
import pytest

from conftest import SF001

import __spark_entry__ as E
from drover.plans import oracle, registry

TABLES = ["events", "orders", "lineitem"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return repr(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF001, t)}.parquet')")
    return c


OWN = sorted(registry.queries())


def test_every_query_has_an_oracle():
    assert set(OWN) == set(oracle.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "net_profit" in df.columns


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(srows, df.columns) == _digest(orows, ocols)
