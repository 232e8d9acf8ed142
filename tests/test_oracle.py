"""Every registered query against its DuckDB oracle on sf0.001."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

from testdata import SMALL
import __spark_entry__ as entry
from railyard.plans.registry import queries as own_queries

TABLES = "region nation customer supplier part orders lineitem events".split()


def _norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        return "nan" if math.isnan(f) else float(f"{f:.12g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(
        (tuple(_norm(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((x is None, str(x)) for x in r),
    )


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(own_queries()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SMALL)
    got = df.collect()
    sql = entry.oracle_sql()[name]  # every query of the warehouse has its oracle
    cur = con.execute(sql)
    want = cur.fetchall()
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, got) == _rows(cols, want)


def test_entry_smoke(spark):
    assert entry.entry(spark).count() > 0
