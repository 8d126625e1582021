"""Every query with a SQL text agrees with DuckDB on the smallest data folder."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check  # noqa: E402

import __spark_entry__ as entry_point  # noqa: E402
from ledgerlens.plans import catalog  # noqa: E402

WITH_SQL = [n for n, q in catalog.QUERIES.items() if q.sql]


@pytest.fixture(scope="module")
def duck(small):
    return check.connect(small)


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_sql(spark, duck, small, name):
    q = catalog.QUERIES[name]
    df = q.build(spark, small)
    got = check.rows(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(q.sql)
    want = check.rows([d[0] for d in cur.description], cur.fetchall())
    assert got == want


def test_entry_point(spark):
    assert entry_point.entry(spark).count() == 2
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert len(entry_point.queries()) >= 249
