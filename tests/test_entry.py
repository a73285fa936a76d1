"""The driver's contract, and every query with SQL at the smallest scale."""

import math
import os

import duckdb
import pytest

import __spark_entry__
from quern.plans.catalogue import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in os.listdir(DATA):
        c.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return c


def _rows(columns, rows):
    order = sorted(columns)
    clean = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted(str([clean(r[columns.index(c)]) for c in order]) for r in rows)


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, DATA)
    got = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in got.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, got.fetchall())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE_SQL])
def test_other_queries_run(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 11
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
