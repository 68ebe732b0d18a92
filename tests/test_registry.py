"""Every registered query against its SQL on the smallest test tables."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    got = rows_of(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, cursor.fetchall())


def test_flagship(spark):
    assert not entry.entry(spark).isEmpty()
