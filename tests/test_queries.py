"""Every core query runs on the smallest tables, and equals its SQL there where it has one."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from loomspan.plans import catalog

sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))
DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="the test tables are missing")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for f in os.listdir(DIR):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    from compare import canonical

    df = catalog.QUERIES[name](spark, DIR)
    rows = [tuple(r) for r in df.collect()]
    if name in catalog.SQL:
        result = db.sql(catalog.SQL[name])
        assert canonical(rows, df.columns) == canonical(result.fetchall(), result.columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
