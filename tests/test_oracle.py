"""Every registered query gives the rows its SQL twin gives in DuckDB."""

import decimal
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from bazaarlake import registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return repr(value)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_matches_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = duck.execute(registry.ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = sorted(tuple(_plain(row[names.index(c)]) for c in columns) for row in cursor.fetchall())
    actual = sorted(tuple(_plain(row[c]) for c in columns) for row in df.collect())
    assert actual == expected


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
