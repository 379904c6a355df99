"""Every registered query against DuckDB on the smallest data set."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from larder.plans.oracle import ORACLE
from larder.plans.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def _order(row):
    return tuple((value is None, "" if value is None else str(value)) for value in row)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = sorted((tuple(r) for r in df.select(*columns).collect()), key=_order)
    result = duck.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})")
    expected = sorted(result.fetchall(), key=_order)
    assert found == expected
    assert found


def test_entry(spark):
    assert entry.entry(spark).count() == 12
