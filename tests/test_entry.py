"""Every registered query against its SQL, on the smallest data set."""

import os

import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
DUCKDB_TYPES = {
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "boolean": "BOOLEAN",
}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def sql():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    return con


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", contract.queries())
def test_query_matches_sql(spark, sql, name):
    df = contract.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    rows = ordered(df.select(columns).collect())
    statement = contract.oracle_sql().get(name)
    if statement is None:
        assert rows
        return
    expected = sql.sql(statement)
    types = dict(df.dtypes)
    assert {c: DUCKDB_TYPES[types[c]] for c in columns} == dict(
        zip(expected.columns, map(str, expected.types), strict=True)
    )
    assert rows == ordered(expected.select(*[f'"{c}"' for c in columns]).fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["year_month", "primary_category", "avg_rating"] and df.count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
