"""Every query of the suite against its SQL, on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from compare import TABLES, normal
from suite.registry import ALL

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: q for part in ALL for name, q in part.queries.items()}
SQL = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)
    assert set(QUERIES) <= set(entry_point.queries())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0
    assert "purchase_date_id" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    result = db.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    assert normal(df.columns, df.collect()) == normal(names, result.fetchall())
