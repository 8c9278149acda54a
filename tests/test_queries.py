"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as driver
import check
import oracle_queries
import spark_queries

SF = "/root/testdata/sf0.001"
# Its rows are nearly those of an exact query; tests/test_approximate.py measures how nearly.
WITHOUT_SQL = {"approximate_topn"}


@pytest.fixture(scope="module")
def connection():
    found = duckdb.connect()
    for table in check.TABLES:
        found.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return found


@pytest.mark.parametrize("name", sorted(oracle_queries.oracle_sql()))
def test_query_equals_its_sql(spark, connection, name):
    line = check.compare(spark, connection, name, SF)
    assert line.startswith("ok"), line


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(oracle_queries.oracle_sql()) == set(spark_queries.queries()) - WITHOUT_SQL


def test_entry(spark):
    found = driver.entry(spark)
    assert found.columns == [
        "token_id", "word", "rank", "neighbour_id", "neighbour", "similarity",
    ]
    assert found.count() > 0
