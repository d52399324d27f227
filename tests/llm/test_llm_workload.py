"""Queries that SQL can express, against DuckDB."""

import pytest

from chartspark.llm.workload import ORACLES, QUERIES
from chartspark.plans.inputs import TABLES
from compare import database, spark_rows, sql_rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return database(FOLDER, TABLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    columns, rows = spark_rows(QUERIES[name](spark, FOLDER))
    expected_columns, expected = sql_rows(duck, ORACLES[name])
    assert columns == expected_columns
    assert rows and rows == expected
