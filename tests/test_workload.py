"""Every query that SQL can express, against DuckDB."""

import pytest

from chartspark.plans.inputs import TABLES
from chartspark.plans.workload import ORACLES, QUERIES
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
    assert rows, "a comparison of no rows shows nothing"
    assert len(rows) == len(expected)
    assert rows == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
