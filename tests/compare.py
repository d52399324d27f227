"""Run a query on Spark and its SQL on DuckDB and compare the rows."""

import math
from datetime import date

import duckdb


def database(folder: str, tables) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in tables:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, date):
        return str(value)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_value(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return rows_of(df.columns, df.collect())


def sql_rows(connection, sql):
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    return rows_of(columns, result.fetchall())
