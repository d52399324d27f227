"""Unions of sources with unlike columns."""

from pyspark.sql import DataFrame, functions as F


def align(first: DataFrame, second: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Give both frames all columns, in order of first appearance; a missing one is NULL of the other's type."""
    types = {f.name: f.dataType for f in [*second.schema, *first.schema]}
    columns = list(dict.fromkeys(first.columns + second.columns))

    def fill(df: DataFrame) -> DataFrame:
        own = set(df.columns)
        return df.select(*[F.col(f"`{c}`") if c in own else F.lit(None).cast(types[c]).alias(c) for c in columns])

    return fill(first), fill(second)


def aligned_union(first: DataFrame, second: DataFrame) -> DataFrame:
    """Bag union, columns in order of first appearance."""
    first, second = align(first, second)
    return first.unionByName(second)


def column_drift(first: DataFrame, second: DataFrame) -> tuple[list[str], list[str]]:
    """Columns only the first and only the second frame has."""
    return (
        [c for c in first.columns if c not in second.columns],
        [c for c in second.columns if c not in first.columns],
    )
