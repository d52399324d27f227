"""Data-quality reports. Each is one aggregate and returns a table."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chartspark.fixed_values import DEFAULT_GENRE, PUBLISH_FLOOR
from chartspark.operators.unite import align


class IncompleteData(ValueError):
    """The data has too few rows to publish."""


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without NULL or NaN in the columns."""
    return df.na.drop(subset=list(columns))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: the number of NULLs of each column, and of rows."""
    counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}_nulls") for c in columns or df.columns]
    return df.agg(*counts, F.count("*").alias("n_rows"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Values by falling frequency, NULL left out."""
    return (
        df.filter(F.col(column).isNotNull()).groupBy(column).count().orderBy(F.desc("count"), F.asc(column))
    )


def array_values(df: DataFrame, column: str, out: str = "value") -> DataFrame:
    """All distinct elements of an array column over all rows."""
    return df.select(F.explode(column).alias(out)).distinct()


def is_not_found(id_column: str) -> Column:
    return F.col(id_column).isNull()


def is_unidentified(label: str = "genre", default: str = DEFAULT_GENRE) -> Column:
    return F.col(label) == default


def not_found(df: DataFrame, id_column: str) -> DataFrame:
    return df.filter(is_not_found(id_column))


def unidentified(df: DataFrame, label: str = "genre", default: str = DEFAULT_GENRE) -> DataFrame:
    return df.filter(is_unidentified(label, default))


def shape(df: DataFrame) -> DataFrame:
    """One row: the numbers of rows and columns."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def schema_profile(first: DataFrame, second: DataFrame) -> DataFrame:
    """One row per column of either frame: which have it, and how many values it holds in each."""
    a, b = align(first, second)
    columns = a.columns

    def held(df: DataFrame) -> DataFrame:
        return df.agg(*[F.count(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns)])

    profile = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(c in first.columns).alias("in_first"),
            F.lit(c in second.columns).alias("in_second"),
            F.col(f"_{i}").alias("n_values"),
        )
        for i, c in enumerate(columns)
    ]
    sides = [
        held(df).select(F.inline(F.array(*profile))).withColumn("side", F.lit(side))
        for side, df in (("first", a), ("second", b))
    ]
    return (
        sides[0]
        .unionByName(sides[1])
        .groupBy("column_name", "in_first", "in_second")
        .agg(
            F.sum(F.when(F.col("side") == "first", F.col("n_values"))).alias("n_first"),
            F.sum(F.when(F.col("side") == "second", F.col("n_values"))).alias("n_second"),
        )
    )


def completeness(df: DataFrame, floor: int = PUBLISH_FLOOR) -> DataFrame:
    """One row: the number of rows, and whether it reaches the floor."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("complete", F.col("n_rows") >= floor)


def require_complete(df: DataFrame, floor: int = PUBLISH_FLOOR) -> DataFrame:
    """Raise unless the frame has ``floor`` rows; reads no more than it needs to know."""
    found = df.limit(floor).count()
    if found < floor:
        raise IncompleteData(f"{found} rows, {floor} needed to publish")
    return df
