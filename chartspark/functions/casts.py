"""Lenient casts: a value that does not fit becomes NULL, also under ANSI mode."""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def to_integer(column: Column, kind: str = "int", from_text: bool = False) -> Column:
    """Cast to a whole number; text such as ``'3.7'`` is cut to 3."""
    if not from_text:
        return column.try_cast(kind)
    return F.coalesce(column.try_cast(kind), column.try_cast("double").try_cast(kind))


def to_partial_date(column: Column) -> Column:
    """Read ``yyyy``, ``yyyy-MM`` or ``yyyy-MM-dd`` as a date, missing parts being the first."""
    text = column.cast("string")
    padded = (
        F.when(F.length(text) == 4, F.concat(text, F.lit("-01-01")))
        .when(F.length(text) == 7, F.concat(text, F.lit("-01")))
        .otherwise(text)
    )
    return F.when(padded.rlike(r"^\d{4}-\d{2}-\d{2}\z"), padded.try_cast("date"))


def cast_columns(
    df: DataFrame,
    numerical: list[str] = (),
    integer: list[str] = (),
    boolean: list[str] = (),
    date: str | None = None,
) -> DataFrame:
    """Cast columns by list, in one projection."""
    casts = {name: F.col(name).try_cast("double") for name in numerical}
    for name in integer:
        casts[name] = to_integer(F.col(name), from_text=isinstance(df.schema[name].dataType, T.StringType))
    casts.update({name: F.col(name).try_cast("boolean") for name in boolean})
    if date is not None:
        casts[date] = to_partial_date(F.col(date))
    return df.withColumns(casts)
