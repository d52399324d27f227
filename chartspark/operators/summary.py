"""Grouped aggregates that can be stored and merged: what is known of some rows and of others gives what is known of all."""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: Makes a partial aggregate over rows, and the aggregate that merges stored ones of that name.
Measure = tuple[Callable[[], Column], Callable[[str], Column]]


def total(column: str) -> Measure:
    return lambda: F.sum(column), F.sum


def present(column: str) -> Measure:
    """The number of values that are not NULL."""
    return lambda: F.count(column), F.sum


def rows() -> Measure:
    return lambda: F.count(F.lit(1)), F.sum


def least(column: str) -> Measure:
    return lambda: F.min(column), F.min


def most(column: str) -> Measure:
    return lambda: F.max(column), F.max


def first(row: Column) -> Measure:
    """The row that :func:`~chartspark.operators.rank.first_row` picks: the least of least ones is the least of all."""
    return lambda: row, F.min


def spread(*columns: str) -> dict[str, Measure]:
    """Sum and number of values of each column, of which an average is made at the end."""
    return {f"{name}_{c}": make(c) for c in columns for name, make in (("sum", total), ("count", present))}


@dataclass(frozen=True)
class Summary:
    """One row per key, as wide as its measures."""

    keys: Sequence[str]
    measures: Mapping[str, Measure]

    def of(self, rows: DataFrame) -> DataFrame:
        """The summary of rows."""
        return rows.groupBy(*self.keys).agg(*[partial().alias(name) for name, (partial, _) in self.measures.items()])

    def merged(self, summaries: DataFrame) -> DataFrame:
        """The summary of all rows, from summaries of disjoint sets of them, one under another."""
        return summaries.groupBy(*self.keys).agg(*[merge(name).alias(name) for name, (_, merge) in self.measures.items()])
