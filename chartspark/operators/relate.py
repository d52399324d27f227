"""Joins between sources.

No join carries a broadcast hint: Spark broadcasts a side only when its measured size is under the session's
threshold, and otherwise shuffles both and splits hot keys of the left side at run time. The right sides are
reduced to one row per key first, so that no key is hot on both sides.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def same_keys(keys: Sequence[str]) -> Column:
    """Key equality in which NULL equals NULL."""
    return reduce(lambda a, b: a & b, [F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`")) for k in keys])


def unseen_keys(new: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of ``new`` that ``known`` lacks. Both sides are made distinct before they meet."""
    left = new.select(*keys).distinct().alias("l")
    right = known.select(*keys).distinct().alias("r")
    return left.join(right, same_keys(keys), "left_anti")


def unseen_rows(new: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``new`` whose key ``known`` lacks."""
    right = known.select(*keys).distinct().alias("r")
    return new.alias("l").join(right, same_keys(keys), "left_anti")


def enrich(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which NULL keys meet; every right row of a key gives a row."""
    added = [c for c in right.columns if c not in keys]
    return left.alias("l").join(right.alias("r"), same_keys(keys), "left").select(
        "l.*", *[F.col(f"r.`{c}`") for c in added]
    )


LANDED = "landed_at"


def one_per_key(df: DataFrame, keys: Sequence[str], landed: str = LANDED) -> DataFrame:
    """One row per key: the one with the fewest NULLs, of these the one that landed last, of these the smallest.

    So an answer beats a failed one, and a later answer an earlier one. The time of landing is a timestamp column that
    the frame may have; it is not kept.
    """
    values = [c for c in df.columns if c not in keys and c != landed]
    missing = reduce(lambda a, b: a + b, [F.col(f"`{c}`").isNull().cast("int") for c in values], F.lit(0))
    age = F.coalesce(-F.unix_micros(landed), F.lit(2**63 - 1)) if landed in df.columns else F.lit(0)
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(missing.alias("_missing"), age.alias("_age"), F.struct(*values).alias("_row"))).alias("_best"))
        .select(*keys, *[F.col(f"_best._row.`{c}`") for c in values])
    )


def lookup(df: DataFrame, dimension: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join to a table with one row per key; an unknown key gives NULLs. The columns keep their order."""
    added = [c for c in dimension.columns if c not in df.columns]
    return df.join(dimension, on, "left").select(*df.columns, *added)
