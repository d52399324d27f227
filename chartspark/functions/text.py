"""Measures of names, and the choice among search hits."""

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from chartspark.fixed_values import UNWANTED_KEYWORDS, WHITESPACE


def word_count(text: Column) -> Column:
    """Words between any Unicode white space, NULL for NULL; translating first is twice as fast as a regular expression."""
    spaced = F.translate(text, WHITESPACE, " " * len(WHITESPACE))
    return F.array_size(F.array_remove(F.split(spaced, " "), ""))


def is_upper(text: Column) -> Column:
    """At least one cased letter, and none in lower or title case."""
    return text.rlike(r"\p{IsUppercase}") & ~text.rlike(r"[\p{IsLowercase}\p{Lt}]")


def remove_text(text: Column, unwanted: str = "'") -> Column:
    return F.replace(text, F.lit(unwanted), F.lit(""))


def contains_any(text: Column, keywords: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(k) for k in keywords])


def first_clean(
    candidates: Column,
    name: Callable[[Column], Column] = lambda c: c["name"],
    unwanted: Sequence[str] = UNWANTED_KEYWORDS,
) -> Column:
    """The first array element whose name has no unwanted keyword, else the last one."""
    clean = F.filter(candidates, lambda c: ~F.coalesce(contains_any(name(c), unwanted), F.lit(False)))
    return F.coalesce(F.get(clean, F.lit(0)), F.try_element_at(candidates, F.lit(-1)))
