"""Ordered-rule classifiers over an array of tags.

The outer order is the array's: the first tag that meets any rule decides, and for that tag the first rule.
"""

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from chartspark.fixed_values import DEFAULT_GENRE, GENRE_RULES, GENRE_TAGS_READ, TAG_RULES
from chartspark.functions.rules import holds_one, is_one

Rules = Sequence[tuple[str, Sequence[str]]]


def _first_label(tags: Column, rules: Rules, test: Callable, default: str | None) -> Column:
    def label(tag: Column) -> Column:
        (first, keywords), *others = rules
        return reduce(
            lambda case, rule: case.when(test(tag, rule[1]), rule[0]),
            others,
            F.when(test(tag, keywords), first),
        )

    labels = F.filter(F.transform(tags, label), lambda found: found.isNotNull())
    return F.coalesce(F.get(labels, F.lit(0)), F.lit(default))


def keyword_genre(
    tags: Column,
    rules: Rules = GENRE_RULES,
    read: int | None = GENRE_TAGS_READ,
    default: str | None = DEFAULT_GENRE,
) -> Column:
    """Genre of the first tag (of the first ``read``) that contains a keyword; case matters.

    A rule's keywords are one pattern, so the expression grows with the rules and not with the keywords.
    """
    if read is not None:
        tags = F.slice(tags, 1, read)
    return _first_label(tags, rules, holds_one, default)


def tag_genre(tags: Column, rules: Rules = TAG_RULES, default: str | None = DEFAULT_GENRE) -> Column:
    """Genre of the first tag that equals a listed one."""
    return _first_label(tags, rules, is_one, default)
