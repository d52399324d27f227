"""Lists of keywords as one pattern each: what is looked for is data, and an expression is as large for many as for few."""

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Rules that a table of them may have; they are part of the plan and sent with it.
MOST_RULES = 100_000


def alternation(keywords: Sequence[str]) -> str:
    """A pattern that matches exactly the keywords. Common beginnings are written once, so that at a place of a text only
    those are tried that begin as it goes on."""
    tree: dict = {}
    for word in keywords:
        node = tree
        for character in word:
            node = node.setdefault(character, {})
        node[""] = {}

    # from the leaves up, without recursion: a keyword may be long
    written: dict[int, str] = {}
    stack = [(tree, False)]
    while stack:
        node, seen = stack.pop()
        if not seen:
            stack.append((node, True))
            stack.extend((child, False) for key, child in node.items() if key)
            continue
        branches = [_quoted(key) + written[id(child)] for key, child in sorted(node.items()) if key]
        if "" in node:
            branches.append("")
        written[id(node)] = branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})" if branches else ""
    return written[id(tree)]


def _quoted(character: str) -> str:
    return "\\" + character if re.match(r"[\\^$.|?*+()\[\]{}]", character) else character


def holds_one(text: Column, keywords: Sequence[str]) -> Column:
    """Does the text contain a keyword? Case matters."""
    return text.rlike(alternation(keywords)) if keywords else text.isNull() & F.lit(False)


def is_one(text: Column, keywords: Sequence[str]) -> Column:
    """Is the text a keyword?"""
    return text.rlike(rf"\A(?:{alternation(keywords)})\z") if keywords else text.isNull() & F.lit(False)


def rules_of(table: DataFrame, label: str = "label", keyword: str = "keyword", order: str = "place") -> list[tuple[str, list[str]]]:
    """Rules from a table with a row for each keyword: the labels in the order of their first keyword.

    Raises ValueError if there are more than ``MOST_RULES``; rows without a label or keyword are left out.
    """
    rows = table.select(label, keyword, order).dropna(subset=[label, keyword]).limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} keywords")
    rules: dict[str, list[str]] = {}
    for name, word, _ in sorted(rows, key=lambda r: (r[2] is None, r[2] if r[2] is not None else 0, r[0], r[1])):
        rules.setdefault(name, []).append(word)
    return list(rules.items())
