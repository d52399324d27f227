"""Exact top-k against all scores."""

import math
import random

import pytest
from pyspark.sql import functions as F

from chartspark.llm import topk

SCHEMA = "vec_id long, embedding array<double>, rank int, score long"


def expected(rows, divisor=5, k=5, scale=256):
    usable = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in usable:
        if i is None or i % divisor:
            continue
        scored = [(sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out += [(i, n + 1, j, s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def found(spark, rows, divisor=5, **options):
    frame = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], SCHEMA).repartition(4)
    result = topk.top_k(frame, F.col("key") % divisor == 0, **options).collect()
    return sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in result), key=repr)


def vectors(seed, n=200, size=6):
    pick = random.Random(seed)
    return [(i, [round(pick.uniform(-1, 1), 3) for _ in range(size)]) for i in range(n)]


@pytest.mark.parametrize("queries", [3, 8192])
def test_against_all_scores(spark, monkeypatch, queries):
    monkeypatch.setattr(topk, "QUERIES", queries)
    rows = vectors(1)
    assert found(spark, rows) == expected(rows)


def test_ties_copies_and_missing_values(spark):
    same = [(i, [0.5, -0.25, 1.0]) for i in range(60)]
    odd = [(100, None), (105, []), (110, [1.0, None, 2.0]), (115, [float("nan"), 1.0, 1.0]), (120, [float("inf"), 0.0, 0.0]),
           (None, [0.5, -0.25, 1.0]), (None, None), (125, [0.0, 0.0, 0.0])]
    rows = same + odd
    assert found(spark, rows) == expected(rows)


def test_fewer_candidates_than_asked_for(spark):
    rows = vectors(2, 4)
    assert found(spark, rows) == expected(rows)
    assert found(spark, rows[:1]) == []
    assert found(spark, []) == []


def test_unlike_lengths(spark):
    rows = vectors(3, 30, 4) + [(i + 30, v) for i, v in vectors(4, 30, 7)]
    assert found(spark, rows) == expected(rows)


def test_large_components_lose_nothing(spark):
    rows = [(i, [x * 1e6, x * -3e5, 2.0**22 + i]) for i, (x,) in vectors(5, 40, 1)]
    assert found(spark, rows) == expected(rows)


def test_scores_beyond_a_long_stay_at_its_end(spark):
    rows = [(0, [1e200, 1.0]), (1, [1e200, 1.0]), (2, [-1e200, 1.0]), (3, [0.0, 1.0])]
    scores = {(q, j): s for q, _, j, s in found(spark, rows)}
    assert scores[0, 1] == 2**63 - 1 and scores[0, 2] == -(2**63) and scores[0, 3] == 256 * 256


def test_rounds_of_histograms(spark, monkeypatch):
    monkeypatch.setattr(topk, "BINS", 4)
    monkeypatch.setattr(topk, "SCORES", 64)
    rows = vectors(6, 120, 3)
    assert found(spark, rows) == expected(rows)
