"""Mixing against a plain version."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from chartspark.llm import mixing


def docs(spark, tmp_path, rows):
    path = str(tmp_path / "docs")
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, source string, text string, name string, block int")
    frame.coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def some_rows(seed=3):
    pick = random.Random(seed)
    rows = []
    for i in range(800):
        source = pick.choices(["a", "b", "c", None, ""], [60, 20, 10, 6, 4])[0]
        text = pick.choice([None, "", "w " * pick.randrange(1, 40), "long\ttext " * 30])
        rows.append((pick.choice([None, i, i, i, i // 3]), source, text))
    return rows + [(9000, "empty", ""), (9001, "empty", None)]


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def expected(rows, exponent, drawn):
    facts, totals, blocks = [], Counter(), Counter()
    for key, source, text in rows:
        name = "" if source is None else "=" + source
        block = md5(f"mix|{'' if key is None else key}")[:3]
        n = len(re.findall("[^\x20\x09-\x0d]+", text or ""))
        facts.append((key, source, name, block, n))
        totals[name] += n
        blocks[name, block] += n
    z = sum(t**exponent for t in totals.values() if t)
    plan = defaultdict(list)
    for name, total in totals.items():
        repeats = total ** (exponent - 1) * drawn / z if total else 1.0
        whole = math.floor(repeats + 1e-9)
        rest = max(math.floor((repeats - whole) * total), 0)
        own = [b for n, b in blocks if n == name]
        for p in range(whole + 1):
            upto = 0
            for b in sorted(own, key=lambda b: (md5(f"mix|{name}|{p}|{b}"), b)):
                upto += blocks[name, b]
                if p < whole or (rest and upto <= rest):
                    plan[name, b].append((p, p * total + upto - blocks[name, b]))
    return sorted(((k, s, n, p, b, at) for k, s, name, b, n in facts for p, at in plan[name, b]), key=repr)


def found(frame, **options):
    return sorted(((r.key, r.source, r.tokens, r["pass"], r.block, r.place) for r in mixing.mix(frame, **options).collect()), key=repr)


def totals_of(spark, tokens):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(tokens)], "name string, tokens long")


def test_draws_against_a_plain_version(spark, tmp_path):
    rows = some_rows()
    frame = docs(spark, tmp_path, rows)
    facts = mixing.facts_of(frame, "doc_id", "source", "text", "mix")
    exponent, drawn = mixing.temperature(facts.groupBy("name").agg({"tokens": "sum"}).toDF("name", "tokens"), 2.0)
    assert found(frame) == expected(rows, exponent, drawn)


def test_every_document_is_drawn_and_none_too_often(spark, tmp_path):
    rows = some_rows()
    times = Counter(r.row for r in mixing.mix(docs(spark, tmp_path, rows)).collect())
    assert len(times) == len(rows) and max(times.values()) <= 2


def test_limit_on_repetition(spark):
    exponent, drawn = mixing.temperature(totals_of(spark, [1000, 100, 10]), 3.0)
    # 1 - exponent is ln 3 over ln of the ratio of the largest to the smallest
    assert exponent == pytest.approx(1 - math.log(3) / math.log(100), abs=2e-6)
    weights = [t**exponent for t in (1000, 100, 10)]
    shares = [w / sum(weights) * drawn / t for w, t in zip(weights, (1000, 100, 10))]
    assert shares[0] == pytest.approx(1) and max(shares) <= 3 and max(shares) == pytest.approx(3, abs=1e-3)


def test_entropy(spark):
    exponent, _ = mixing.temperature(totals_of(spark, [800, 150, 50]), entropy=0.9)
    p = [t**exponent for t in (0.8, 0.15, 0.05)]
    p = [x / sum(p) for x in p]
    assert -sum(x * math.log(x) for x in p) == pytest.approx(0.9, abs=1e-5)
    assert mixing.temperature(totals_of(spark, [800, 150, 50]), entropy=5.0)[0] == 0.0
    assert mixing.temperature(totals_of(spark, [800, 150, 50]), entropy=0.01)[0] == 1.0


def test_budget(spark, tmp_path):
    rows = some_rows()
    frame = docs(spark, tmp_path, rows)
    drawn = mixing.mix(frame, max_repeats=None, entropy=1.2, budget=4000)
    total = drawn.agg({"tokens": "sum"}).first()[0]
    assert 4000 * 0.9 < total <= 4000 + 10  # short by less than a block a source


def test_one_source_and_none(spark, tmp_path):
    rows = [(i, "only", "a b c") for i in range(20)]
    assert len(found(docs(spark, tmp_path, rows))) == 20
    assert found(docs(spark, tmp_path / "none", [])) == []
    assert len(found(docs(spark, tmp_path / "empty", [(1, None, None), (2, "x", "")]))) == 2


def test_documents_keep_their_columns(spark, tmp_path):
    rows = some_rows()
    frame = docs(spark, tmp_path, rows)
    mixed = mixing.mixed_documents(frame)
    assert mixed.dtypes == frame.dtypes
    assert sorted(r.doc_id or -1 for r in mixed.collect()) == sorted(r[0] or -1 for r in found(frame))
