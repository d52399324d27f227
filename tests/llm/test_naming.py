"""Exact deduplication against a plain version."""

import hashlib
import random
import re

import pytest

from chartspark.llm import naming

SCHEMA = "doc_id long, text string, name string, pos int, part string"


def expected(rows):
    groups = {}
    for place, (key, text, *_) in enumerate(rows):
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", text or ""), []).append((place, key, text or ""))
    out = []
    for squeezed, members in groups.items():
        best = min(members, key=lambda m: (-len(m[2]), m[1] is None, m[1] or 0, m[0]))
        sha = hashlib.sha256(squeezed.encode()).hexdigest()
        out += [(key, best[1], len(members), place == best[0], sha) for place, key, _ in members]
    return sorted(out, key=repr)


def found(docs, **options):
    rows = naming.exact_dedup(docs, **options).collect()
    return sorted(((r.key, r.keep_key, r.group_size, r.kept, r.text_sha256) for r in rows), key=repr)


def stored(spark, tmp_path, rows):
    path = str(tmp_path / "docs")
    spark.createDataFrame([(k, t, "clash", 1, "x") for k, t in rows], SCHEMA).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def test_against_a_plain_version(spark, tmp_path):
    pick = random.Random(1)
    bases = ["".join(pick.choices("ab é\n", k=n)) for n in (0, 1, 3, 7, 8, 9, 30, 64, 65, 200) for _ in range(3)]
    rows = []
    for i in range(300):
        text = pick.choice(bases)
        if pick.random() < 0.5:
            text = text.replace("a", "a ", pick.randrange(3))
        rows.append((pick.choice([None, pick.randrange(200)]), pick.choice([None, text, text, text])))
    assert found(stored(spark, tmp_path, rows), block_bytes=8) == expected(rows)


def test_ties_and_repeated_rows(spark, tmp_path):
    rows = [(5, "a b"), (3, "ab"), (4, "ab "), (4, "ab "), (None, "a b"), (7, None), (8, " \t"), (9, "")]
    assert found(stored(spark, tmp_path, rows)) == expected(rows)
    assert sum(r[3] for r in found(stored(spark, tmp_path / "again", rows))) == 2


def test_texts_that_share_all_but_one_block(spark, tmp_path):
    long = "x" * 100
    rows = [(1, long), (2, long + "y"), (3, "y" + long), (4, long[:-1] + "y"), (5, long), (6, long[:96]), (7, long[:48] * 2)]
    assert found(stored(spark, tmp_path, rows), block_bytes=8) == expected(rows)


def test_a_hot_text_and_a_very_long_one(spark, tmp_path):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(900)] + [(1000, "word " * 200_000), (1001, "word" * 200_000)]
    assert found(stored(spark, tmp_path, rows)) == expected(rows)


def test_no_documents(spark, tmp_path):
    assert found(stored(spark, tmp_path, [])) == []


@pytest.mark.parametrize("salts", [1, 3])
def test_names_do_not_depend_on_the_deal(spark, salts):
    rows = spark.createDataFrame([(i, i % 7, "k") for i in range(50)], "occ long, content int, other string")
    named = naming.name_contents(rows, ["content"], salts).collect()
    assert sorted(r.name for r in named) == sorted(i % 7 for i in range(50))
