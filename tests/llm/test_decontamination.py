"""Passages of a benchmark in documents, against their definition."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from chartspark.llm import decontamination as module
from chartspark.llm.decontamination import Block, contamination, decontaminated, longest_matches, suffix_array, words_of


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffixes_are_in_order(symbols):
    symbols = np.array([*symbols, 0])

    def suffix(i):
        return symbols[i : i + np.flatnonzero(symbols[i:] == 0)[0]].tolist()

    array = suffix_array(symbols).tolist()
    assert sorted(array) == np.flatnonzero(symbols).tolist()
    assert [suffix(i) for i in array] == sorted(suffix(i) for i in array)


@pytest.mark.parametrize("symbols", [[1] * 20_000, [1, 2] * 9_000, [1] * 5_000 + [0] + [1] * 5_000])
def test_long_repeats(symbols):
    array = suffix_array(np.array([*symbols, 0]))
    assert len(array) == np.count_nonzero(symbols)


def test_words():
    assert [w.decode() for w in words_of("Ab- c1É^x`y{z~ü\x7fa\x00B".encode())] == ["ab", "c1É", "x", "y", "z", "ü", "a", "b"]
    assert words_of(None) == words_of(b"") == words_of(b" .,\n") == []


def plain(docs, items, window=10):
    """Every window of every item at every place of every document."""
    out = []
    for key, text in docs:
        words = words_of(text and text.encode())
        hit, names = set(), set()
        for name, item in items:
            passage = words_of(item and item.encode())
            n = min(window, len(passage))
            for i in range(len(passage) - n + 1 if passage else 0):
                for j in range(len(words) - n + 1):
                    if words[j : j + n] == passage[i : i + n]:
                        hit |= set(range(j, j + n))
                        names.add(name)
        out.append((key, len(words), sorted(hit), sorted(str(x) for x in names - {None})))
    return sorted(out, key=repr)


def found(frame):
    rows = []
    for r in frame.collect():
        places = sorted({p for s in r["spans"] for p in range(s["start"], s["end"])})
        rows.append((r["key"], r["n_words"], places, r["items"]))
    return sorted(rows, key=repr)


def stored(spark, tmp_path, rows, schema, name):
    path = str(tmp_path / name)
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def cases(seed):
    pick = random.Random(seed)
    words = ["a", "B", "c", "é", "7", "long" * 50]

    def text(n):
        return "".join(pick.choice(words) + pick.choice([" ", ", ", "\n", "-"]) for _ in range(n))

    items = [(pick.choice([None, i, i // 2]), text(pick.choice([0, 1, 2, 3, 5, 9]))) for i in range(14)] + [(77, None), (78, " . ")]
    docs = [(pick.choice([None, i, i // 2]), text(pick.randrange(30))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, " .. "), (103, docs[0][1]), (103, docs[0][1])]
    docs.append((104, " x ".join(t or "" for _, t in items) * 3))
    return docs, items


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("options", [{}, {"shard": 20}, {"block_bytes": 40, "shard": 50}])
def test_against_every_place(spark, tmp_path, seed, options):
    docs, items = cases(seed)
    # clashing names: the columns that the operator makes for itself
    table = stored(spark, tmp_path, [(*d, 1, "s", 2) for d in docs], "doc_id long, text string, row int, spans string, n_words int", "docs")
    questions = stored(spark, tmp_path, items, "item_id long, text string", "items")
    got = contamination(table, questions, window=4, **options)
    assert found(got) == plain(docs, items, 4)
    covered = got.select(module.n_covered(got["spans"]).alias("n"), "spans").collect()
    assert all(r.n == len({p for s in r.spans for p in range(s.start, s.end)}) for r in covered)


def test_affected_documents_go(spark, tmp_path):
    docs, items = cases(9)
    table = stored(spark, tmp_path, [(*d, "x") for d in docs], "doc_id long, Text string, _row string", "docs")
    questions = stored(spark, tmp_path, items, "item_id long, text string", "items")
    kept = decontaminated(table, questions, window=4)
    assert kept.columns == table.columns
    clean = [r for r in plain([(i, t) for i, (_, t) in enumerate(docs)], items, 4) if not r[2]]
    assert sorted(kept.toPandas()["doc_id"].fillna(-1)) == sorted(docs[i][0] if docs[i][0] is not None else -1 for i, *_ in clean)


def test_longest_matches(spark, tmp_path):
    docs, items = cases(4)
    items = [(i, t) for i, (_, t) in enumerate(items)]
    table = stored(spark, tmp_path, docs, "doc_id long, text string", "docs")
    questions = stored(spark, tmp_path, items, "item_id long, text string", "items")
    got = {(r.item, r.start): r for r in longest_matches(table, questions, shard=40, block_bytes=60).collect()}
    texts = [words_of(t and t.encode()) for _, t in docs]
    for name, item in items:
        words = words_of(item and item.encode())
        for start in range(len(words)):
            best = max(
                (n for t in texts for j in range(len(t)) for n in range(1, len(words) - start + 1) if t[j : j + n] == words[start : start + n]),
                default=0,
            )
            r = got.pop((str(name), start), None)
            assert (r.length if r else 0) == best
            if r:
                same = [t for (k, _), t in zip(docs, texts, strict=True) if k == r.key]
                assert words[start : start + best] in [t[r.place : r.place + best] for t in same]
    assert not got


def test_nothing(spark, tmp_path):
    empty = stored(spark, tmp_path, [], "doc_id long, text string", "docs")
    none = stored(spark, tmp_path, [], "item_id long, text string", "items")
    some = stored(spark, tmp_path, [(1, "a b c")], "doc_id long, text string", "some")
    assert contamination(empty, none).collect() == [] and longest_matches(empty, none).collect() == []
    assert [(r.n_words, r.spans, r["items"]) for r in contamination(some, none).collect()] == [(3, [], [])]
    assert contamination(empty, some.withColumnRenamed("doc_id", "item_id")).collect() == []


def test_equal_windows_are_one_class():
    block = Block([("1", b"a b c a b c"), ("2", b"b c a"), ("3", b"")], 3)
    assert block.ids == ["1", "2"] and len(block.classes) == 3
    assert sorted(map(sorted, block.classes)) == [[0], [0], [0, 1]]
