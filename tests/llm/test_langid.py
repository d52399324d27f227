"""The field's sums against all labellings, and languages of held-out texts."""

import itertools
import random

import numpy as np
import pytest

from chartspark.llm import langid


def by_enumeration(scores, moves):
    """P(label at a place) from all labellings."""
    n, k = scores.shape
    total, at = 0.0, np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        weight = np.exp(sum(scores[i, x] for i, x in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
        total += weight
        for i, x in enumerate(path):
            at[i, x] += weight
    return at / total


def test_marginals_against_all_labellings():
    made = np.random.default_rng(0)
    scores, moves = made.normal(size=(2, 6, 3)), made.normal(size=(3, 3))
    found, pairs = langid.marginals(scores, moves)
    for one, expected in zip(found, scores):
        np.testing.assert_allclose(one, by_enumeration(expected, moves), atol=1e-9)
    assert pairs.sum() == pytest.approx(10)


@pytest.mark.parametrize("piece", [1, 2, 5, 128])
def test_shares_do_not_depend_on_the_pieces(monkeypatch, piece):
    monkeypatch.setattr(langid, "PIECE", piece)
    made = np.random.default_rng(1)
    moves = made.normal(size=(3, 3))
    lengths = np.array([1, 4, 7, 2, 6])
    scores = made.normal(size=(lengths.sum(), 3)) * 2
    monkeypatch.setattr(langid, "OPENING", 3)
    found, openings = langid.label_shares(scores, lengths, moves)
    for share, opening, part in zip(found, openings, np.split(scores, np.cumsum(lengths)[:-1])):
        expected = by_enumeration(part, moves)
        np.testing.assert_allclose(share, expected.mean(axis=0), atol=1e-8)
        np.testing.assert_allclose(opening, expected[: min(3, piece)].mean(axis=0), atol=1e-8)


def test_shares_of_a_very_long_text():
    made = np.random.default_rng(2)
    scores, moves = made.normal(size=(3000, 4)), np.eye(4) * 3
    found, _ = langid.label_shares(scores, np.array([3000]), moves)
    expected, _ = langid.marginals(scores[None], moves)
    np.testing.assert_allclose(found[0], expected[0].mean(axis=0), atol=1e-8)


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")


def test_held_out_texts(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.language(frame).join(frame.select("doc_id", "lang"), frame.doc_id == langid.F.col("key")).collect()
    unseen = [r for r in found if r.held_out]
    assert len(found) == frame.count() and len(unseen) > 150
    assert np.mean([r.lang == r.lang_pred for r in unseen]) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_code_switched_text_and_odd_texts(spark):
    pick = random.Random(0)
    words = {"xx": ["abra", "cada", "brak", "arba"], "yy": ["uloni", "linou", "onilu", "nuloi"]}
    rows = [(i, " ".join(pick.choices(words[x], k=30)), x, "") for i, x in enumerate(["xx", "yy"] * 40)]
    switched = " ".join(pick.choices(words["xx"], k=70) + pick.choices(words["yy"], k=30))
    odd = [(1000, switched, None, ""), (1001, None, None, ""), (1002, "", "xx", ""), (1003, "12 3.4 !? ² ½", "yy", ""),
           (None, "abra cada", "zz", ""), (1004, "arba " * 50_000, None, ""), (1004, "arba " * 50_000, None, "")]
    found = {}
    for r in langid.language(docs(spark, rows + odd)).collect():
        found.setdefault(r.key, []).append((r.lang_pred, r.score))
    assert found[1000][0][0] == "xx" and 0.6 < found[1000][0][1] < 0.8
    assert found[1001] == found[1002] == found[1003] == [("und", 0.0)]
    assert found[1004][0] == found[1004][1] and found[1004][0][0] == "xx"


def test_labels_by_the_beginning_are_learnt(spark):
    pick = random.Random(1)
    words = {"xx": ["abra", "cada", "brak", "arba"], "yy": ["uloni", "linou", "onilu", "nuloi"]}
    rows = []
    for i in range(160):
        own, other = ("xx", "yy") if i % 2 else ("yy", "xx")
        n = 20 if i % 4 > 1 else 70
        rows.append((i, " ".join(pick.choices(words[own], k=100 - n) + pick.choices(words[other], k=n)), own, ""))
    found = [r for r in langid.language(docs(spark, rows)).collect() if r.held_out]
    assert np.mean([r.lang_pred == rows[r.key][2] for r in found]) > 0.95


def test_a_language_that_is_mostly_copies_of_one_text(spark):
    """Copies do not shrink the sample of different texts: of 20,000 rows of zz 20 are not the same."""
    pick = random.Random(3)
    words = {"xx": ["abra", "cada", "brak", "arba"], "zz": ["uloni", "linou", "onilu", "nuloi"]}
    rows = [(i, " ".join(pick.choices(words["xx"], k=30)), "xx", "") for i in range(100)]
    rows += [(100 + i, " ".join(pick.choices(words["zz"], k=30)), "zz", "") for i in range(20)]
    copied = " ".join(pick.choices(words["zz"], k=30))
    rows += [(1000 + i, copied, "zz", "") for i in range(19_980)]
    frame = docs(spark, rows)
    found = langid.language(frame, field=langid.train(frame, texts_per_language=5)).collect()
    assert {r.lang_pred for r in found if r.key >= 100} == {"zz"}
    assert {r.lang_pred for r in found if r.key < 100} == {"xx"}


def test_no_language_is_left_without_words():
    for texts in (["a b c " * 30, "d"], ["d", "a b c " * 30], ["a " * 200, "b", "d"]):
        labels = np.arange(len(texts))
        words, found = langid._sequences(texts, labels)
        assert set(found.ravel()) == set(labels) and len(words) == found.size


def test_nothing_to_learn_from(spark):
    found = langid.language(docs(spark, [(1, "some text", None, ""), (2, None, "xx", "")])).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)] * 2
    assert langid.language(docs(spark, [])).count() == 0


@pytest.mark.parametrize("labels", [2, 40])
def test_shares_along_the_texts(monkeypatch, labels):
    """The way taken with many labels gives what the pieces give."""
    made = np.random.default_rng(3)
    lengths = np.array([1, 400, 7, 130, 64])
    scores, moves = made.normal(size=(lengths.sum(), labels)) * 2, made.normal(size=(labels, labels))
    monkeypatch.setattr(langid, "FEW_LABELS", 100)
    expected = langid.label_shares(scores, lengths, moves)
    monkeypatch.setattr(langid, "FEW_LABELS", 1)
    for found, wanted in zip(langid.label_shares(scores, lengths, moves), expected, strict=True):
        np.testing.assert_allclose(found, wanted, atol=1e-8)


def test_long_words_are_read_whole():
    pick = random.Random(5)
    one, other = ("a" * 30 + "".join(pick.choices("bcdefg", k=35)) + "z" * 16 for _ in range(2))
    parts = [langid.words_of(w) for w in (one, other)]
    assert all("".join(p).replace("\0", "") == w for p, w in zip(parts, (one, other), strict=True))
    assert not np.array_equal(langid.features(parts[0]), langid.features(parts[1]))
    assert (langid.features(["ab", "x" * 20])[0] >= 0).sum() == (langid.features(["ab"])[0] >= 0).sum()
    sentence = "これは空白のない長い文であり最後まで読まれる" * 20
    assert "".join(langid.words_of(sentence)).replace("\0", "") == sentence
    assert langid.words_of(langid._written(langid.words_of(f"ab {sentence} cd"))) == langid.words_of(f"ab {sentence} cd")


def test_marks_are_part_of_words():
    assert langid.words_of("हिन्दी भाषा, ที่นี่ e\u0301te\u0301 ²½ 12") == ["हिन्दी", "भाषा", "ที่นี่", "e\u0301te\u0301"]
    assert langid.words_of("\u0301 12") == []


def test_indic_and_thai_text(spark):
    """Two languages whose words differ in their vowel signs alone, and two without spaces that differ in the middle."""
    pick = random.Random(6)
    signs = {"xx": "ािी", "yy": "ेैो"}
    rows = [(i, " ".join("कखग"[pick.randrange(3)] + pick.choice(signs[x]) for _ in range(20)), x, "") for i, x in enumerate(["xx", "yy"] * 60)]
    thai = {"t1": "กขค", "t2": "งจฉ"}
    rows += [(500 + i, "ม" * 30 + "".join(pick.choices(thai[x], k=40)) + "ม" * 20, x, "") for i, x in enumerate(["t1", "t2"] * 60)]
    found = [r for r in langid.language(docs(spark, rows)).collect() if r.held_out]
    truth = {r[0]: r[2] for r in rows}
    assert len(found) > 30 and all(r.lang_pred == truth[r.key] for r in found)


def test_many_languages(spark):
    """No language is too rare to be learnt."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for i in range(300):
        word = "".join(random.Random(i).choices(letters, k=6))
        rows += [(i * 20 + k, f"{word} {word[::-1]} {word[:3]} {word}", f"l{i:03}", "") for k in range(12)]
    found = [r for r in langid.language(docs(spark, rows)).collect() if r.held_out]
    right = np.mean([r.lang_pred == f"l{r.key // 20:03}" for r in found])
    assert len({r.lang_pred for r in found}) > 250 and right > 0.9
