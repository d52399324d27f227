"""The classifiers of toxicity and quality."""

import random

import numpy as np
import pytest

from chartspark.llm import learning, quality, toxicity

FOLDER = "/root/testdata/sf0.1"


def tables(spark, texts, labels):
    docs = spark.createDataFrame([(k, t, "x", 0.5) for k, t in texts], "doc_id long, text string, lang string, score double")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    return docs, marks


def made(seed=0, n=600):
    """Toxic texts have some words of their own, bad ones are full of signs."""
    pick = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = ["".join(pick.choices(["ka", "lo", "mi", "re", "tu", "san", "po"], k=pick.randrange(1, 5))) for _ in range(60)]
        toxic, good = int(pick.random() < 0.3), int(pick.random() < 0.7)
        if toxic:
            for at in pick.sample(range(60), 6):
                words[at] = pick.choice(["vrexil", "zounder", "quibbeg"])
        if not good:
            words = [w + "###" for w in words]
        texts.append((i, " ".join(words)))
        labels.append((i, toxic, good))
    return texts, labels


@pytest.mark.parametrize("name", ["toxic", "quality"])
def test_held_out_accuracy(spark, name):
    texts, labels = made()
    docs, marks = tables(spark, texts, labels)
    scored = (toxicity.toxicity if name == "toxic" else quality.quality)(docs, marks)
    truth = {k: (t if name == "toxic" else q) for k, t, q in labels}
    unseen = [r for r in scored.collect() if r.held_out]
    assert len(unseen) > 150
    assert np.mean([r.predicted == truth[r.key] for r in unseen]) > 0.97


def test_given_documents(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.quality(docs, labels).join(labels, labels.doc_id == learning.F.col("key")).filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in found]) > 0.97
    found = toxicity.toxicity(docs, labels).join(labels, labels.doc_id == learning.F.col("key")).filter("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in found]) > 0.94
    assert np.mean([r.predicted for r in found if not r.toxic]) < 0.01


@pytest.mark.parametrize("module", [toxicity, quality])
def test_odd_rows(spark, module):
    texts, labels = made(1, 200)
    odd = [(None, None), (5000, None), (5001, ""), (5002, " \n"), (5003, "1"), (5003, "1"), (5004, "mi ka " * 60_000)]
    docs, marks = tables(spark, texts + odd, labels + [(None, 1, 1), (5001, None, None), (3, 1, 1), (777_777, 1, 0)])
    score = toxicity.toxicity if module is toxicity else quality.quality
    rows = score(docs, marks).collect()
    assert len(rows) == len(texts) + len(odd)
    assert all(0 <= r.score <= 1 and r.held_out is not None and r.predicted in (0, 1) for r in rows)
    found = {}
    for r in rows:
        found.setdefault(r.key, []).append(r.score)
    assert found[5003][0] == found[5003][1] and found[5000] == found[5001]
    assert score(docs.limit(0), marks).count() == 0


@pytest.mark.parametrize("module,empty", [(toxicity, 0.0), (quality, 0.5)])
def test_without_usable_labels(spark, module, empty):
    score = toxicity.toxicity if module is toxicity else quality.quality
    docs, marks = tables(spark, [(i, f"text {i}") for i in range(20)], [(i, 1, 1) for i in range(20)])
    assert {r.score for r in score(docs, marks).collect()} == {1.0}
    assert {r.score for r in score(docs, marks.limit(0)).collect()} == {empty}


def test_scores_come_from_the_text_alone(spark):
    texts, labels = made(2, 150)
    docs, marks = tables(spark, texts, labels)
    model = toxicity.train(docs, marks)
    first = {r.key: r.score for r in toxicity.toxicity(docs, marks, model=model).collect()}
    moved = docs.withColumn("doc_id", learning.F.col("doc_id") + 10_000)
    assert {r.key - 10_000: r.score for r in toxicity.toxicity(moved, marks, model=model).collect()} == first


def test_rows_are_kept_with_their_columns(spark):
    texts, labels = made(2, 150)
    docs, marks = tables(spark, texts + [(None, None), (900, "")], labels)
    model = toxicity.train(docs, marks)
    kept = toxicity.ordinary_rows(docs, model)
    assert kept.dtypes == docs.dtypes
    expected = {r.key for r in toxicity.toxicity(docs, marks, model=model).collect() if not r.predicted}
    assert {r.doc_id for r in kept.collect()} == expected and {None, 900} <= expected
    assert toxicity.ordinary_rows(docs.limit(0), model).count() == 0


def test_copies_do_not_shrink_the_sample(spark):
    """Of 4100 texts of a class 4000 are one text; the 100 others make up the sample all the same."""
    texts = [(i, f"rare {i}" if i < 150 else "copy") for i in range(4150)] + [(5000 + i, f"plain {i}") for i in range(300)]
    texts += [(7, "a second text of a key")]
    docs, marks = tables(spark, texts, [(i, int(i < 5000), 0) for i in sorted({k for k, _ in texts})])
    marked = learning.marks(marks, "toxic", "doc_id")
    unseen = {r.doc_id for r in docs.filter(learning.held_out(learning.F.col("doc_id"))).collect()}
    every = {(int(k < 5000), t) for k, t in texts if k not in unseen}
    found = [(r.y, r.text) for r in learning.sample(docs, marked, per_class=400, key="doc_id", text="text").collect()]
    assert sorted(found) == sorted(every)
    some = [r.y for r in learning.sample(docs, marked, per_class=50, key="doc_id", text="text").collect()]
    assert 25 < some.count(1) < 80 and 25 < some.count(0) < 80


def test_toxic_texts_are_found_beside_a_group_of_copies(spark):
    texts, labels = made(4, 400)
    texts += [(10_000 + i, "mi ka lo vrexil re tu") for i in range(20_000)]
    docs, marks = tables(spark, texts, labels + [(10_000 + i, 1, 0) for i in range(20_000)])
    model = toxicity.train(docs, marks, texts_per_class=200)
    truth = {k: t for k, t, _ in labels}
    unseen = [r for r in toxicity.toxicity(docs, marks, model=model).collect() if r.held_out and r.key < 10_000]
    assert np.mean([r.predicted for r in unseen if truth[r.key]]) > 0.9


def test_dual_coordinate_descent_reaches_the_optimum():
    """No multiplier can be moved to a better value on its own."""
    made_ = np.random.default_rng(0)
    rows = [np.sort(made_.choice(30, size=made_.integers(1, 12), replace=False)) for _ in range(80)]
    ratios = made_.normal(size=30)
    y = np.array([int(ratios[r].sum() + made_.normal() > 0) for r in rows])
    w = quality.fit(rows, y, ratios, np.full(80, 1.0))
    x = np.zeros((80, 31))
    for i, r in enumerate(rows):
        x[i, r], x[i, -1] = quality._scaled(r, ratios), 1
    sign = np.where(y > 0, 1, -1)

    def loss(v):
        return v @ v / 2 + np.maximum(0, 1 - sign * (x @ v)).sum()

    for _ in range(300):
        assert loss(w) <= loss(w + made_.normal(size=31) * 0.02) + 2e-2


def test_repetition_is_seen():
    once = quality.grams("one two three four five six seven")
    again = quality.grams("one one one one one one one")
    assert not (once < len(quality.REPEATS)).any() and (again < len(quality.REPEATS)).sum() >= 8
    assert len(quality.grams("")) == 0


def test_windows_save_bytes_where_the_text_is_toxic():
    compressors = toxicity.Compressors(b"some ordinary text that is here " * 20, b" vrexil  zounder ")
    assert max(compressors.saved("xy vrexil and zounder jq")) >= 3
    assert max(compressors.saved("xy and jq pw mn")) <= 1
    assert compressors.saved("") == [0]


def test_both_dictionaries_are_zstandards_own(spark):
    docs, marks = tables(spark, *made(2, 1500))
    model = toxicity.train(docs, marks)
    for content in (model.ordinary, model.toxic):
        assert content[:4] == bytes.fromhex("37a430ec") and toxicity.zstandard.ZstdCompressionDict(content).dict_id()
    assert any(word in model.toxic for word in (b"vrexil", b"zounder", b"quibbeg"))


def test_score_by_compressing_window_after_window(spark):
    """The score from its definition: every window compressed alone with either dictionary."""
    texts, labels = made(4, 900)
    docs, marks = tables(spark, texts, labels)
    model = toxicity.train(docs, marks)

    def length(window, content):
        raw = toxicity.zstandard.ZstdCompressionDict(content + toxicity.TAIL, dict_type=toxicity.zstandard.DICT_TYPE_RAWCONTENT)
        options = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
        return len(toxicity.zstandard.ZstdCompressor(level=toxicity.LEVEL, dict_data=raw, **options).compress(window + toxicity.TAIL))

    scored = {r.key: r.score for r in toxicity.toxicity(docs, marks, model=model).collect()}
    for key, text in texts[:40]:
        data, saved, at = text.lower().encode(), [], 0
        while at == 0 or at < len(data) - toxicity.WINDOW + toxicity.STEP:
            window = data[at : at + toxicity.WINDOW]
            saved.append(length(window, model.ordinary) - length(window, model.toxic + model.ordinary))
            at += toxicity.STEP
        best = sorted((x for x in saved if x > 0), reverse=True)[:4]
        x = best + [0] * (4 - len(best)) + [np.log1p(sum(s >= n for s in saved)) for n in (2, 3, 4)] + [np.log1p(len(saved))]
        assert scored[key] == pytest.approx(float(model.curve(np.array([x], float))[0]), abs=1e-9)


def test_the_text_column_is_found_as_spark_finds_it(spark):
    texts, labels = made(3, 400)
    docs, marks = tables(spark, texts, labels)
    model = toxicity.train(docs, marks)
    other = docs.selectExpr("doc_id", "text AS TEXT", "'nothing of interest' AS last")
    kept = {r.doc_id for r in toxicity.ordinary_rows(docs, model).collect()}
    assert {r.doc_id for r in toxicity.ordinary_rows(other, model).collect()} == kept and len(kept) < len(texts)
    with pytest.raises(Exception):
        toxicity.ordinary_rows(docs.drop("text"), model)
