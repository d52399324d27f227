"""The pipeline's stages one after the other, against plain versions of their decisions."""

import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from test_mixing import expected as mixed_rows
from test_simhash import groups, plain_fingerprint

from chartspark.llm import mixing, toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What each stage keeps."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out[name] = docs
    return out


def test_columns(spark, kept):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, docs in list(kept.items())[:-1]:
        assert docs.dtypes == documents.dtypes


def test_toxicity(spark, kept):
    documents, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(documents, labels)
    rows = documents.collect()
    scores = model.scorer()([r.text or "" for r in rows])
    assert sorted(r.doc_id for r, s in zip(rows, scores) if s < 0.7) == sorted(r.doc_id for r in kept["toxicity"].collect())


def test_copies(kept):
    groups_ = defaultdict(list)
    for r in kept["toxicity"].collect():
        groups_[re.sub("[\x20\x09-\x0d]", "", r.text or "")].append((-len(r.text or ""), r.doc_id))
    assert sorted(min(g)[1] for g in groups_.values()) == sorted(r.doc_id for r in kept["exact_dedup"].collect())


def test_near_copies(kept):
    rows = sorted(kept["exact_dedup"].collect())
    root = groups([plain_fingerprint(r.text or "") for r in rows], 4)
    least = {}
    for r, g in zip(rows, root):
        least[g] = min(least.get(g, r.doc_id), r.doc_id)
    assert sorted(least.values()) == sorted(r.doc_id for r in kept["simhash"].collect())


def test_mixing(kept):
    rows = [(r.doc_id, r.source, r.text) for r in kept["simhash"].collect()]
    facts = mixing.facts_of(kept["simhash"], "doc_id", "source", "text", "mix")
    exponent, drawn = mixing.temperature(facts.groupBy("name").agg({"tokens": "sum"}).toDF("name", "tokens"), 2.0)
    times = Counter(r.doc_id for r in kept["mixing"].collect())
    assert times == Counter(r[0] for r in mixed_rows(rows, exponent, drawn))
    assert set(times) == {r[0] for r in rows}


def test_packing(kept):
    drawn = Counter(r.doc_id for r in kept["mixing"].collect())
    packed = kept["packing"].collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == drawn
    sequences = defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-sum(r.length for r in packed) // 2048) + 2


def test_run(spark, kept):
    def rows(df):
        return Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())

    assert rows(corpus_pipeline.run(spark, FOLDER)) == rows(kept["packing"])


def test_odd_rows_and_no_documents(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "some text", None, "s", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, docs in (("odd", rows), ("none", [])):
        docs = spark.createDataFrame(docs, schema)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs.write.parquet(str(tmp_path / f"{name}{k}"))
            docs = stage(spark, spark.read.parquet(str(tmp_path / f"{name}{k}")), FOLDER)
        assert {r.doc_id for r in docs.collect()} == ({1, 2} if name == "odd" else set())


@pytest.mark.parametrize("stage", [corpus_pipeline.drop_copies, corpus_pipeline.drop_near_copies])
def test_files_are_split_in_another_way_later(spark, tmp_path, other_splits, stage):
    """The rows that go are those that were found to be copies, however the second read is split."""
    texts = [" ".join(random.Random(i // 2).choices(["red", "oak", "fish", "sun", "hill", "rope"], k=60)) for i in range(160)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartitionByRange(16, "doc_id").write.parquet(str(tmp_path / "docs"))
    kept = stage(spark, spark.read.parquet(str(tmp_path / "docs")), FOLDER)
    other_splits()
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 160, 2))


def test_rows_of_a_stored_table_are_numbered_without_writing_them(spark, tmp_path, other_splits):
    from chartspark.llm.common import stored_rows

    path = str(tmp_path / "docs")
    spark.range(500).selectExpr("id AS doc_id", "repeat('x', 100) AS _ROW").repartition(4).write.parquet(path)
    table = spark.read.parquet(path)
    numbered, row = stored_rows(table)
    assert row == "_row_" and numbered.columns == [*table.columns, row]
    assert "_metadata" in numbered._jdf.queryExecution().analyzed().toString() or numbered.inputFiles() == table.inputFiles()
    found = {r.doc_id: r[row] for r in numbered.collect()}
    assert len(set(found.values())) == 500 and min(found.values()) >= 0
    other_splits()
    assert {r.doc_id: r[row] for r in stored_rows(spark.read.parquet(path))[0].collect()} == found
    changed, row = stored_rows(table.filter("doc_id < 100"))
    assert changed.inputFiles() != table.inputFiles() and len({r[row] for r in changed.collect()}) == 100
