import pytest

from chartspark.operators.quality import IncompleteData
from chartspark.sources import documents, storage
from chartspark.streaming.index import index_stream
from chartspark.streaming.ingest import append_stream

SCHEMA = "city string, n int"


def test_each_row_is_appended_once(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "log"))

    def land(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(source)

    def ingest():
        query = append_stream(spark, source, SCHEMA, sink, checkpoint, source_format="json", files_per_trigger=1)
        query.awaitTermination()
        return query

    land([("Oslo", 1), ("Lima", 2)])
    land([("Hanoi", 3)])
    ingest()
    assert storage.read_table(spark, sink).count() == 3
    ingest()
    assert storage.read_table(spark, sink).count() == 3
    land([("Nairobi", 4)])
    ingest()
    rows = storage.read_table(spark, sink).collect()
    assert sorted((r.city, r.n) for r in rows) == [("Hanoi", 3), ("Lima", 2), ("Nairobi", 4), ("Oslo", 1)]
    assert len({r.ingested_at for r in rows}) == 3


def test_a_batch_that_is_run_again_is_indexed_once(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "docs", "log"))

    def land(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(source)

    def index():
        index_stream(spark, source, SCHEMA, root, "cities", checkpoint, source_format="json", files_per_trigger=1).awaitTermination()

    def found():
        return sorted((r.city, r.n) for r in documents.open_published(spark, root).read("cities", SCHEMA).collect())

    documents.publish({"cities": spark.createDataFrame([("Rome", 0)], SCHEMA)}, root, "cities", floor=1)
    land([("Oslo", 1), ("Lima", 2)])
    index()
    land([("Hanoi", 3)])
    index()
    pinned = documents.open_published(spark, root)
    assert found() == [("Hanoi", 3), ("Lima", 2), ("Oslo", 1), ("Rome", 0)]
    # a crash after the documents were committed and before the stream's own commit
    (tmp_path / "log" / "commits" / "1").unlink()
    (tmp_path / "log" / "commits" / ".1.crc").unlink(missing_ok=True)
    index()
    assert found() == [("Hanoi", 3), ("Lima", 2), ("Oslo", 1), ("Rome", 0)]
    assert len(documents.open_published(spark, root).paths("cities")) == 3
    documents.merge_documents(spark, root, "cities")
    assert len(documents.open_published(spark, root).paths("cities")) == 1 and len(found()) == 4
    land([("Nairobi", 4)])
    index()
    assert len(found()) == 5 and pinned.texts("cities").count() == 4


def test_other_tables_stay_and_a_new_publication_starts_afresh(spark, tmp_path):
    root = str(tmp_path / "docs")
    one = spark.createDataFrame([("Rome", 0)], SCHEMA)
    documents.publish({"a": one, "b": one}, root, "a", floor=1)
    assert documents.append_documents(one, root, "a", "s", 0) and not documents.append_documents(one, root, "a", "s", 0)
    assert documents.append_documents(one, root, "a", "another stream", 0)
    now = documents.open_published(spark, root)
    assert (now.texts("a").count(), now.texts("b").count(), now.names) == (3, 1, ["a", "b"])
    documents.publish({"a": one, "b": one}, root, "a", floor=1)
    assert documents.open_published(spark, root).texts("a").count() == 1


def test_readers_of_older_publications_go_on(spark, tmp_path):
    root = str(tmp_path / "docs")
    tables = lambda n: {"a": spark.range(n).selectExpr("'x' AS city", "CAST(id AS INT) AS n")}
    documents.publish(tables(5), root, "a", floor=5, mark="monday")
    reader = documents.open_published(spark, root).read("a", SCHEMA)
    documents.publish(tables(99), root, "a", floor=5, mark="monday")  # a retry
    assert documents.open_published(spark, root).texts("a").count() == 5
    for n in (6, 7):
        documents.publish(tables(n), root, "a", floor=5)
    assert reader.count() == 5
    with pytest.raises(IncompleteData):
        documents.publish(tables(4), root, "a", floor=5)
    assert documents.open_published(spark, root).texts("a").count() == 7
    assert documents.open_published(spark, root).statistics("a")["rows"] == 7
    assert len(list((tmp_path / "docs" / "data").iterdir())) == 3


def test_the_gate_counts_while_it_writes(spark, tmp_path):
    """One job a table, none of which only counts."""
    tracker = spark.sparkContext.statusTracker()
    rows = spark.range(100, numPartitions=2).selectExpr("'x' AS city", "CAST(id AS INT) AS n")
    spark.sparkContext.setJobGroup("publish", "one publication")
    documents.publish({"a": rows, "b": rows}, str(tmp_path / "docs"), "a", floor=50)
    jobs = tracker.getJobIdsForGroup("publish")
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) == 2
