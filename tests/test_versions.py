"""Versions, tables whose rows are replaced by key, tables in parts, and datasets kept up day by day."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chartspark.operators import summary
from chartspark.operators.summary import Summary
from chartspark.plans.to_date import DaySummaries
from chartspark.sources.versions import Conflict, KeyedTable, Log, PartedTable, Version

SCHEMA = "name string, n int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_a_version_is_never_replaced(spark, tmp_path):
    log = Log(spark, str(tmp_path / "t"))
    assert log.latest() == Version() and log.numbers() == []
    log.commit(Version(1, {"a": ["data/x"]}))
    with pytest.raises(Conflict):
        log.commit(Version(1, {"a": ["data/y"]}))
    assert log.latest().parts == {"a": ["data/x"]}
    assert [p.name for p in (tmp_path / "t" / "_versions").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")] == []


def test_the_slower_writer_starts_again_from_the_others_version(spark, tmp_path):
    log, calls = Log(spark, str(tmp_path / "t")), []

    def make(version):
        calls.append(version.number)
        if len(calls) == 1:  # another one is first
            log.commit(Version(1, {"theirs": ["data/x"]}))
        version.parts["mine"] = ["data/y"]
        return version

    assert log.change(make).parts == {"theirs": ["data/x"], "mine": ["data/y"]}
    assert calls == [0, 1] and log.numbers() == [1, 2]
    assert log.change(lambda version: None).number == 2


def keyed(spark, tmp_path, **options):
    return KeyedTable(spark, str(tmp_path / "t"), ["name"], SCHEMA, **options)


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_rows_are_replaced_by_key(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=4)
    assert rows(table.read()) == [] and not table.exists()
    names = [f"k{i}" for i in range(40)]
    table.replace(frame(spark, *[(n, 0) for n in names], (None, 0)))
    first = table.log.latest()
    table.replace(frame(spark, ("k3", 1), ("k3", 2), ("new", 5), (None, 7)), keys=frame(spark, ("k4", 0)))
    expected = [(n, 0) for n in names if n not in ("k3", "k4")] + [("k3", 1), ("k3", 2), ("new", 5), (None, 7)]
    assert rows(table.read()) == sorted(expected, key=repr)
    assert len(rows(table.read(first.number))) == 41  # the version before is still there


def test_only_buckets_of_changed_keys_are_written(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=8)
    table.replace(frame(spark, *[(f"k{i}", 0) for i in range(200)]))
    before = table.log.latest().parts
    after = table.replace(frame(spark, ("k7", 1))).parts
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    table.replace(frame(spark, ("k7", 2)), mark="run 1")
    number = table.log.latest().number
    table.replace(frame(spark, ("k7", 3)), mark="run 1")  # a retry
    assert table.log.latest().number == number and ("k7", 2) in rows(table.read())


def test_added_rows_leave_files_alone(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=2)
    for i in range(10):
        before = {p for parts in table.log.latest().parts.values() for p in parts}
        table.add(frame(spark, *[(f"k{i}.{j}", i) for j in range(8)]))
        after = {p for parts in table.log.latest().parts.values() for p in parts}
        assert i >= 8 or before <= after
    assert max(len(p) for p in table.log.latest().parts.values()) <= 8
    assert rows(table.read()) == sorted(((f"k{i}.{j}", i) for i in range(10) for j in range(8)), key=repr)
    table.replace(frame(spark, ("z", 1)), only=True)
    assert rows(table.read()) == [("z", 1)]


def test_a_reader_keeps_its_version_and_tidying_removes_the_rest(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=1)
    table.replace(frame(spark, ("a", 1)))
    reader = table.read()
    for i in range(2):
        table.replace(frame(spark, ("a", 10 + i)))
        table.tidy()
    assert rows(reader) == [("a", 1)]
    broken = Path(table.log.root) / "data" / "broken"
    broken.mkdir()
    (broken / "part").write_text("")
    table.tidy(retained=1)
    assert len(list((Path(table.log.root) / "data").iterdir())) == 2  # the newest version's, and one that may still be written
    table.tidy(retained=1, orphan_hours=0)
    assert not broken.exists() and rows(table.read()) == [("a", 11)] and table.log.numbers() == [3]


def test_parts_know_their_statistics(spark, tmp_path):
    table = PartedTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        table.read()
    table.put("x", frame(spark, ("a", 1), (None, 3), ("a", None)), mark="m")
    table.put("x", frame(spark, ("never", 0)), mark="m")
    found = table.statistics()["x"]
    assert found["rows"] == 3
    assert found["columns"]["name"] == {"nulls": 1, "least": "a", "most": "a", "different": 1}
    assert found["columns"]["n"] == {"nulls": 1, "least": "1", "most": "3", "different": 2}
    table.put("y", frame(spark, ("b", 9)))
    table.merge(["x", "y", "not there"], "z", lambda df: df.filter("n IS NOT NULL"))
    assert table.log.latest().parts.keys() == {"z"} and rows(table.read()) == [("a", 1), ("b", 9), (None, 3)]


def test_a_part_written_while_it_is_merged_stays(spark, tmp_path):
    table = PartedTable(spark, str(tmp_path / "t"))
    table.put("x", frame(spark, ("a", 1)))

    def slow(df):
        table.put("x", frame(spark, ("a", 2)))
        return df

    with pytest.raises(ValueError):
        table.merge(["x"], "z", slow)
    assert rows(table.read()) == [("a", 2)]


def test_days_are_summed_up_once(spark, tmp_path):
    days = DaySummaries(spark, str(tmp_path / "s"), Summary(["name"], {"n": summary.total("n"), "least": summary.least("n")}))
    days.take_in("2024-01-01", frame(spark, ("a", 1), ("b", 5)))
    days.take_in("2024-01-02", frame(spark, ("a", 100)))
    days.take_in("2024-01-02", frame(spark, ("a", 3)))  # the day again, with other rows
    assert rows(days.merged()) == [("a", 4, 1), ("b", 5, 5)]
    days.merge_before("2024-01-02")
    assert days.days() == ["2024-01-02"] and rows(days.merged()) == [("a", 4, 1), ("b", 5, 5)]
    with pytest.raises(ValueError):
        days.take_in("2024-01-01", frame(spark, ("a", 1)))
    days.take_in("2024-01-03", frame(spark, ("b", 1), (None, 2)))
    days.merge_before("2024-01-04")
    assert days.days() == [] and rows(days.merged()) == [("a", 4, 1), ("b", 6, 1), (None, 2, 2)]
    days.merge_before("2024-01-04")
    assert rows(days.merged()) == [("a", 4, 1), ("b", 6, 1), (None, 2, 2)]


def test_a_day_reads_its_own_rows_only(spark, tmp_path):
    """The first day's rows are gone when the second is taken in, and the dataset is the one over both."""
    days = DaySummaries(spark, str(tmp_path / "s"), Summary(["name"], {"rows": summary.rows()}))
    path = str(tmp_path / "day1")
    frame(spark, ("a", 1), ("b", 2)).write.parquet(path)
    days.take_in("1", spark.read.parquet(path))
    for file in Path(path).glob("part-*"):
        file.write_bytes(b"broken")
    days.take_in("2", frame(spark, ("a", 7)))
    assert rows(days.merged()) == [("a", 2), ("b", 1)]
    with pytest.raises(Exception):
        spark.read.schema(SCHEMA).parquet(path).collect()
