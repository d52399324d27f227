import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chartspark.operators import quality, rank, relate, unite


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_anti_join_matches_null_keys(spark):
    new = spark.createDataFrame([("a", 1), (None, 2), ("b", 3), ("b", 3)], "artist string, n int")
    known = spark.createDataFrame([("a",), (None,)], "artist string")
    assert rows(relate.unseen_rows(new, known, ["artist"])) == [("b", 3), ("b", 3)]
    assert rows(relate.unseen_keys(new, known, ["artist"])) == [("b",)]
    assert rows(relate.unseen_keys(new, known.limit(0), ["artist"])) == [("a",), ("b",), (None,)]


def test_anti_join_on_a_frame_of_the_same_source(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "artist string, n int")
    assert rows(relate.unseen_rows(df, df.filter("n = 1"), ["artist"])) == [("b", 2)]


def test_enrich_matches_null_keys_and_fans_out(spark):
    left = spark.createDataFrame([("t", "x"), (None, "y"), ("u", "z")], "track_name string, artist string")
    right = spark.createDataFrame([("t", 1), ("t", 2), (None, 3)], "track_name string, n int")
    assert rows(relate.enrich(left, right, ["track_name"])) == [
        ("t", "x", 1), ("t", "x", 2), ("u", "z", None), (None, "y", 3)]


def test_lookup_of_an_unknown_key(spark):
    df = spark.createDataFrame([("France",), ("Atlantis",), (None,)], "country string")
    dimension = spark.createDataFrame([("France", "FR")], "country string, country_code string")
    assert rows(relate.lookup(df, dimension, "country")) == [("Atlantis", None), ("France", "FR"), (None, None)]


def test_one_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("b", None, None)], "k string, n int, s string")
    assert rows(relate.one_per_key(df, ["k"])) == [("a", 1, "z"), ("b", None, None)]


def test_one_per_key_prefers_values_then_the_latest(spark):
    at = [datetime(2022, 5, day) for day in (1, 2, 3)]
    df = spark.createDataFrame(
        [("a", 1, "x", at[0]), ("a", 2, "y", at[1]), ("a", None, "z", at[2]), ("b", 5, "q", None), ("b", 7, "q", at[0]),
         ("c", None, "r", at[0]), ("c", None, None, at[2])],
        "k string, n int, s string, landed_at timestamp")
    assert rows(relate.one_per_key(df, ["k"])) == [("a", 2, "y"), ("b", 7, "q"), ("c", None, "r")]


def test_align_fills_with_the_other_type(spark):
    first = spark.createDataFrame([(1, "x")], "a int, b string")
    second = spark.createDataFrame([("y", 2.0, date(2020, 1, 1))], "b string, c double, d date")
    a, b = unite.align(first, second)
    assert a.dtypes == b.dtypes == [("a", "int"), ("b", "string"), ("c", "double"), ("d", "date")]
    assert rows(unite.aligned_union(first, second)) == [(1, "x", None, None), (None, "y", 2.0, date(2020, 1, 1))]
    assert unite.column_drift(first, second) == (["a"], ["c", "d"])


def test_top_n_and_head(spark):
    df = spark.createDataFrame([("g", i) for i in range(10)] + [("h", 1)], "g string, n int")
    assert rows(rank.top_n(df, ["g"], [F.desc("n")], 2)) == [("g", 8, 2), ("g", 9, 1), ("h", 1, 1)]
    assert rows(rank.head_rows(df, ["g", "n"], 2)) == [("g", 0), ("g", 1)]
    with pytest.raises(ValueError):
        rank.head_rows(df, ["n"], -1)


def test_top_n_cuts_a_hot_group_in_parts(spark, monkeypatch):
    df = spark.createDataFrame([("g", i) for i in range(500)] + [("h", 1)], "g string, n int")
    expected = rows(rank.top_n(df, ["g"], [F.desc("n")], 20))
    monkeypatch.setattr(rank, "CUT_BEFORE_SHUFFLE", 5)
    cut = rank.top_n(df, ["g"], [F.desc("n")], 20)
    assert rows(cut) == expected and cut.columns == ["g", "n", "rank"]


def test_numbered_and_ranked_rows(spark):
    values = [(f"g{i % 3}", i * 37 % 1009) for i in range(1009)]
    df = spark.createDataFrame(values, "g string, n int").repartition(7)
    assert sorted(tuple(r) for r in rank.numbered_rows(df, ["n"]).select("n", "number").collect()) == [
        (n, i + 1) for i, n in enumerate(sorted(n for _, n in values))]
    ranked = rank.all_ranked(df, ["g"], [F.desc("n")]).collect()
    for g in ("g0", "g1", "g2"):
        own = sorted((r["rank"], r.n) for r in ranked if r.g == g)
        assert [k for k, _ in own] == list(range(1, len(own) + 1))
        assert [n for _, n in own] == sorted((n for x, n in values if x == g), reverse=True)
    assert rank.numbered_rows(df.limit(0), ["n"]).count() == 0


def test_sorted_rows_keeps_copies(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (1, "a"), (1, "b")], "n int, s string")
    assert [tuple(r) for r in rank.sorted_rows(df, F.desc("n")).collect()] == [(2, "a"), (1, "a"), (1, "b"), (1, "b")]


def test_first_row_keeps_nulls_of_one_row(spark):
    df = spark.createDataFrame(
        [("g", None, "none", 1), ("g", 2, None, 7), ("g", 3, "late", 9)], "g string, place int, name string, v int")
    first = df.groupBy("g").agg(rank.first_row(["name", "v"], ["place"]).alias("f")).select("f.row.*")
    assert rows(first) == [(None, 7)]


def releases(seed, n=400):
    """Some releases share a day, one artist has a third of them, some dates and artists are missing."""
    pick = random.Random(seed)
    found = []
    for i in range(n):
        artist = "hot" if i % 3 == 0 else pick.choice(["a", "b", "c", "once", None])
        day = None if pick.random() < 0.05 else date(2000, 1, 1) + timedelta(days=pick.randrange(300) * 7)
        found.append((i, artist, day))
    return [r for i, r in enumerate(found) if r[1] != "once" or all(x[1] != "once" for x in found[:i])]


def expected_gaps(data):
    groups = defaultdict(list)
    for i, artist, day in data:
        groups[artist].append((day or date.min, i, day))
    following = {}
    for group in groups.values():
        group.sort()
        for current, after in zip(group, group[1:] + [None]):
            following[current[1]] = (current[2], after and after[2])
    return following


@pytest.mark.parametrize("seed", [1, 2])
def test_release_gaps_against_a_plain_loop(spark, seed):
    data = releases(seed)
    df = spark.createDataFrame(data, "id int, artist string, day date")
    following = spark.createDataFrame(
        [(i, a, b) for i, (a, b) in expected_gaps(data).items()], "id int, a date, b date"
    ).select("id", F.months_between("b", "a").alias("gap"))
    expected = {r.id: r.gap for r in following.collect()}
    found = {r.id: r.gap for r in rank.with_release_gap(df, "artist", "day", "id", "gap").collect()}
    assert found == expected and len(found) == len(data)

    sums = defaultdict(list)
    for i, artist, day in data:
        if expected[i] is not None:
            sums[artist].append(expected[i])
    averages = {r.artist: r.gap for r in rank.average_release_gap(df, "artist", "day", "gap").collect()}
    for artist, gap in averages.items():
        assert gap == (pytest.approx(sum(sums[artist]) / len(sums[artist])) if sums[artist] else None)


def test_id_batches_hold_every_id_once(spark):
    ids = [f"id{i % 700}" for i in range(2000)] + [None]
    batches = rank.id_batches(spark.createDataFrame([(i,) for i in ids], "id string"), "id").collect()
    listed = [i for b in batches for i in b.ids.split(",")]
    assert sorted(listed) == sorted({i for i in ids if i})
    assert all(b.n_ids == len(b.ids.split(",")) == 50 for b in batches)
    assert sorted(b.batch for b in batches) == list(range(14))
    short = rank.id_batches(spark.createDataFrame([(str(i),) for i in range(101)], "id string"), "id").collect()
    assert sorted(b.n_ids for b in short) == [1, 50, 50]


def test_pick_candidate(spark):
    df = spark.createDataFrame(
        [("s", 1, "x Live"), ("s", 2, "x"), ("s", 3, "y"), ("t", 1, "z Live"), ("t", 2, "z Edition")],
        "search string, pos int, name string")
    clean = ~F.col("name").rlike("Live|Edition")
    assert rows(rank.pick_candidate(df, ["search"], ["pos"], ["name"], clean)) == [("s", "x"), ("t", "z Edition")]


def test_quality_reports(spark):
    df = spark.createDataFrame(
        [("a", 1.0, ["x", "y"]), ("a", None, ["y"]), ("b", float("nan"), None), (None, 2.0, [])],
        "k string, v double, tags array<string>")
    assert quality.null_profile(df).first().asDict() == {"k_nulls": 1, "v_nulls": 1, "tags_nulls": 1, "n_rows": 4}
    assert rows(quality.complete_rows(df, ["v"]).select("k")) == [("a",), (None,)]
    assert rows(quality.duplicates(df, ["k"])) == [("a", 2)]
    assert [tuple(r) for r in quality.value_counts(df, "k").collect()] == [("a", 2), ("b", 1)]
    assert rows(quality.array_values(df, "tags")) == [("x",), ("y",)]
    assert rows(quality.not_found(df, "k").select("v")) == [(2.0,)]
    assert rows(quality.shape(df)) == [(4, 3)]
    assert quality.preview(df, 2).count() == 2


def test_gate(spark):
    assert quality.require_complete(spark.range(500)).count() == 500
    with pytest.raises(quality.IncompleteData):
        quality.require_complete(spark.range(499))
    assert rows(quality.completeness(spark.range(499))) == [(499, False)]
