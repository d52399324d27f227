"""Tables in buckets and by date: what is shuffled and read of them."""

import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from chartspark.plans import datasets
from chartspark.sources import layout


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_a_bucketed_chart_is_joined_without_a_shuffle(spark, tmp_path, no_broadcast):
    pick = random.Random(1)
    chart = spark.createDataFrame([(f"a{pick.randrange(200)}", i) for i in range(4000)], "artist string, rank int")
    artists = spark.createDataFrame([(f"a{i}", f"g{i % 5}") for i in range(200)], "artist string, genre string")
    for name, df in (("chart_by_artist", chart), ("artists_by_artist", artists)):
        assert layout.write_bucketed(df, str(tmp_path / name), ["artist"], 8, name)

    def joined(left, right):
        return left.join(right, "artist").groupBy("artist").agg(F.count("*").alias("n"), F.max("genre").alias("genre"))

    bucketed = joined(spark.table("chart_by_artist"), spark.table("artists_by_artist"))
    assert exchanges(bucketed) == 0 and exchanges(joined(chart, artists)) >= 2
    assert rows(bucketed) == rows(joined(chart, artists))
    # only the side without buckets is shuffled
    assert exchanges(joined(spark.table("chart_by_artist"), artists)) == 1
    again = layout.open_bucketed(spark, str(tmp_path / "chart_by_artist"), "artist string, rank int", ["artist"], 8, "chart_again")
    assert exchanges(joined(again, spark.table("artists_by_artist"))) == 0
    assert rows(joined(again, artists)) == rows(joined(chart, artists))
    for name in ("chart_by_artist", "artists_by_artist", "chart_again"):
        spark.sql(f"DROP TABLE {name}")


def test_a_hot_key_is_not_bucketed(spark, tmp_path):
    hot = spark.createDataFrame([("hot",)] * 600 + [(f"a{i}",) for i in range(400)], "artist string")
    assert not layout.write_bucketed(hot, str(tmp_path / "hot"), ["artist"], 16, "hot_chart")
    assert not (tmp_path / "hot").exists()
    assert layout.largest_share(hot, ["artist"]) == 0.6 and layout.largest_share(hot.limit(0), ["artist"]) == 0


def rows_scanned(df):
    """What the scans gave out, by their own metric, after adaptive execution has ended."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = (plan.executedPlan() if plan.nodeName().startswith("Adaptive") else plan).collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_recent_songs_read_recent_files_only(spark, tmp_path):
    today, pick = date(2024, 6, 1), random.Random(2)
    data = [(i, today - timedelta(days=pick.randrange(4000)), pick.randrange(100)) for i in range(20_000)] + [(-1, None, 5)]
    chart = spark.createDataFrame(data, "track_id int, release_date date, spotify_popularity int")
    layout.clustered(chart, "release_date", parts=40).write.parquet(str(tmp_path / "chart"))
    stored = spark.read.parquet(str(tmp_path / "chart"))
    recent = datasets.released_since(stored, F.lit(today), 14)
    expected = sorted(((i, (today - d).days) for i, d, _ in data if d is not None and (today - d).days <= 14), key=repr)
    assert rows(recent.select("track_id", "track_age_days")) == expected
    assert "PushedFilters: [IsNotNull(release_date), GreaterThanOrEqual(release_date" in re.sub(r"\s+", " ", recent._jdf.queryExecution().toString())
    assert len(expected) <= rows_scanned(recent) < 2000  # of 20,001
    assert rows(datasets.released_since(stored, F.lit(today), 14, inclusive=False).select("track_id")) == sorted(((i,) for i, a in expected if a < 14), key=repr)


def test_files_hold_narrow_ranges_and_hot_days_are_dealt(spark, tmp_path):
    hot = [(i, date(2024, 1, 1)) for i in range(6000)] + [(i, date(2000, 1, 1) + timedelta(days=i)) for i in range(3000)]
    frame = spark.createDataFrame(hot, "track_id int, release_date date")
    layout.clustered(frame, "release_date", parts=12).write.parquet(str(tmp_path / "c"))
    found = spark.read.parquet(str(tmp_path / "c")).groupBy(F.input_file_name().alias("f")).agg(
        F.count("*").alias("n"), F.min("release_date").alias("least"), F.max("release_date").alias("most")).collect()
    assert max(r.n for r in found) < 2500 and len(found) >= 8
    old = sorted((r.least, r.most) for r in found if r.most < date(2024, 1, 1))
    assert all(a[1] <= b[0] for a, b in zip(old, old[1:]))
