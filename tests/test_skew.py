"""Charts in which one artist and one missing key hold a third of the rows each, against the plain definition."""

import random

import pytest
from pyspark.sql import functions as F

from chartspark.operators import relate
from chartspark.plans import datasets


@pytest.fixture(scope="module")
def frames(spark):
    pick = random.Random(7)

    def artist():
        return pick.choices(["hot", None, f"a{pick.randrange(20)}"], [1, 1, 1])[0]

    songs = [(artist(), f"t{pick.randrange(9)}", pick.randrange(1, 50), pick.choice([None, *range(100)])) for _ in range(600)]
    listens = [(artist(), f"t{pick.randrange(9)}", float(pick.randrange(100))) for _ in range(600)]
    albums = [
        (artist(), f"n{pick.randrange(30)}", f"20{pick.randrange(10, 20)}-0{pick.randrange(1, 9)}", *(pick.randrange(50) for _ in range(5)), "Pop")
        for _ in range(300)
    ]
    return (
        spark.createDataFrame(songs, "artist string, track_name string, rank int, spotify_popularity bigint"),
        spark.createDataFrame(listens, "artist string, track_name string, lastfm_popularity double"),
        spark.createDataFrame(
            albums,
            "artist string, album_name string, release_date string, album_popularity bigint, total_tracks bigint, "
            "available_markets bigint, n_artists bigint, n_words_in_name bigint, genre string"),
    )


def same(found, expected):
    found, expected = (sorted(map(tuple, df.collect()), key=repr) for df in (found, expected))
    assert len(found) == len(expected) > 0
    for a, b in zip(found, expected):
        assert a == pytest.approx(b, nan_ok=True)


def test_artists_performance_equals_the_join_of_all_pairs(frames):
    songs, _, albums = frames
    pairs = albums.join(songs, "artist")
    found = datasets.artists_performance(albums, songs).drop("avg_months_between_releases", "genre")
    expected = pairs.groupBy("artist").agg(
        F.count_distinct("album_name"), F.sum("album_popularity"), F.sum("spotify_popularity"), F.avg("album_popularity"),
        F.max("album_popularity"), F.min("album_popularity"), F.avg("rank"), F.min("rank"), F.avg("spotify_popularity"),
        F.max("spotify_popularity"), F.avg("total_tracks"), F.avg("available_markets"), F.avg("n_artists"), F.avg("n_words_in_name"))
    same(found, expected)


def test_popularity_factors_equal_the_join_of_all_pairs(frames):
    songs, _, albums = frames
    found = datasets.artist_popularity_factors(albums, songs).select(
        "artist", "avg_album_popularity", "avg_track_popularity", "max_track_popularity", "total_albums")
    expected = albums.join(songs, "artist").groupBy("artist").agg(
        F.avg("album_popularity"), F.avg("spotify_popularity"), F.max("spotify_popularity"), F.count_distinct("album_name"))
    same(found, expected)


def test_platform_averages_equal_the_join_of_all_pairs(frames):
    songs, listens, _ = frames
    expected = songs.join(listens, ["artist", "track_name"]).groupBy("artist", "spotify_popularity").agg(F.avg("lastfm_popularity"))
    same(datasets.artist_across_platforms(songs, listens), expected)


def test_genre_trends_equal_the_join_of_all_rows(spark, frames):
    songs, _, _ = frames
    artists = spark.createDataFrame([("hot", "Pop"), ("a1", "Rock"), ("a2", "Pop")], "artist string, genre string")
    expected = songs.join(artists, "artist", "left").groupBy("genre").agg(F.avg("spotify_popularity"))
    same(datasets.genre_trends(songs, artists), expected)


@pytest.fixture
def split_early(spark):
    """Settings under which adaptive execution finds small data skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("hot", ["'hot'", "NULL"])
@pytest.mark.parametrize("join", ["lookup", "enrich", "unseen_rows"])
def test_a_hot_left_key_is_split(spark, split_early, join, hot):
    rows = spark.range(0, 60000, numPartitions=16).selectExpr(
        f"CASE WHEN id % 3 = 0 THEN {hot} ELSE concat('k', id % 997) END AS artist", "md5(cast(id AS string)) AS text")
    known = spark.range(500).selectExpr("concat('k', id) AS artist", "id AS n").union(
        spark.range(1).selectExpr(f"{hot} AS artist", "-1 AS n"))
    if join == "unseen_rows":
        known = known.filter("n >= 0")
    joined = {
        "lookup": lambda: relate.lookup(rows, known, "artist"),
        "enrich": lambda: relate.enrich(rows, known, ["artist"]),
        "unseen_rows": lambda: relate.unseen_rows(rows, known, ["artist"]),
    }[join]()
    found = joined.collect()
    if join == "unseen_rows":
        assert len(found) == 60000 - sum(1 for i in range(60000) if i % 3 and i % 997 < 500)
    else:
        assert len(found) == 60000
        # Plain equality does not match a missing key, but its rows have to be split all the same.
        assert sum(r.n == -1 for r in found) == (0 if join == "lookup" and hot == "NULL" else 20000)
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
