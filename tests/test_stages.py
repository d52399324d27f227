"""The whole run over the golden payloads, and its single stages."""

import json
import subprocess
import sys
from datetime import date
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import golden
from chartspark import schemas
from chartspark.operators.quality import IncompleteData
from chartspark.plans import datasets, stages
from chartspark.plans.stages import Lake
from chartspark.sources import documents, landing, storage, versions

AS_OF = date(2022, 5, 10)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    payloads = golden.payloads(spark)
    stages.land_chart_a(lake, payloads)
    stages.land_chart_b(lake, payloads)
    stages.enrich_chart_b(lake, payloads)
    stages.format_charts(lake, F.lit(AS_OF))
    lake.first_refresh = stages.augment(lake, payloads)
    lake.second_refresh = stages.augment(lake, payloads)
    stages.combine(lake)
    return lake


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", list(stages.SCHEMAS))
def test_products_have_their_schema(lake, spark, name):
    folders = [f"{lake.root}/{name}"]
    if name in stages.KEYED:  # in folders of versions
        folders = [f"{lake.root}/{name}/{p}" for parts in lake.keyed(name).log.latest().parts.values() for p in parts]
    found = dict(spark.read.parquet(*folders).dtypes)
    expected = dict(spark.createDataFrame([], stages.SCHEMAS[name]).dtypes)
    assert found == expected


def test_enriched_b(lake):
    b = lake.read(stages.ENRICHED_B)
    assert rows(b.select("country", "rank", "track_name", "artist", "track_id", "energy")) == [
        ("Brazil", 1, "Chant", "Carl", "b1", 0.7), ("Brazil", 2, "Lost", "Nobody", None, None),
        ("France", 1, "Song", "Alice", None, None), ("France", 2, "Chant", "Carl", "b1", 0.7),
        ("France", 3, "Song", "Zoe", "b2", 0.1),
    ]


def test_enrichment_by_title_only_reaches_other_artists(lake, spark):
    payloads = golden.payloads(spark)
    b = datasets.enriched_chart_b(
        lake.read(stages.RAW_B), lake.read(stages.RAW_A), payloads.track_searches, payloads.features, ["track_name"])
    assert ("Song", "Alice", "b2") in rows(b.select("track_name", "artist", "track_id"))


def test_formatted(lake):
    a = lake.read(stages.CHART_A).filter("country = 'France'").orderBy("rank").collect()
    assert [r.track_age_days for r in a] == [4, 435, 860]
    assert [r.spotify_popularity_category for r in a] == ["High", "Low", "Medium"]
    assert [r.loudness for r in a] == [1.0, 0.0, None]
    b = lake.read(stages.CHART_B).filter("country = 'France'").orderBy("rank").collect()
    assert [r.lastfm_listeners for r in b] == [1000.0, 400.0, None]
    assert [r.lastfm_popularity for r in b] == [100.0, 40.0, None]
    assert [r.lastfm_popularity_category for r in b] == ["High", "Medium", "High"]


def test_refresh_adds_only_the_unseen(lake):
    # Alice, Bob, Carl, Dora, Eve, Zoe, Nobody and the entry without an artist
    assert lake.first_refresh == (8, 4)
    assert lake.second_refresh == (0, 0)
    assert lake.read(stages.ARTISTS).count() == 8
    assert ("Zoe", None, "Unidentified") in rows(lake.read(stages.ARTISTS))


def test_unioned(lake):
    charts = lake.read("combined/unioned_top_charts")
    assert charts.count() == 12
    b_columns = lake.read(stages.CHART_B).columns
    assert charts.columns == [*b_columns, "country_code", "spotify_popularity", "spotify_popularity_category"]
    assert rows(charts.filter("country = 'Atlantis'").select("country_code")) == [(None,)]


def test_unique_songs(lake):
    songs = lake.read(stages.SONGS)
    assert songs.columns == ["track_id", "num_countries", "best_rank", "avg_rank", *datasets.CARRIED, "genre"]
    found = rows(songs.select("track_id", "num_countries", "best_rank", "avg_rank", "artist", "country_code", "genre"))
    assert found == [
        ("b1", 2, 1, 1.5, "Carl", "BR", "Jazz"),
        ("t1", 2, 1, 1.5, "Alice", "BR", "Pop"),
        ("t2", 2, 1, 2.0, "Bob", "BR", "Hip-Hop"),
        (None, 1, 1, 1.0, "Alice", "FR", "Pop"),
    ]
    charts = datasets.charts_by_source(lake.read(stages.CHART_A), lake.read(stages.CHART_B))
    countries = landing.country_table(lake.spark)
    assert datasets.unique_songs(charts, lake.read(stages.ARTISTS), countries, drop_null_key=True).count() == 3


def test_genres_performance(lake):
    assert rows(lake.read("combined/genres_performance")) == [
        ("Hip-Hop", 2.0, 1, 33.0, 33, None, None, 2, 0, 2),
        ("Jazz", 1.5, 1, None, None, 300.0, 400.0, 0, 2, 2),
        ("Pop", 4 / 3, 1, 90.0, 90, 1000.0, 1000.0, 2, 1, 3),
    ]


def test_artists_performance(lake):
    found = {r.artist: r for r in lake.read("combined/artists_performance").collect()}
    assert set(found) == {"Alice", "Bob"}
    alice = found["Alice"]
    assert (alice.genre, alice.total_albums) == ("Pop", 3)
    assert (alice.total_album_popularity, alice.total_spotify_popularity) == (200, 540)
    assert alice.avg_months_between_releases == 12.0
    assert found["Bob"].avg_months_between_releases is None


def test_viral_and_top1(lake):
    viral = lake.read("combined/viral_spotify_songs").collect()
    assert [(r.spotify_popularity, r.country) for r in viral] == [(90, "Brazil"), (90, "France")]
    assert viral[0].lastfm_url is None
    top = lake.read("combined/top1_spotify_songs").select("country", "top_track", "genre", "popularity").collect()
    assert [tuple(r) for r in top] == [
        ("Brazil", "Tune", "Hip-Hop", 33), ("France", "Song", "Pop", 90), ("Atlantis", "Wave", "Unidentified", 66)]


def test_publish(lake, spark, tmp_path):
    spark.createDataFrame([(1,)], "Cluster int").write.parquet(f"{lake.root}/{stages.SONGS_ML}")
    with pytest.raises(IncompleteData):
        stages.publish(lake, str(tmp_path / "docs"))
    assert not (tmp_path / "docs").exists()
    for _ in range(5):
        stages.publish(lake, str(tmp_path / "docs"), floor=12)
    assert len(list((tmp_path / "docs").glob("data/*/all_top_charts"))) == versions.RETAINED  # older ones are gone
    path = documents.published_path(spark, str(tmp_path / "docs"), "all_top_charts")
    docs = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert len(docs) == 12
    assert all({"timestamp", "track_id", "lastfm_url"} <= set(d) for d in docs)


def test_documents_keep_nulls(spark):
    df = spark.createDataFrame([(1, None, date(2020, 1, 2))], "a int, b string, d date")
    assert json.loads(documents.as_documents(df).first().document) == {"a": 1, "b": None, "d": "2020-01-02"}


def test_storage(spark, tmp_path):
    path = str(tmp_path / "t")
    assert storage.read_if_exists(spark, path, schemas.ARTISTS).count() == 0
    with pytest.raises(AnalysisException):
        storage.read_table(spark, path)
    assert storage.write_table(spark.range(5).withColumn("x", F.lit(1)), path) == (5, 2)
    assert storage.write_table(spark.range(3).withColumn("x", F.lit(1)), path) == (3, 2)
    assert storage.read_table(spark, path).count() == 3


def test_shared_folder_is_the_configured_one(spark):
    assert storage.fresh_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_force_refetch(spark, lake, tmp_path):
    copy = Lake(spark, str(tmp_path / "lake"))
    for name in (stages.CHART_A, stages.CHART_B):
        copy.write(lake.read(name), name)
    payloads = golden.payloads(spark)
    assert stages.augment(copy, payloads, stages.Options(max_artists=3)) == (3, 4)
    assert stages.augment(copy, payloads, stages.Options(force_refetch=True)) == (8, 4)
    assert copy.read(stages.ARTISTS).count() == 8


def test_run_from_end_to_end(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    payloads = golden.payloads(spark)
    # Seven clusters need seven songs with features.
    golden_features = {f"n{i}": dict(energy=i / 10, danceability=0.5, loudness=-i * 1.0, tempo=100.0 + i) for i in range(9)}
    payloads.chart_a = spark.createDataFrame(
        [("Spain", json.dumps({"items": [{"track": golden.track(k, k, "Alice")} for k in golden_features]}))],
        "country string, payload string")
    payloads.features = spark.createDataFrame(
        [(json.dumps({"audio_features": [golden.feature(k, v) for k, v in golden_features.items()]}),)], "payload string")
    stages.run(lake, payloads, str(tmp_path / "docs"), F.lit(AS_OF), floor=9)
    songs = lake.read(stages.SONGS_ML)
    assert songs.count() == 9
    assert {"Component_1", "Component_2", "Cluster"} <= set(songs.columns)
    assert len(list((tmp_path / "docs").glob("data/*/*/_SUCCESS"))) == len(stages.PUBLISHED)


def test_refresh_stops_when_nothing_is_new(lake, spark):
    broken = spark.range(1).select(F.raise_error(F.lit("read")).cast("string").alias("artist"), F.lit("").alias("payload"))
    payloads = golden.payloads(spark)
    payloads.artist_searches = payloads.albums = broken
    assert stages.augment(lake, payloads) == (0, 0)


def test_lists_of_what_to_fetch(lake):
    assert rows(stages.tracks_to_search(lake).select("track_name", "artist")) == [
        ("Chant", "Carl"), ("Lost", "Nobody"), ("Song", "Zoe")]
    assert stages.tracks_to_search(lake, stages.Options(enrich_limit=1)).count() == 1
    batches = stages.feature_batches(lake.read(stages.CHART_A)).collect()
    assert [b.ids for b in batches] == ["t1,t2,t3,t4,t5"]
    assert stages.artists_to_search(lake).count() == 0
    assert stages.artists_to_search(lake, stages.Options(force_refetch=True)).count() == 8


def test_options_limit_what_is_landed(spark, tmp_path):
    lake, payloads = Lake(spark, str(tmp_path / "lake")), golden.payloads(spark)
    options = stages.Options(countries=["France"], track_limit=2)
    stages.land_chart_a(lake, payloads, options)
    stages.land_chart_b(lake, payloads, options)
    assert rows(lake.read(stages.RAW_A).select("country", "rank")) == [("France", 1)]
    assert rows(lake.read(stages.RAW_B).select("country", "rank")) == [("France", 1), ("France", 2)]


def test_small_files_are_replaced_in_one_step(spark, tmp_path):
    path = str(tmp_path / "note")
    assert storage.read_text(spark, path) is None
    for text in ("first", "second"):
        storage.write_text(spark, path, text)
        assert storage.read_text(spark, path) == text
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["note"]


def test_stored_rows_are_deleted_when_the_driver_ends(tmp_path):
    """In a session of its own, since the files live as long as it."""
    script = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
from chartspark.session import build_session
from chartspark.sources.storage import materialise
spark = build_session("end", "local[1]", **{{"spark.ui.enabled": "false", "spark.checkpoint.dir": {str(tmp_path)!r}, "spark.sql.shuffle.partitions": "1"}})
assert materialise(spark.range(5)).count() == 5
spark.stop()
"""
    subprocess.run([sys.executable, "-c", script], check=True, capture_output=True, timeout=120)
    assert not list(tmp_path.rglob("*.parquet"))


def test_artists_fetched_again_are_replaced(spark, lake, tmp_path):
    copy = Lake(spark, str(tmp_path / "lake"), buckets=8)
    for name in (stages.CHART_A, stages.CHART_B):
        copy.write(lake.read(name), name)
    payloads = golden.payloads(spark)
    stages.augment(copy, payloads)
    artists, albums = rows(copy.read(stages.ARTISTS)), rows(copy.read(stages.ALBUMS))
    before = copy.keyed(stages.ARTISTS).log.latest().parts
    hit = {"artists": {"items": [{"id": "new id", "genres": ["jazz"]}]}}
    payloads.artist_searches = spark.createDataFrame([("Alice", json.dumps(hit))], "artist string, payload string")
    for _ in range(2):  # the second time changes nothing
        assert stages.augment(copy, payloads, stages.Options(refetch=["Alice"]))[0] == 1
        found = {r.artist: (r.artist_id, r.genre) for r in copy.read(stages.ARTISTS).collect()}
        assert found["Alice"] == ("new id", "Jazz") and len(found) == len(artists)
        assert len(rows(copy.read(stages.ALBUMS))) == len(albums)
    after = copy.keyed(stages.ARTISTS).log.latest().parts
    assert sum(before[b] != after[b] for b in before) == 1  # one bucket was written again


def test_albums_of_a_broken_off_run_are_not_added_twice(spark, lake, tmp_path, monkeypatch):
    copy, payloads = Lake(spark, str(tmp_path / "lake")), golden.payloads(spark)
    for name in (stages.CHART_A, stages.CHART_B):
        copy.write(lake.read(name), name)
    with monkeypatch.context() as broken:
        broken.setattr(versions.KeyedTable, "add", lambda *a, **b: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            stages.augment(copy, payloads)
    assert copy.read(stages.ALBUMS).count() == 4 and copy.read(stages.ARTISTS).count() == 0
    assert stages.augment(copy, payloads) == (8, 4)
    assert copy.read(stages.ALBUMS).count() == 4


def nine_songs(spark):
    payloads = golden.payloads(spark)
    features = {f"n{i}": dict(energy=i / 10, danceability=0.5, loudness=-i * 1.0, tempo=100.0 + i) for i in range(9)}
    payloads.chart_a = spark.createDataFrame(
        [("Spain", json.dumps({"items": [{"track": golden.track(k, k, "Alice")} for k in features]}))], "country string, payload string")
    payloads.features = spark.createDataFrame(
        [(json.dumps({"audio_features": [golden.feature(k, v) for k, v in features.items()]}),)], "payload string")
    return payloads


def test_a_run_that_broke_off_goes_on_where_it_broke(spark, tmp_path, monkeypatch):
    lake, payloads, docs = Lake(spark, str(tmp_path / "lake")), nine_songs(spark), str(tmp_path / "docs")

    def run(run_id="monday"):
        return stages.run(lake, payloads, docs, F.lit(AS_OF), floor=9, run_id=run_id, day="2022-05-10")

    with monkeypatch.context() as broken:
        broken.setattr(stages, "enhance_songs", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    journal = run()
    assert journal.skipped == ["land_chart_a", "land_chart_b", "enrich_chart_b", "format_charts", "augment", "combine", "combine_to_date"]
    assert journal.done == ["enhance_songs", "publish"]
    number = documents.open_published(spark, docs).version.number
    assert run().done == [] and documents.open_published(spark, docs).version.number == number
    # somebody writes a table: what is made from it is made again
    lake.write(lake.read(stages.RAW_B).limit(1), stages.RAW_B)
    again = run().done
    assert again[0] == "land_chart_b" and "combine" in again and "land_chart_a" not in again
    assert run("tuesday").skipped == []


def test_datasets_over_all_days(spark, lake, tmp_path):
    """Two days whose charts are the halves of one: the datasets to date are those over the whole."""
    copy, whole = Lake(spark, str(tmp_path / "lake")), {}
    for name in (stages.ARTISTS, stages.ALBUMS):
        copy.keyed(name).add(lake.read(name))
    for half in (0, 1):
        for name in (stages.CHART_A, stages.CHART_B):
            copy.write(lake.read(name).filter(F.col("rank") % 2 == half), name)
        stages.combine_to_date(copy, f"2022-05-{10 + half}")
    for name in ("unique_songs", "genres_performance", "artists_performance"):
        whole[name] = rows(lake.read(f"combined/{name}"))
        assert rows(copy.read(f"combined/{name}_to_date")) == whole[name]
    stages.combine_to_date(copy, "2022-05-11")  # a day again
    assert rows(copy.read("combined/unique_songs_to_date")) == whole["unique_songs"]


def test_what_a_scope_stores_is_gone_at_its_end(spark, tmp_path):
    with storage.scratch(spark):
        outer = storage.materialise(spark.range(3))
        with storage.scratch(spark):
            inner = storage.materialise(outer.filter("id > 0"))
            result = storage.kept(inner, str(tmp_path / "result"))
        assert outer.count() == 3
        with pytest.raises(Exception):
            spark.read.parquet(*inner.inputFiles()).count()
    assert result.count() == 2
    with pytest.raises(Exception):
        spark.read.parquet(*outer.inputFiles()).count()


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Elsewhere:
        """A session whose master is another machine and that names no folder."""

        conf = type("conf", (), {"get": staticmethod(lambda name, *default: None if default else "file:/somewhere/warehouse")})
        sparkContext = type("context", (), {"master": "spark://host:1", "getCheckpointDir": staticmethod(lambda: None)})
        _jvm, _jsc = spark._jvm, spark._jsc

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_folder(Elsewhere)
    Elsewhere.sparkContext.master = "local[2]"
    assert storage.shared_folder(Elsewhere) == "file:/somewhere/warehouse/_shared"
