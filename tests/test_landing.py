import json

import golden
from chartspark import schemas
from chartspark.plans import datasets
from chartspark.sources import landing


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_chart_a_ranks_keep_their_gaps(spark):
    chart = landing.chart_a(golden.payloads(spark).chart_a, landing.country_table(spark))
    assert chart.columns == [c.split()[0] for c in schemas.RAW_CHART_A.split(", ")][:12]
    assert rows(chart.select("country", "rank", "track_id", "artist", "continent")) == [
        ("Atlantis", 1, "t5", "Eve", None),
        ("Brazil", 1, "t2", "Bob", "America"), ("Brazil", 2, "t1", "Alice", "America"), ("Brazil", 3, "t4", "Dora", "America"),
        ("France", 1, "t1", "Alice", "Europe"), ("France", 3, "t2", "Bob", "Europe"), ("France", 4, "t3", None, "Europe"),
    ]


def test_chart_a_limit(spark):
    chart = landing.chart_a(golden.payloads(spark).chart_a, landing.country_table(spark), limit=3)
    assert rows(chart.filter("country = 'France'").select("rank")) == [(1,), (3,)]


def test_chart_b_limit(spark):
    chart = landing.chart_b(golden.payloads(spark).chart_b, landing.country_table(spark), limit=2)
    assert rows(chart.select("country", "rank", "track_name", "duration_ms")) == [
        ("Brazil", 1, "Chant", "180"), ("Brazil", 2, "Lost", "100"), ("France", 1, "Song", "210"), ("France", 2, "Chant", "180")]


def test_charts_are_landed_whole_and_in_pages(spark):
    entries = [{"track": golden.track(f"t{i}", f"n{i}", "Alice")} for i in range(60)]
    pages = [("France", start, json.dumps({"items": entries[start:start + 25]})) for start in (0, 25, 50)]
    df = spark.createDataFrame(pages, "country string, start bigint, payload string")
    countries = landing.country_table(spark)
    found = landing.chart_a(df, countries).select("rank", "track_id")
    assert rows(found) == sorted(((i + 1, f"t{i}") for i in range(60)), key=repr)
    assert landing.chart_a(df, countries, limit=30).count() == 30
    track = {"name": "n", "artist": {"name": "a"}, "duration": "1", "listeners": "2", "url": "u"}
    whole = spark.createDataFrame([("France", json.dumps({"tracks": {"track": [track] * 60}}))], "country string, payload string")
    assert landing.chart_b(whole, countries).count() == 60
    assert landing.chart_b(whole, countries, limit=None).count() == 60
    assert landing.chart_b(whole, countries, limit=50).count() == 50


def test_an_answer_beats_a_failed_one(spark):
    """Artist search: a miss and a hit. Audio: no energy, and 0.7. Album detail: no popularity, and 70."""
    def frame(bodies, **keys):
        rows_ = [(*keys.values(), json.dumps(b)) for b in bodies]
        return spark.createDataFrame(rows_, ", ".join([*(f"{k} string" for k in keys), "payload string"]))

    hit = {"artists": {"items": [{"id": "x", "genres": ["rock"]}]}}
    searches = frame([{"artists": {"items": []}}, hit], artist="Ann")
    wanted = spark.createDataFrame([("Ann",)], "artist string")
    assert rows(datasets.new_artists(wanted, wanted.limit(0), searches)) == [("Ann", "x", "Rock")]
    features = [golden.feature("t", {"energy": e, "danceability": 0.5, "loudness": -1.0, "tempo": 100.0}) for e in (None, 0.7)]
    assert landing.audio_features(frame([{"audio_features": [f]} for f in features])).first().energy == 0.7
    albums = spark.createDataFrame([("Ann", "a1"), ("Ann", "a2")], "artist string, album_id string")
    details = frame([{}, {"popularity": 70}], album_id="a1")
    assert rows(landing.with_album_popularity(albums, details)) == [("Ann", 0), ("Ann", 70)]


def test_features_once_per_track(spark):
    payload = golden.payloads(spark).features
    features = landing.audio_features(payload.union(payload))
    assert features.count() == len(golden.FEATURES)
    assert features.columns == ["track_id", *schemas.AUDIO_COLUMNS]
    assert features.filter("track_id = 't1'").first().loudness == -5.0


def test_found_tracks_skip_unwanted_versions(spark):
    found = landing.found_tracks(golden.payloads(spark).track_searches)
    assert rows(found.select("track_name", "artist", "track_id", "release_date")) == [
        ("Chant", "Carl", "b1", "2021"), ("Song", "Zoe", "b2", "2021")]


def test_found_artists(spark):
    found = landing.found_artists(golden.payloads(spark).artist_searches)
    assert rows(found.select("artist", "artist_id", "genre")) == [
        ("Alice", "id-Alice", "Pop"), ("Bob", "id-Bob", "Hip-Hop"), ("Carl", "id-Carl", "Jazz"),
        ("Dora", "id-Dora", "Unidentified"), ("Eve", None, "Unidentified")]


def test_albums(spark):
    payloads = golden.payloads(spark)
    albums = landing.with_album_popularity(landing.albums(payloads.albums), payloads.album_details)
    assert rows(albums) == [
        ("Alice", "FIRST", "2019", 10, 1, 1, 2, True, 40),
        ("Alice", "Second One", "2020-01", 12, 2, 2, 2, False, 60),
        ("Alice", "Third", "2021-01-01", 8, 1, 1, 2, False, 0),
        ("Bob", "Only", "2018-05-05", 9, 3, 1, 2, False, 10),
    ]


def test_albums_of_all_types(spark):
    albums = landing.albums(golden.payloads(spark).albums, all_types=True)
    assert rows(albums.select("artist", "album_name", "album_type")) == [
        ("Alice", "FIRST", "album"), ("Alice", "Second One (Live)", "album"), ("Alice", "Second One", "album"),
        ("Alice", "Single", "single"), ("Alice", "Third", "album"), ("Bob", "Only", "album")]


def test_a_missing_list_has_no_length(spark):
    body = {"items": [{"id": "x", "name": "N", "album_type": "album"}]}
    df = spark.createDataFrame([("Ann", json.dumps(body))], "artist string, payload string")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        found = landing.albums(df).first()
        spark.conf.unset("spark.sql.ansi.enabled")
        assert found.n_artists is None and found.available_markets is None


def test_albums_of_an_unknown_artist_keep_no_genre(spark):
    payloads = golden.payloads(spark)
    known = spark.createDataFrame([("Alice", "Pop")], "artist string, genre string")
    found = datasets.new_albums(known, payloads.albums, payloads.album_details)
    assert rows(found.select("artist", "genre").distinct()) == [("Alice", "Pop"), ("Bob", None)]


def test_broken_payload_gives_no_rows(spark):
    df = spark.createDataFrame([("France", "{"), ("Spain", json.dumps({"items": []}))], "country string, payload string")
    assert landing.chart_a(df, landing.country_table(spark)).count() == 0
