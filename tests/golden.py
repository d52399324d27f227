"""A tiny two-platform chart set as landed JSON, with the awkward cases in it."""

import json

from chartspark.plans.stages import Payloads


def track(key, name, artist, popularity=50, released="2022-05-06", explicit=False):
    return {
        "id": key, "name": name, "duration_ms": 200000, "popularity": popularity, "explicit": explicit,
        "artists": [{"id": f"id-{artist}", "name": artist}] if artist else [],
        "album": {"name": f"{name} album", "release_date": released}, "uri": "not read",
    }


CHART_A = {
    "France": [track("t1", "Song", "Alice", 90, "2022-05-06"), None, track("t2", "Tune", "Bob", 33, "2021-03"),
               track("t3", "Nameless", None, 40, "2020")],
    "Brazil": [track("t2", "Tune", "Bob", 33, "2021-03"), track("t1", "Song", "Alice", 90, "2022-05-06", True),
               track("t4", "Hum", "Dora", 67, "soon")],
    "Atlantis": [track("t5", "Wave", "Eve", 66, "2022-04-20")],
}
CHART_B = {
    "France": [("Song", "Alice", "210", "1000"), ("Chant", "Carl", "180", "400"), ("Song", "Zoe", "x", "many")],
    "Brazil": [("Chant", "Carl", "180", "200"), ("Lost", "Nobody", "100", "10")],
}
FEATURES = {
    "t1": dict(energy=0.8, danceability=0.5, loudness=-5.0, tempo=120.0),
    "t2": dict(energy=0.4, danceability=0.9, loudness=-15.0, tempo=80.0),
    "t4": dict(energy=0.2, danceability=0.3, loudness=-10.0, tempo=100.0),
    "t5": dict(energy=0.6, danceability=0.2, loudness=-7.0, tempo=90.0),
    "b1": dict(energy=0.7, danceability=0.6, loudness=-6.0, tempo=110.0),
    "b2": dict(energy=0.1, danceability=0.1, loudness=-9.0, tempo=95.0),
}
ARTISTS = {
    "Alice": [{"id": "id-Alice", "genres": ["dance pop", "rock"]}],
    "Bob": [{"id": "id-Bob", "genres": ["trap"]}, {"id": "other", "genres": ["jazz"]}],
    "Carl": [{"id": "id-Carl", "genres": ["latin jazz"]}],
    "Dora": [{"id": "id-Dora", "genres": []}],
    "Eve": [],
}
ALBUMS = {
    "Alice": [("FIRST", "2019", "album", 10, 1), ("Second One", "2020-01", "album", 12, 2),
              ("Second One (Live)", "2020-06-01", "album", 20, 1), ("Single", "2021", "single", 1, 1),
              ("Third", "2021-01-01", "album", 8, 1)],
    "Bob": [("Only", "2018-05-05", "album", 9, 3)],
}
DETAILS = {"Alice-0": {"popularity": 40}, "Alice-1": {"popularity": 60}, "Alice-4": {}, "Bob-0": {"popularity": 10}}


def feature(key, values):
    base = dict(key=1, mode=1, speechiness=0.1, acousticness=0.2, instrumentalness=0.0, liveness=0.5, valence=0.5, time_signature=4)
    return {"id": key, **base, **values}


def hit(key, name, popularity=30):
    return {"id": key, "name": name, "popularity": popularity, "explicit": True,
            "album": {"name": "Hit album", "release_date": "2021"}}


def payloads(spark) -> Payloads:
    def frame(rows, schema):
        return spark.createDataFrame([(*key, json.dumps(body)) for *key, body in rows], schema)

    return Payloads(
        chart_a=frame([(c, {"items": [{"track": t} for t in ts]}) for c, ts in CHART_A.items()], "country string, payload string"),
        chart_b=frame(
            [(c, {"tracks": {"track": [
                {"name": n, "artist": {"name": a}, "duration": d, "listeners": l, "url": f"https://b.example/{n}"}
                for n, a, d, l in ts]}}) for c, ts in CHART_B.items()],
            "country string, payload string"),
        features=frame([({"audio_features": [feature(k, v) for k, v in FEATURES.items()] + [None]},)], "payload string"),
        track_searches=frame(
            [("Chant", "Carl", {"tracks": {"items": [hit("b0", "Chant - Live"), hit("b1", "Chant")]}}),
             ("Song", "Zoe", {"tracks": {"items": [hit("b2", "Song (Acoustic)")]}}),
             ("Lost", "Nobody", {"tracks": {"items": []}})],
            "track_name string, artist string, payload string"),
        artist_searches=frame([(a, {"artists": {"items": hits}}) for a, hits in ARTISTS.items()], "artist string, payload string"),
        albums=frame(
            [(a, {"items": [
                {"id": f"{a}-{i}", "name": n, "release_date": d, "album_type": t, "total_tracks": tracks,
                 "artists": [{"id": "x", "name": "x"}] * by, "available_markets": ["FR", "BR"]}
                for i, (n, d, t, tracks, by) in enumerate(albums)]}) for a, albums in ALBUMS.items()],
            "artist string, payload string"),
        album_details=frame(list(DETAILS.items()), "album_id string, payload string"),
    )
