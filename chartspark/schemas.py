"""Schemas of the landed payloads and of the tables, as DDL."""

AUDIO = ("energy double, danceability double, key {i}, loudness double, mode {i}, speechiness double, "
         "acousticness double, instrumentalness double, liveness double, valence double, tempo double, "
         "time_signature {i}")
AUDIO_COLUMNS = [field.split()[0] for field in AUDIO.split(", ")]

# Landed payloads: the fields that are read, out of larger JSON objects.
CHART_A_PAYLOAD = (
    "items array<struct<track: struct<id: string, name: string, duration_ms: bigint, popularity: bigint, "
    "explicit: boolean, artists: array<struct<id: string, name: string>>, "
    "album: struct<name: string, release_date: string>>>>"
)
CHART_B_PAYLOAD = (
    "tracks struct<track: array<struct<name: string, duration: string, listeners: string, url: string, "
    "artist: struct<name: string>>>>"
)
AUDIO_PAYLOAD = (
    "audio_features array<struct<id: string, "
    + AUDIO.format(i="bigint").replace(" double", ": double").replace(" bigint", ": bigint") + ">>"
)
TRACK_SEARCH_PAYLOAD = (
    "tracks struct<items: array<struct<id: string, name: string, popularity: bigint, explicit: boolean, "
    "album: struct<name: string, release_date: string>>>>"
)
ARTIST_SEARCH_PAYLOAD = "artists struct<items: array<struct<id: string, genres: array<string>>>>"
ALBUMS_PAYLOAD = (
    "items array<struct<id: string, album_type: string, name: string, release_date: string, "
    "total_tracks: bigint, artists: array<struct<id: string, name: string>>, available_markets: array<string>>>"
)
ALBUM_DETAIL_PAYLOAD = "popularity bigint"

# Flat tables.
COUNTRY_DIM = "country_code string, country string, continent string"
RAW_CHART_A = (
    "country string, rank bigint, track_id string, track_name string, artist string, artist_id string, "
    "album string, duration_ms bigint, spotify_popularity bigint, explicit boolean, release_date string, "
    "continent string, " + AUDIO.format(i="bigint")
)
RAW_CHART_B = (
    "rank bigint, country string, continent string, track_name string, artist string, duration_ms string, "
    "lastfm_listeners string, lastfm_url string"
)
ENRICHED_CHART_B = (
    RAW_CHART_B + ", track_id string, album string, spotify_popularity bigint, explicit boolean, "
    "release_date string, " + AUDIO.format(i="bigint")
)
AUDIO_FORMATTED = (
    AUDIO.format(i="int").replace("loudness ", "loudness_dB ").replace("tempo ", "tempo_bpm ")
)
DERIVED = (
    "track_age_days int, duration_min double, loudness double, tempo double, energy_efficiency double, "
    "emotional_impact double"
)
FORMATTED_CHART_A = (
    "country string, rank int, track_id string, track_name string, artist string, album string, "
    "spotify_popularity bigint, explicit boolean, release_date date, continent string, " + AUDIO_FORMATTED
    + ", spotify_popularity_category string, " + DERIVED
)
FORMATTED_CHART_B = (
    "rank int, country string, continent string, track_name string, artist string, lastfm_listeners double, "
    "lastfm_url string, track_id string, album string, explicit boolean, release_date date, " + AUDIO_FORMATTED
    + ", lastfm_popularity double, lastfm_popularity_category string, " + DERIVED
)
ARTISTS = "artist string, artist_id string, genre string"
ARTISTS_ALBUMS = (
    "artist string, album_name string, release_date string, total_tracks bigint, n_artists bigint, "
    "n_words_in_name bigint, available_markets bigint, is_album_name_capitalized boolean, "
    "album_popularity bigint, genre string"
)

# Output columns of the combined datasets.
CARRIED = [
    "track_name", "artist", "lastfm_listeners", "album", "explicit", "release_date", "energy", "danceability",
    "key", "loudness_dB", "mode", "speechiness", "acousticness", "instrumentalness", "liveness", "valence",
    "tempo_bpm", "time_signature", "lastfm_popularity", "lastfm_popularity_category", "track_age_days",
    "duration_min", "loudness", "tempo", "energy_efficiency", "emotional_impact", "country_code",
    "spotify_popularity", "spotify_popularity_category",
]
TOP_TRACK = [
    "continent", "track_name", "artist", "danceability", "energy", "loudness_dB", "speechiness", "acousticness",
    "instrumentalness", "liveness", "valence", "tempo_bpm", "duration_min", "spotify_popularity",
]
FLAG_CARRIED = [
    "country", "rank", "track_id", "track_name", "artist", "artist_id", "album", "release_date", "danceability",
    "energy", "key", "loudness_dB", "mode", "speechiness", "acousticness", "instrumentalness", "liveness", "valence",
    "tempo_bpm", "duration_min",
]
