"""From landed JSON payloads to rows. A payload frame has one row per answer, its JSON text in ``payload``.

It may have the time of the answer in ``landed_at``: of several answers to one question a later one is preferred. A chart
that comes in pages has the place of a page's first entry in ``start``, from 0.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from chartspark import schemas
from chartspark.fixed_values import COUNTRIES, GENRE_RULES, UNWANTED_KEYWORDS
from chartspark.functions.classify import Rules, keyword_genre
from chartspark.functions.text import first_clean, is_upper, remove_text, word_count
from chartspark.operators.relate import LANDED, lookup, one_per_key


def country_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COUNTRIES, schemas.COUNTRY_DIM)


def parsed(payloads: DataFrame, schema: str) -> DataFrame:
    """The fields of the schema in place of the JSON text; NULL for what is not there or does not fit. Payloads that have
    been parsed (see :mod:`chartspark.sources.quarantine`) are as they are."""
    if payloads.schema["payload"].dataType.typeName() == "struct":
        return payloads
    return payloads.withColumn("payload", F.from_json("payload", schema))


def _optional(df: DataFrame, column: str) -> list[str]:
    return [column] if column in df.columns else []


def _entries(payloads: DataFrame, schema: str, entries: str, limit: int | None) -> DataFrame:
    """(country, rank, entry): the entries of charts, all or up to ``limit`` a country.

    The rank is the place in the chart, so an empty place leaves a gap.
    """
    start = F.col("start") if "start" in payloads.columns else F.lit(0)
    rows = parsed(payloads, schema).select("country", start.alias("start"), F.posexplode(entries).alias("pos", "entry"))
    ranked = rows.select("country", (F.col("start") + F.col("pos") + 1).cast("bigint").alias("rank"), "entry")
    return ranked if limit is None else ranked.filter(F.col("rank") <= limit)


def chart_a(payloads: DataFrame, countries: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows of platform A's charts, from ``(country, payload)``, all or up to ``limit`` a country."""
    track, first_artist = F.col("entry.track"), F.get(F.col("entry.track.artists"), F.lit(0))
    rows = (
        _entries(payloads, schemas.CHART_A_PAYLOAD, "payload.items", limit)
        .filter(track.isNotNull())
        .select(
            "country",
            "rank",
            track["id"].alias("track_id"),
            track["name"].alias("track_name"),
            first_artist["name"].alias("artist"),
            first_artist["id"].alias("artist_id"),
            track["album"]["name"].alias("album"),
            track["duration_ms"].alias("duration_ms"),
            track["popularity"].alias("spotify_popularity"),
            track["explicit"].alias("explicit"),
            track["album"]["release_date"].alias("release_date"),
        )
    )
    return with_continent(rows, countries)


def chart_b(payloads: DataFrame, countries: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows of platform B's charts, from ``(country, payload)``, all or up to ``limit`` a country."""
    track = F.col("entry")
    rows = (
        _entries(payloads, schemas.CHART_B_PAYLOAD, "payload.tracks.track", limit)
        .select(
            "rank",
            "country",
            track["name"].alias("track_name"),
            track["artist"]["name"].alias("artist"),
            track["duration"].alias("duration_ms"),
            track["listeners"].alias("lastfm_listeners"),
            track["url"].alias("lastfm_url"),
        )
    )
    return with_continent(rows, countries)


def with_continent(rows: DataFrame, countries: DataFrame) -> DataFrame:
    return lookup(rows, countries.select("country", "continent"), "country")


def audio_features(payloads: DataFrame) -> DataFrame:
    """One row of features per track id."""
    rows = (
        parsed(payloads, schemas.AUDIO_PAYLOAD)
        .select(F.explode("payload.audio_features").alias("feature"), *_optional(payloads, LANDED))
        .filter(F.col("feature.id").isNotNull())
        .select(
            F.col("feature.id").alias("track_id"),
            *[F.col(f"feature.{c}") for c in schemas.AUDIO_COLUMNS],
            *_optional(payloads, LANDED),
        )
    )
    return one_per_key(rows, ["track_id"])


def with_features(tracks: DataFrame, features: DataFrame) -> DataFrame:
    """Attach features by track id; a track without any keeps NULLs."""
    return lookup(tracks, features, "track_id")


def search_queries(tracks: DataFrame) -> DataFrame:
    """The names to search for: the track name without apostrophes."""
    return tracks.withColumn("search_name", remove_text(F.col("track_name")))


def found_tracks(payloads: DataFrame, unwanted: Sequence[str] = UNWANTED_KEYWORDS) -> DataFrame:
    """The chosen hit of each track search, from ``(track_name, artist, payload)``; searches without a hit vanish."""
    hit = F.col("hit")
    return (
        parsed(payloads, schemas.TRACK_SEARCH_PAYLOAD)
        .withColumn("hit", first_clean(F.col("payload.tracks.items"), unwanted=unwanted))
        .filter(hit.isNotNull())
        .select(
            "track_name",
            "artist",
            hit["id"].alias("track_id"),
            hit["album"]["name"].alias("album"),
            hit["popularity"].alias("spotify_popularity"),
            hit["explicit"].alias("explicit"),
            hit["album"]["release_date"].alias("release_date"),
            *_optional(payloads, LANDED),
        )
    )


def found_artists(payloads: DataFrame, rules: Rules = GENRE_RULES) -> DataFrame:
    """Id, tags and genre of the first hit of each artist search, from ``(artist, payload)``.

    Without a hit the id is NULL and the genre the default.
    """
    hit = F.get(F.col("payload.artists.items"), F.lit(0))
    return (
        parsed(payloads, schemas.ARTIST_SEARCH_PAYLOAD)
        .select(
            "artist",
            F.struct(hit["id"].alias("artist_id"), hit["genres"].alias("genres")).alias("info"),
            *_optional(payloads, LANDED),
        )
        .select("artist", "info.*", *_optional(payloads, LANDED))
        .withColumn("genre", keyword_genre(F.col("genres"), rules))
    )


def albums(payloads: DataFrame, all_types: bool = False) -> DataFrame:
    """Rows of full albums, from ``(artist, payload)``; names with a bracket are other versions and left out.

    With ``all_types`` none are left out, and ``album_type`` tells them apart. A list that is not given has no length:
    its number is NULL.
    """
    album = F.col("album")
    wanted = F.lit(True) if all_types else (album["album_type"] == "album") & ~album["name"].contains("(")
    return (
        parsed(payloads, schemas.ALBUMS_PAYLOAD)
        .select("artist", F.explode("payload.items").alias("album"))
        .filter(wanted)
        .select(
            "artist",
            album["id"].alias("album_id"),
            album["name"].alias("album_name"),
            album["release_date"].alias("release_date"),
            album["total_tracks"].alias("total_tracks"),
            F.array_size(album["artists"]).cast("bigint").alias("n_artists"),
            word_count(album["name"]).cast("bigint").alias("n_words_in_name"),
            F.array_size(album["available_markets"]).cast("bigint").alias("available_markets"),
            is_upper(album["name"]).alias("is_album_name_capitalized"),
            *([album["album_type"].alias("album_type")] if all_types else []),
        )
    )


def with_album_popularity(rows: DataFrame, details: DataFrame) -> DataFrame:
    """Attach the popularity from ``(album_id, payload)``; 0 where it is not given."""
    popularity = one_per_key(
        parsed(details, schemas.ALBUM_DETAIL_PAYLOAD).select(
            "album_id", F.col("payload.popularity").alias("album_popularity"), *_optional(details, LANDED)
        ),
        ["album_id"],
    )
    return lookup(rows, popularity, "album_id").fillna(0, subset=["album_popularity"]).drop("album_id")
