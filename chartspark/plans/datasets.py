"""The datasets users read, each a function of the tables it is made from.

Aggregates over a join are computed on both sides before it. A chart is first reduced to a row per artist (or
per track and artist) where most rows merge before any shuffle, and only these rows meet the artists. A very
popular artist therefore never becomes one large task, and no joined row is made only to be summed up again.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chartspark.fixed_values import DEFAULT_GENRE, GENRE_RULES, UNWANTED_KEYWORDS, VIRAL_DAYS
from chartspark.functions.casts import cast_columns, to_partial_date
from chartspark.functions.classify import Rules
from chartspark.functions.features import (
    months_between,
    with_audio_features,
    with_popularity_category,
)
from chartspark.operators import summary
from chartspark.operators.rank import average_release_gap, first_row, sorted_rows
from chartspark.operators.relate import enrich, lookup, one_per_key, unseen_keys
from chartspark.operators.summary import Summary
from chartspark.operators.unite import align, aligned_union
from chartspark.schemas import CARRIED, FLAG_CARRIED, TOP_TRACK
from chartspark.sources import landing

# --- Formatted charts -------------------------------------------------------------------------------------


def formatted_chart_a(
    raw: DataFrame,
    as_of: Column | None = None,
    artist_ids: bool = False,
    latest: str | None = None,
    over: DataFrame | None = None,
) -> DataFrame:
    """``raw`` is read twice: its extremes come first, from the few columns they need. ``artist_ids`` keeps the artists'
    ids; for ``latest`` and ``over`` see :func:`~chartspark.functions.features.with_audio_features`."""
    typed = cast_columns(raw, ["duration_ms"], ["rank", "mode", "time_signature", "key"], ["explicit"], "release_date")
    return (
        typed.transform(with_popularity_category, "spotify")
        .transform(with_audio_features, as_of, latest=latest, over=over)
        .drop("duration_ms", *([] if artist_ids else ["artist_id"]))
    )


def formatted_chart_b(
    enriched: DataFrame,
    as_of: Column | None = None,
    duration_unit: str = "ms",
    latest: str | None = None,
    over: DataFrame | None = None,
) -> DataFrame:
    """``enriched`` is read twice, unless ``over`` is given: its extremes come first, from the few columns they need."""
    typed = cast_columns(
        enriched,
        ["duration_ms", "lastfm_listeners"],
        ["rank", "mode", "time_signature", "key"],
        ["explicit"],
        "release_date",
    )
    shares = {"lastfm_listeners": "lastfm_popularity"}
    return (
        typed.transform(with_audio_features, as_of, duration_unit, shares, latest, over)
        .transform(with_popularity_category, "lastfm")
        .drop("duration_ms", "spotify_popularity")
    )


def missing_tracks(raw_b: DataFrame, raw_a: DataFrame, limit: int | None = None) -> DataFrame:
    """The tracks to search for: on B's charts and not on A's, all or the first ``limit`` by name."""
    missing = unseen_keys(raw_b, raw_a, ["track_name", "artist"])
    return landing.search_queries(missing if limit is None else missing.orderBy("track_name", "artist").limit(limit))


def enriched_chart_b(
    raw_b: DataFrame,
    raw_a: DataFrame,
    search_payloads: DataFrame,
    feature_payloads: DataFrame,
    keys: Sequence[str] = ("track_name", "artist"),
    limit: int | None = None,
    unwanted: Sequence[str] = UNWANTED_KEYWORDS,
) -> DataFrame:
    """B's chart with the id, album and features of the tracks that A's charts lack, of the first ``limit`` if given.

    With ``keys=["track_name"]`` a title by several artists takes the hits of all of them.
    """
    wanted = missing_tracks(raw_b, raw_a, limit).drop("search_name")
    hits = one_per_key(landing.found_tracks(search_payloads, unwanted), ["track_name", "artist"])
    found = enrich(wanted, hits, ["track_name", "artist"]).filter(F.col("track_id").isNotNull())
    tracks = landing.with_features(found, landing.audio_features(feature_payloads))
    added = [c for c in tracks.columns if c not in ("track_name", "artist")]
    return enrich(raw_b, tracks.select(*keys, *added), list(keys))


# --- Artists ----------------------------------------------------------------------------------------------


def chart_artists(chart_a: DataFrame, chart_b: DataFrame, limit: int | None = None) -> DataFrame:
    artists = aligned_union(chart_a.select("artist"), chart_b.select("artist")).distinct()
    return artists if limit is None else artists.orderBy("artist").limit(limit)


def new_artists(
    wanted: DataFrame, known: DataFrame, search_payloads: DataFrame, rules: Rules = GENRE_RULES
) -> DataFrame:
    """The artists not known yet, with id and genre from their searches; without a search, unidentified."""
    unseen = unseen_keys(wanted, known, ["artist"])
    found = one_per_key(landing.found_artists(search_payloads, rules).drop("genres"), ["artist"])
    return enrich(unseen, found, ["artist"]).fillna(DEFAULT_GENRE, subset=["genre"])


def new_albums(artists: DataFrame, album_payloads: DataFrame, detail_payloads: DataFrame) -> DataFrame:
    """All albums of the payloads with their artist's genre; NULL where the artist is not among the given ones."""
    wanted = one_per_key(artists.select("artist", "genre"), ["artist"])
    return enrich(landing.with_album_popularity(landing.albums(album_payloads), detail_payloads), wanted, ["artist"])


# --- Combined datasets ------------------------------------------------------------------------------------


def with_country_code(chart: DataFrame, countries: DataFrame) -> DataFrame:
    return lookup(chart, countries.select("country", "country_code"), "country")


def charts_by_source(chart_a: DataFrame, chart_b: DataFrame) -> DataFrame:
    """Both charts with all columns, B's first; ``source`` is 0 for A and 1 for B."""
    b, a = align(chart_b.withColumn("source", F.lit(1)), chart_a.withColumn("source", F.lit(0)))
    return a.union(b)


def unioned_top_charts(chart_a: DataFrame, chart_b: DataFrame, countries: DataFrame) -> DataFrame:
    b, a = align(with_country_code(chart_b, countries), with_country_code(chart_a, countries))
    return a.unionByName(b)


def _identified(artists: DataFrame) -> DataFrame:
    return artists.filter(F.col("genre") != DEFAULT_GENRE).select("artist", "genre")


def song_summary(carried: Sequence[str] = CARRIED, order: Sequence[str] = ("source", "country", "rank")) -> Summary:
    """What :func:`unique_songs` has to know of chart entries, by track and artist."""
    return Summary(
        ["track_id", "artist"],
        {
            "entries": summary.present("track_name"),
            "best": summary.least("rank"),
            "rank_sum": summary.total("rank"),
            "rank_count": summary.present("rank"),
            "first": summary.first(first_row(_from_entry(carried), order)),
        },
    )


def _from_entry(carried: Sequence[str]) -> list[str]:
    return ["country", *[c for c in carried if c not in ("artist", "country_code")]]


def unique_songs(
    charts: DataFrame,
    artists: DataFrame,
    countries: DataFrame,
    carried: Sequence[str] = CARRIED,
    order: Sequence[str] = ("source", "country", "rank"),
    drop_null_key: bool = False,
) -> DataFrame:
    """One row per track of an identified artist: entries, best and average rank, and its first entry's columns.

    Tracks without an id fall into one row, unless ``drop_null_key``. The country code is looked up last, for
    the chosen entries only.
    """
    if drop_null_key:
        charts = charts.filter(F.col("track_id").isNotNull())
    per_artist = song_summary(carried, order).of(charts.filter(F.col("artist").isNotNull()))
    return songs_of_summary(per_artist, artists, countries, carried)


def songs_of_summary(
    per_artist: DataFrame, artists: DataFrame, countries: DataFrame, carried: Sequence[str] = CARRIED
) -> DataFrame:
    """:func:`unique_songs` of the entries that a :func:`song_summary` was made of."""
    songs = (
        per_artist.filter(F.col("artist").isNotNull())
        .join(_identified(artists), "artist")
        .groupBy("track_id")
        .agg(
            F.sum("entries").alias("num_countries"),
            F.min("best").alias("best_rank"),
            F.try_divide(F.sum("rank_sum"), F.sum("rank_count")).alias("avg_rank"),
            F.min(F.struct("first", F.struct("artist", "genre").alias("who"))).alias("pick"),
        )
        .select("track_id", "num_countries", "best_rank", "avg_rank", "pick.first.row.*", "pick.who.*")
    )
    return with_country_code(songs, countries).select(
        "track_id", "num_countries", "best_rank", "avg_rank", *carried, "genre"
    )


def song_countries(charts: DataFrame, artists: DataFrame) -> DataFrame:
    """In how many different countries each track of an identified artist is on the charts."""
    return (
        charts.select("track_id", "artist", "country")
        .distinct()
        .join(_identified(artists), "artist")
        .groupBy("track_id")
        .agg(F.count_distinct("country").alias("n_distinct_countries"))
    )


GENRE_SUMMARY = Summary(
    ["artist"],
    {
        **summary.spread("rank", "spotify_popularity", "lastfm_listeners"),
        "best": summary.least("rank"),
        "max_popularity": summary.most("spotify_popularity"),
        "max_listeners": summary.most("lastfm_listeners"),
        "on_b": summary.present("lastfm_popularity"),
        "entries": summary.rows(),
    },
)


def genres_performance(charts: DataFrame, artists: DataFrame) -> DataFrame:
    """Ranks, popularity, listeners and entries of each genre over both platforms."""
    return genres_of_summary(GENRE_SUMMARY.of(charts.filter(F.col("artist").isNotNull())), artists)


def genres_of_summary(per_artist: DataFrame, artists: DataFrame) -> DataFrame:
    """:func:`genres_performance` of the entries that a ``GENRE_SUMMARY`` was made of."""

    def average(c: str) -> Column:
        return F.try_divide(F.sum(f"sum_{c}"), F.sum(f"count_{c}"))

    return (
        per_artist.filter(F.col("artist").isNotNull())
        .join(_identified(artists), "artist")
        .groupBy("genre")
        .agg(
            average("rank").alias("avg_ranking"),
            F.min("best").alias("best_ranking"),
            average("spotify_popularity").alias("avg_song_popularity_on_spotify"),
            F.max("max_popularity").alias("max_song_popularity_on_spotify"),
            average("lastfm_listeners").alias("avg_listeners_on_lastfm"),
            F.max("max_listeners").alias("max_listeners_on_lastfm"),
            F.sum("count_spotify_popularity").alias("num_top_songs_on_spotify"),
            F.sum("on_b").alias("num_top_songs_on_lastfm"),
            F.sum("entries").alias("total_songs_in_genre"),
        )
    )


ARTIST_SUMMARY = Summary(
    ["artist"],
    {
        "n_songs": summary.rows(),
        **summary.spread("rank", "spotify_popularity"),
        "best": summary.least("rank"),
        "max_popularity": summary.most("spotify_popularity"),
    },
)


def artists_performance(albums: DataFrame, songs: DataFrame) -> DataFrame:
    """Album and song measures of each artist that has both.

    The measures are defined over all pairs of an artist's albums and songs. Pairing does not change an
    average, extreme or distinct count, and multiplies a sum by the other side's rows, so each side is
    aggregated alone and the pairs are never made.
    """
    return artists_of_summary(albums, ARTIST_SUMMARY.of(songs.filter(F.col("artist").isNotNull())))


def artists_of_summary(albums: DataFrame, per_artist: DataFrame) -> DataFrame:
    """:func:`artists_performance` of the songs that an ``ARTIST_SUMMARY`` was made of."""
    albums = albums.filter(F.col("artist").isNotNull()).withColumn("release_date", to_partial_date(F.col("release_date")))
    # One pass: rows merge to one for each name first, in a hash aggregate of numbers only.
    measures = ("album_popularity", "total_tracks", "available_markets", "n_artists", "n_words_in_name")
    per_name = albums.groupBy("artist", "album_name", "genre").agg(
        F.count("*").alias("n_albums"),
        F.max("album_popularity").alias("max_album_popularity"),
        F.min("album_popularity").alias("min_album_popularity"),
        *[f(c).alias(f"{name}_{c}") for c in measures for name, f in (("sum", F.sum), ("count", F.count))],
    )

    def average(c: str) -> Column:
        return F.try_divide(F.sum(f"sum_{c}"), F.sum(f"count_{c}"))

    album_side = per_name.groupBy("artist").agg(
        F.min("genre").alias("genre"),
        F.count_distinct("album_name").alias("total_albums"),
        F.sum("n_albums").alias("n_albums"),
        F.sum("sum_album_popularity").alias("album_popularity"),
        F.max("max_album_popularity").alias("max_album_popularity"),
        F.min("min_album_popularity").alias("min_album_popularity"),
        average("album_popularity").alias("avg_album_popularity"),
        average("total_tracks").alias("avg_total_tracks"),
        average("available_markets").alias("avg_available_markets"),
        average("n_artists").alias("avg_n_artists"),
        average("n_words_in_name").alias("avg_words_in_album_name"),
    )
    song_side = per_artist.filter(F.col("artist").isNotNull()).select(
        "artist",
        "n_songs",
        F.col("sum_spotify_popularity").alias("song_popularity"),
        F.try_divide("sum_rank", "count_rank").alias("avg_song_rank"),
        F.col("best").alias("best_song_rank"),
        F.try_divide("sum_spotify_popularity", "count_spotify_popularity").alias("avg_song_popularity_on_spotify"),
        F.col("max_popularity").alias("max_song_popularity_on_spotify"),
    )
    gaps = average_release_gap(albums, "artist", "release_date", "avg_months_between_releases")
    return (
        album_side.join(song_side, "artist")
        .join(gaps, "artist", "left")
        .select(
            "artist",
            "genre",
            "total_albums",
            (F.col("album_popularity") * F.col("n_songs")).alias("total_album_popularity"),
            (F.col("song_popularity") * F.col("n_albums")).alias("total_spotify_popularity"),
            "avg_album_popularity",
            "max_album_popularity",
            "min_album_popularity",
            "avg_song_rank",
            "best_song_rank",
            "avg_song_popularity_on_spotify",
            "max_song_popularity_on_spotify",
            "avg_total_tracks",
            "avg_available_markets",
            "avg_n_artists",
            "avg_words_in_album_name",
            "avg_months_between_releases",
        )
    )


def recent_songs(
    chart: DataFrame, days: int = VIRAL_DAYS, inclusive: bool = True, columns: Sequence[str] | None = None
) -> DataFrame:
    """Songs up to ``days`` old, the most popular first, then by country and rank as far as these are asked for."""
    age = F.col("track_age_days")
    columns = columns or chart.columns
    recent = chart.filter(age <= days if inclusive else age < days).select(*columns)
    return sorted_rows(recent, F.desc("spotify_popularity"), *[c for c in ("country", "rank") if c in columns])


def released_since(
    chart: DataFrame, as_of: Column, days: int = VIRAL_DAYS, inclusive: bool = True, released: str = "release_date"
) -> DataFrame:
    """The rows released up to ``days`` before ``as_of``, with their age then.

    The age is not read but made from the date, so a stored chart does not grow stale; and the filter is one on the date,
    by which a chart that is clustered by it skips the files and row groups of older songs. The date of a song to come
    counts as well, as its negative age does.
    """
    oldest = F.date_sub(as_of.cast("date"), days if inclusive else days - 1)
    age = F.datediff(as_of.cast("date"), F.col(released))
    return chart.filter(F.col(released) >= oldest).withColumn("track_age_days", age)


def new_tracks_performance(chart: DataFrame, days: int = 30) -> DataFrame:
    return recent_songs(chart, days, False, ["track_name", "artist", "release_date", "spotify_popularity"])


def viral_tracks(chart: DataFrame, days: int = 7) -> DataFrame:
    return recent_songs(chart, days, False, ["track_name", "artist", "spotify_popularity"])


def top1_songs(chart: DataFrame, artists: DataFrame, order: Sequence[str] = ("rank",)) -> DataFrame:
    """The first song of each country's chart with its artist's genre, by the country's largest popularity."""
    per_country = (
        chart.groupBy("country")
        .agg(first_row(TOP_TRACK, order).alias("first"), F.max("spotify_popularity").alias("largest"))
        .select("country", "largest", "first.row.*")
    )
    return (
        lookup(per_country, artists.select("artist", "genre"), "artist")
        .groupBy("country", "largest", *TOP_TRACK)
        .agg(F.min("genre").alias("genre"))
        .orderBy(F.desc("largest"), "country")
        .select(
            "country", "continent", F.col("track_name").alias("top_track"), "genre",
            *[c for c in TOP_TRACK if c not in ("continent", "track_name", "spotify_popularity")],
            F.col("spotify_popularity").alias("popularity"),
        )
    )


def cross_country_popularity(chart: DataFrame) -> DataFrame:
    """Tracks on the charts of several countries."""
    return (
        chart.groupBy("track_name", "artist")
        .agg(F.count_distinct("country").alias("countries_count"), F.avg("spotify_popularity").alias("avg_popularity"))
        .filter(F.col("countries_count") > 1)
        .orderBy(F.desc("avg_popularity"), "track_name", "artist")
    )


def genre_trends(chart: DataFrame, artists: DataFrame) -> DataFrame:
    """Average popularity of each genre; songs of unknown artists count under NULL."""
    per_artist = chart.groupBy("artist").agg(
        F.sum("spotify_popularity").alias("total"), F.count("spotify_popularity").alias("n")
    )
    return (
        lookup(per_artist, artists.select("artist", "genre"), "artist")
        .groupBy("genre")
        .agg(F.try_divide(F.sum("total"), F.sum("n")).alias("avg_popularity"))
        .orderBy(F.desc("avg_popularity"), "genre")
    )


def artist_across_platforms(chart_a: DataFrame, chart_b: DataFrame) -> DataFrame:
    """Average popularity on B of the tracks an artist has on A, by artist and popularity on A.

    Defined over pairs of chart entries of one track; the entries are counted on each side and not paired.
    """
    a = chart_a.groupBy("artist", "track_name", "spotify_popularity").agg(F.count("*").alias("n_a"))
    b = chart_b.groupBy("artist", "track_name").agg(
        F.sum("lastfm_popularity").alias("total"), F.count("lastfm_popularity").alias("n_b")
    )
    return (
        a.join(b, ["artist", "track_name"])
        .groupBy("artist", "spotify_popularity")
        .agg(
            F.try_divide(F.sum(F.col("total") * F.col("n_a")), F.sum(F.col("n_b") * F.col("n_a"))).alias(
                "lastfm_popularity_avg"
            )
        )
    )


def artist_popularity_factors(albums: DataFrame, songs: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Album averages and track popularity of each artist that has both."""
    as_of = F.current_date() if as_of is None else as_of
    album_side = (
        albums.withColumn("release_date", to_partial_date(F.col("release_date")))
        .groupBy("artist")
        .agg(
            F.avg("album_popularity").alias("avg_album_popularity"),
            F.max("album_popularity").alias("max_album_popularity"),
            F.min("album_popularity").alias("min_album_popularity"),
            F.avg("n_artists").alias("avg_n_artists"),
            F.avg("available_markets").alias("avg_available_markets"),
            F.avg("total_tracks").alias("avg_total_tracks"),
            F.avg("n_words_in_name").alias("avg_words_in_album_name"),
            F.avg(months_between(as_of, F.col("release_date"))).alias("avg_months_since_release"),
            F.count_distinct("album_name").alias("total_albums"),
        )
    )
    song_side = songs.groupBy("artist").agg(
        F.avg("spotify_popularity").alias("avg_track_popularity"),
        F.max("spotify_popularity").alias("max_track_popularity"),
    )
    return (
        album_side.join(song_side, "artist")
        .select(*[c for c in album_side.columns if c != "total_albums"], *song_side.columns[1:], "total_albums")
        .orderBy(F.desc("avg_track_popularity"), "artist")
    )


def distinct_songs(chart: DataFrame) -> DataFrame:
    return chart.select("track_name", "artist").distinct()


def explicit_impact(
    chart: DataFrame, carried: Sequence[str] = FLAG_CARRIED, order: Sequence[str] = ("country", "rank")
) -> DataFrame:
    """Popularity with and without explicit lyrics, and the first entry of each."""
    return (
        chart.groupBy("explicit")
        .agg(
            F.avg("spotify_popularity").alias("avg_popularity"),
            F.count("*").alias("total_tracks"),
            F.max("spotify_popularity").alias("max_popularity"),
            first_row(carried, order).alias("first"),
        )
        .select("explicit", "avg_popularity", "total_tracks", "max_popularity", "first.row.*")
    )
