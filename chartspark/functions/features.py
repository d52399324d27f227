"""Derived chart features."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chartspark.fixed_values import CATEGORY_BOUNDS

UNIT_PER_MINUTE = {"ms": 60000, "s": 60}


def age_in_days(date: Column, as_of: Column | None = None) -> Column:
    return F.date_diff(F.current_date() if as_of is None else as_of, date)


def duration_minutes(duration: Column, unit: str = "ms", digits: int | None = 2) -> Column:
    minutes = duration / UNIT_PER_MINUTE[unit]
    return minutes if digits is None else F.round(minutes, digits)


def popularity_category(
    popularity: Column,
    bounds: tuple[float, float] = CATEGORY_BOUNDS,
    bins: str = "open",
    null_label: str | None = "High",
) -> Column:
    """Low / Medium / High.

    ``open`` has no outer limits and files a missing value under ``null_label``; ``right_closed`` covers
    (0, 100] and leaves all else NULL.
    """
    low, high = bounds
    if bins == "right_closed":
        popularity = F.when((popularity > 0) & (popularity <= 100), popularity)
        null_label = None
    elif bins != "open":
        raise ValueError(f"unknown bins: {bins}")
    return (
        F.when(popularity <= low, "Low")
        .when(popularity <= high, "Medium")
        .when(popularity.isNotNull(), "High")
        .otherwise(F.lit(null_label))
    )


def energy_efficiency(energy: Column, danceability: Column, loudness: Column) -> Column:
    return F.try_divide(energy * danceability, loudness + 1)


def emotional_impact(valence: Column, energy: Column, liveness: Column) -> Column:
    return valence * energy * liveness


def with_extremes(
    df: DataFrame, columns: Sequence[str], out: str = "_extremes", over: DataFrame | None = None
) -> DataFrame:
    """Add a struct of the smallest and largest value of each column over the whole frame.

    All of them come from one aggregate, read back as a scalar subquery, so nothing passes through the driver
    program. As a column of its own the subquery is planned once and not once per use. ``over`` is a frame of fewer rows
    with the same extremes, which is read instead.
    """
    extremes = [F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns]
    return df.withColumn(out, (df if over is None else over).agg(F.struct(*extremes)).scalar())


def scaled(column: str, extremes: str = "_extremes", constant: float | None = None) -> Column:
    """A column on a 0-1 scale between its extremes; ``constant`` where it has no spread."""
    low, high = F.col(extremes)[column]["low"], F.col(extremes)[column]["high"]
    value = F.try_divide(F.col(column) - low, high - low)
    if constant is None:
        return value
    return F.when((high == low) & F.col(column).isNotNull(), F.lit(constant)).otherwise(value)


def share_of_max(column: str, scale: float = 100, extremes: str = "_extremes") -> Column:
    """A column as a share of its largest value; NULL where that is NULL or zero."""
    return F.try_divide(F.col(column), F.col(extremes)[column]["high"]) * scale


def with_minmax(df: DataFrame, targets: Mapping[str, str], constant: float | None = None) -> DataFrame:
    """Add 0-1 scaled copies of columns, ``{source: target}``."""
    copies = {target: scaled(source, constant=constant) for source, target in targets.items()}
    return with_extremes(df, list(targets)).withColumns(copies).drop("_extremes")


def with_share_of_max(df: DataFrame, source: str, target: str, scale: float = 100) -> DataFrame:
    return with_extremes(df, [source]).withColumn(target, share_of_max(source, scale)).drop("_extremes")


def with_audio_features(
    df: DataFrame,
    as_of: Column | None = None,
    duration_unit: str = "ms",
    shares: Mapping[str, str] | None = None,
    latest: str | None = None,
    over: DataFrame | None = None,
) -> DataFrame:
    """Age, minutes, 0-1 loudness and tempo, and the two composite indexes.

    ``shares`` adds columns as a percentage of their maximum, ``{source: target}``, and ``latest`` names a date column,
    left out of the result, whose largest value is the day of reference; both at no further pass. ``over`` is a frame of
    fewer rows with the same extremes of loudness, tempo, shares and dates.
    """
    shares = shares or {}
    if latest is not None:
        as_of = F.col("_extremes")[latest]["high"]
    names = {"loudness": "loudness_dB", "tempo": "tempo_bpm"}
    renamed, over = df.withColumnsRenamed(names), None if over is None else over.withColumnsRenamed(names)
    loudness = scaled("loudness_dB")
    added = {target: share_of_max(source) for source, target in shares.items()}
    added |= {
        "track_age_days": age_in_days(F.col("release_date"), as_of),
        "duration_min": duration_minutes(F.col("duration_ms"), duration_unit),
        "loudness": loudness,
        "tempo": scaled("tempo_bpm"),
        "energy_efficiency": energy_efficiency(F.col("energy"), F.col("danceability"), loudness),
        "emotional_impact": emotional_impact(F.col("valence"), F.col("energy"), F.col("liveness")),
    }
    dates = [latest] if latest is not None else []
    scales = with_extremes(renamed, [*names.values(), *shares, *dates], over=over)
    return scales.withColumns(added).drop("_extremes", *dates)


def with_popularity_category(df: DataFrame, platform: str) -> DataFrame:
    column = f"{platform}_popularity"
    return df.withColumn(f"{column}_category", popularity_category(F.col(column)))


def months_between(later: Column, earlier: Column) -> Column:
    return F.months_between(later, earlier)
