"""Datasets over the charts of all days so far, kept up day by day: a run reads the charts of its own day only.

Of each day a summary is stored, a row per track and artist or per artist. Summaries merge, so the dataset over all days
is made from them and from today's artists. A day that is taken in again takes the place of what was known of it, and old
days can be merged into one part.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from chartspark.operators.summary import Summary
from chartspark.plans import datasets
from chartspark.sources.versions import ORPHAN_HOURS, RETAINED, PartedTable

#: The part that old days have been merged into.
BASE = "base"


class DaySummaries:
    """A summary for each day, under ``root``."""

    def __init__(self, spark: SparkSession, root: str, summary: Summary):
        self.summary, self.table = summary, PartedTable(spark, root)

    def days(self) -> list[str]:
        return sorted(p.removeprefix("day=") for p in self.table.log.latest().parts if p != BASE)

    def take_in(self, day: str, rows: DataFrame) -> None:
        """Store the summary of a day (as ISO text), in the place of an earlier one of that day."""
        merged_to = self.table.log.latest().facts.get("merged_to")
        if merged_to is not None and day < merged_to:
            raise ValueError(f"day {day} has been merged with others")
        self.table.put(f"day={day}", self.summary.of(rows))

    def merged(self) -> DataFrame:
        """The summary of all days."""
        return self.summary.merged(self.table.read())

    def merge_before(self, day: str) -> None:
        """Make one part of all days before ``day``; these cannot be taken in again."""
        old = [f"day={d}" for d in self.days() if d < day]
        if not old:
            return

        self.table.merge([BASE, *old], BASE, self.summary.merged)

        def note(version):
            version.facts["merged_to"] = day
            return version

        self.table.log.change(note)

    def tidy(self, retained: int = RETAINED, orphan_hours: float = ORPHAN_HOURS) -> list[str]:
        return self.table.tidy(retained, orphan_hours)


@dataclass
class ToDate:
    """The combined datasets over the charts of all days."""

    spark: SparkSession
    root: str

    def __post_init__(self):
        self.songs = DaySummaries(self.spark, f"{self.root}/songs", datasets.song_summary())
        self.genres = DaySummaries(self.spark, f"{self.root}/genres", datasets.GENRE_SUMMARY)
        self.artists = DaySummaries(self.spark, f"{self.root}/artists", datasets.ARTIST_SUMMARY)

    def take_in(self, day: str, chart_a: DataFrame, chart_b: DataFrame) -> None:
        charts = datasets.charts_by_source(chart_a, chart_b).filter(F.col("artist").isNotNull())
        self.songs.take_in(day, charts)
        self.genres.take_in(day, charts)
        self.artists.take_in(day, chart_a.filter(F.col("artist").isNotNull()))

    def unique_songs(self, artists: DataFrame, countries: DataFrame) -> DataFrame:
        return datasets.songs_of_summary(self.songs.merged(), artists, countries)

    def genres_performance(self, artists: DataFrame) -> DataFrame:
        return datasets.genres_of_summary(self.genres.merged(), artists)

    def artists_performance(self, albums: DataFrame) -> DataFrame:
        return datasets.artists_of_summary(albums, self.artists.merged())

    def merge_before(self, day: str) -> None:
        for part in (self.songs, self.genres, self.artists):
            part.merge_before(day)

    def tidy(self, retained: int = RETAINED, orphan_hours: float = ORPHAN_HOURS) -> list[str]:
        return [gone for part in (self.songs, self.genres, self.artists) for gone in part.tidy(retained, orphan_hours)]
