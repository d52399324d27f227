"""The daily run, stage by stage, over a lake of Parquet tables.

Each stage reads the tables it needs, writes its products and returns nothing else; the order in ``run`` lands
platform A before platform B is enriched from it. Stages do not cache: a later stage reads just the columns it
needs back from Parquet.
"""

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from chartspark import schemas
from chartspark.fixed_values import GENRE_RULES, LOOKUP_BATCH, PUBLISH_FLOOR, UNWANTED_KEYWORDS
from chartspark.functions.classify import Rules
from chartspark.operators import ml, rank
from chartspark.operators.relate import unseen_keys
from chartspark.operators.unite import align
from chartspark.plans import datasets
from chartspark.plans.journal import Journal
from chartspark.plans.to_date import ToDate
from chartspark.sources import documents, landing, quarantine
from chartspark.sources.storage import materialise, read_if_exists, read_table, write_table
from chartspark.sources.versions import KeyedTable

RAW_A, RAW_B = "raw/chart_a", "raw/chart_b"
ENRICHED_B = "enriched/chart_b"
CHART_A, CHART_B = "formatted/chart_a", "formatted/chart_b"
ARTISTS, ALBUMS = "formatted/artists", "formatted/artists_albums"
SONGS, SONGS_ML = "combined/unique_songs", "combined/unique_songs_ml_enhanced"

SCHEMAS = {
    RAW_A: schemas.RAW_CHART_A,
    RAW_B: schemas.RAW_CHART_B,
    ENRICHED_B: schemas.ENRICHED_CHART_B,
    CHART_A: schemas.FORMATTED_CHART_A,
    CHART_B: schemas.FORMATTED_CHART_B,
    ARTISTS: schemas.ARTISTS,
    ALBUMS: schemas.ARTISTS_ALBUMS,
}
#: Tables in which the rows of some keys are replaced.
KEYED = {ARTISTS: ["artist"], ALBUMS: ["artist"]}
#: Summaries of the charts of all days, and what is made of them.
STATE, TO_DATE = "state", ["unique_songs_to_date", "genres_performance_to_date", "artists_performance_to_date"]
COMBINED = ["unioned_top_charts", "unique_songs", "genres_performance", "artists_performance", "viral_spotify_songs", "top1_spotify_songs"]
RUNS, QUARANTINE = "_runs", "quarantine"
#: Schema of each kind of payload, and the field that an answer has.
PAYLOADS = {
    "chart_a": (schemas.CHART_A_PAYLOAD, "items"),
    "chart_b": (schemas.CHART_B_PAYLOAD, "tracks"),
    "features": (schemas.AUDIO_PAYLOAD, "audio_features"),
}
PUBLISHED = {
    "all_top_charts": "combined/unioned_top_charts",
    "unique_songs": SONGS_ML,
    "genres_performance": "combined/genres_performance",
    "artists_performance": "combined/artists_performance",
    "viral_spotify_songs": "combined/viral_spotify_songs",
    "top1_spotify_songs": "combined/top1_spotify_songs",
}


@dataclass
class Lake:
    spark: SparkSession
    root: str
    buckets: int = 64  # of a keyed table, when it is first written

    def keyed(self, name: str) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/{name}", KEYED[name], SCHEMAS[name], self.buckets)

    def read(self, name: str) -> DataFrame:
        """A table; of a keyed one the version that is the latest now."""
        if name in KEYED:
            return self.keyed(name).read()
        return read_table(self.spark, f"{self.root}/{name}", SCHEMAS.get(name))

    def read_if_exists(self, name: str) -> DataFrame:
        if name in KEYED:
            return self.keyed(name).read()
        return read_if_exists(self.spark, f"{self.root}/{name}", SCHEMAS[name])

    def write(self, df: DataFrame, name: str, mode: str = "overwrite") -> tuple[int, int]:
        return write_table(df, f"{self.root}/{name}", mode)


@dataclass
class Payloads:
    """Landed answers, each with its key columns and the JSON text in ``payload``."""

    chart_a: DataFrame  # country
    chart_b: DataFrame  # country
    features: DataFrame
    track_searches: DataFrame  # track_name, artist
    artist_searches: DataFrame  # artist
    albums: DataFrame  # artist
    album_details: DataFrame  # album_id


@dataclass
class Options:
    """What a run takes in; the defaults take everything."""

    countries: Sequence[str] | None = None  # names
    track_limit: int | None = None  # entries of a chart
    enrich_keys: Sequence[str] = ("track_name", "artist")
    enrich_limit: int | None = None  # tracks searched for
    unwanted: Sequence[str] = tuple(UNWANTED_KEYWORDS)
    genre_rules: Rules = tuple(GENRE_RULES)
    max_artists: int | None = None
    get_albums: bool = True
    force_refetch: bool = False  # of all artists; nothing of those before stays
    refetch: Sequence[str] = ()  # artists that are fetched again beside the unknown ones
    n_components: int = 2


def _chosen(charts: DataFrame, options: Options) -> DataFrame:
    return charts if options.countries is None else charts.filter(F.col("country").isin(*options.countries))


@dataclass
class Intake:
    """Payloads of a stage on their way: parsed once, those that cannot be read counted by the stage's own write."""

    lake: Lake
    seen: dict[str, tuple[DataFrame, Observation]] = field(default_factory=dict)

    def answers(self, name: str, payloads: DataFrame) -> DataFrame:
        checked, counts = quarantine.counted(quarantine.examined(payloads, *PAYLOADS[name]))
        self.seen[name] = checked, counts
        return quarantine.answers(checked)

    def set_apart(self) -> dict[str, dict[str, int]]:
        """After the write: store what could not be read under ``quarantine``, and return the numbers by payload and
        problem. Where there is nothing nothing is read again."""
        found = {}
        for name, (checked, counts) in self.seen.items():
            found[name] = {k: n for k, n in counts.get.items() if k != "payloads" and n}
            if found[name]:
                keys = [c for c in checked.columns if c not in ("payload", quarantine.PROBLEM, quarantine.TEXT)]
                self.lake.write(quarantine.set_apart(checked, keys), f"{QUARANTINE}/{name}")
        return found


def land_chart_a(lake: Lake, payloads: Payloads, options: Options = Options()) -> dict[str, dict[str, int]]:
    """Returns the numbers of payloads that could not be read, by problem."""
    countries, intake = landing.country_table(lake.spark), Intake(lake)
    chart = landing.chart_a(intake.answers("chart_a", _chosen(payloads.chart_a, options)), countries, options.track_limit)
    lake.write(landing.with_features(chart, landing.audio_features(intake.answers("features", payloads.features))), RAW_A)
    return intake.set_apart()


def land_chart_b(lake: Lake, payloads: Payloads, options: Options = Options()) -> dict[str, dict[str, int]]:
    countries, intake = landing.country_table(lake.spark), Intake(lake)
    lake.write(landing.chart_b(intake.answers("chart_b", _chosen(payloads.chart_b, options)), countries, options.track_limit), RAW_B)
    return intake.set_apart()


def tracks_to_search(lake: Lake, options: Options = Options()) -> DataFrame:
    """What to fetch before B is enriched: the tracks that A's charts lack, and the name to search for."""
    return datasets.missing_tracks(lake.read(RAW_B), lake.read(RAW_A), options.enrich_limit)


def feature_batches(tracks: DataFrame, size: int = LOOKUP_BATCH) -> DataFrame:
    """What to fetch for tracks: their ids in batches."""
    return rank.id_batches(tracks, "track_id", size)


def artists_to_search(lake: Lake, options: Options = Options()) -> DataFrame:
    """What to fetch before the artists are added: those on the charts that are not known yet or wanted again."""
    wanted = datasets.chart_artists(lake.read(CHART_A), lake.read(CHART_B), options.max_artists)
    if options.force_refetch:
        return wanted
    known = lake.read_if_exists(ARTISTS).filter(~F.coalesce(F.col("artist").isin(*options.refetch), F.lit(False)))
    return unseen_keys(wanted, known, ["artist"])


def enrich_chart_b(lake: Lake, payloads: Payloads, options: Options = Options()) -> None:
    enriched = datasets.enriched_chart_b(
        lake.read(RAW_B), lake.read(RAW_A), payloads.track_searches, payloads.features,
        options.enrich_keys, options.enrich_limit, options.unwanted,
    )
    lake.write(enriched, ENRICHED_B)


def format_charts(lake: Lake, as_of: Column | None = None) -> None:
    lake.write(datasets.formatted_chart_a(lake.read(RAW_A), as_of), CHART_A)
    lake.write(datasets.formatted_chart_b(lake.read(ENRICHED_B), as_of), CHART_B)


def augment(lake: Lake, payloads: Payloads, options: Options = Options()) -> tuple[int, int]:
    """Add the artists (and their albums) that are not known yet; returns the numbers of their rows.

    With nothing new it stops before it looks at any payload. Artists to be fetched again are replaced, with all their
    albums; only the buckets that hold them are written. The albums go first, since it is the artists' table that tells
    which are done: a run that broke off in between has left albums whose artists are still to come, and the next one
    puts its own in their place. So a retry changes nothing.
    """
    wanted = materialise(artists_to_search(lake, options))
    if wanted.isEmpty():
        return 0, 0
    known = lake.spark.createDataFrame([], schemas.ARTISTS)  # the wanted ones are new already
    added = materialise(datasets.new_artists(wanted, known, payloads.artist_searches, options.genre_rules))
    n_albums = 0
    if options.get_albums:
        same = F.col("l.artist").eqNullSafe(F.col("r.artist"))
        fetched = payloads.albums.alias("l").join(added.select("artist").alias("r"), same, "left_semi")
        albums = materialise(datasets.new_albums(added, fetched, payloads.album_details))
        n_albums = albums.count()
        lake.keyed(ALBUMS).replace(albums, added, only=options.force_refetch)
    if options.force_refetch or options.refetch:
        lake.keyed(ARTISTS).replace(added, only=options.force_refetch)
    else:
        lake.keyed(ARTISTS).add(added)
    return added.count(), n_albums


def combine(lake: Lake) -> None:
    countries = landing.country_table(lake.spark)
    a, b, artists = lake.read(CHART_A), lake.read(CHART_B), lake.read(ARTISTS)
    charts = datasets.charts_by_source(a, b)
    _, aligned_a = align(b, a)
    products = {
        "unioned_top_charts": datasets.unioned_top_charts(a, b, countries),
        "unique_songs": datasets.unique_songs(charts, artists, countries),
        "genres_performance": datasets.genres_performance(charts, artists),
        "artists_performance": datasets.artists_performance(lake.read(ALBUMS), a),
        "viral_spotify_songs": datasets.recent_songs(datasets.with_country_code(aligned_a, countries)),
        "top1_spotify_songs": datasets.top1_songs(a, artists),
    }
    for name in COMBINED:
        lake.write(products[name], f"combined/{name}")


def combine_to_date(lake: Lake, day: str) -> None:
    """Take in the charts of a day (as ISO text), and make the datasets over all days taken in."""
    to_date = ToDate(lake.spark, f"{lake.root}/{STATE}")
    to_date.take_in(day, lake.read(CHART_A), lake.read(CHART_B))
    countries, artists = landing.country_table(lake.spark), lake.read(ARTISTS)
    products = [
        to_date.unique_songs(artists, countries),
        to_date.genres_performance(artists),
        to_date.artists_performance(lake.read(ALBUMS)),
    ]
    for name, df in zip(TO_DATE, products, strict=True):
        lake.write(df, f"combined/{name}")
    to_date.tidy()


def enhance_songs(lake: Lake, n_components: int = 2) -> None:
    lake.write(ml.enhanced_songs(lake.read(SONGS), n_components=n_components), SONGS_ML)


def publish(lake: Lake, target: str, floor: int = PUBLISH_FLOOR, mark: str | None = None) -> None:
    tables = {name: lake.read(path) for name, path in PUBLISHED.items()}
    documents.publish(tables, target, "all_top_charts", floor, mark=mark)


def run(
    lake: Lake,
    payloads: Payloads,
    target: str,
    as_of: Column | None = None,
    floor: int = PUBLISH_FLOOR,
    options: Options = Options(),
    run_id: str | None = None,
    day: str | None = None,
) -> Journal | None:
    """All stages. With a ``day`` the datasets over all days are kept up as well.

    A run with a ``run_id`` keeps a journal, which it returns: called again with the same id after it broke off, it goes
    on at the stage that broke. The payloads have to be the same then.
    """
    at = lambda *names: [f"{lake.root}/{name}" for name in names]
    steps = [
        ("land_chart_a", lambda: land_chart_a(lake, payloads, options), at(), at(RAW_A)),
        ("land_chart_b", lambda: land_chart_b(lake, payloads, options), at(), at(RAW_B)),
        ("enrich_chart_b", lambda: enrich_chart_b(lake, payloads, options), at(RAW_A, RAW_B), at(ENRICHED_B)),
        ("format_charts", lambda: format_charts(lake, as_of), at(RAW_A, ENRICHED_B), at(CHART_A, CHART_B)),
        ("augment", lambda: augment(lake, payloads, options), at(CHART_A, CHART_B), at(ARTISTS, ALBUMS)),
        ("combine", lambda: combine(lake), at(CHART_A, CHART_B, ARTISTS, ALBUMS), at(*(f"combined/{n}" for n in COMBINED))),
        ("enhance_songs", lambda: enhance_songs(lake, options.n_components), at(SONGS), at(SONGS_ML)),
        ("publish", lambda: publish(lake, target, floor, run_id), at(*PUBLISHED.values()), [target]),
    ]
    if day is not None:
        kept_up = ("combine_to_date", lambda: combine_to_date(lake, day), at(CHART_A, CHART_B, ARTISTS, ALBUMS), at(*(f"combined/{n}" for n in TO_DATE)))
        steps.insert(6, kept_up)
    journal = None if run_id is None else Journal(lake.spark, f"{lake.root}/{RUNS}", run_id)
    for name, action, reads, writes in steps:
        if journal is None:
            action()
        else:
            journal.stage(name, action, reads, writes)
    return journal
