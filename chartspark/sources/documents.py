"""Publishing tables as JSON documents."""

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chartspark.fixed_values import PUBLISH_FLOOR
from chartspark.operators.quality import IncompleteData
from chartspark.sources.versions import RETAINED, Log, Version, observed, statistics

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def utc_stamp(session_zone: str) -> Column:
    """The current time in UTC as ISO text."""
    return F.date_format(F.convert_timezone(F.lit(session_zone), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")),
                         ISO_FORMAT)


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp", utc_stamp(df.sparkSession.conf.get("spark.sql.session.timeZone")))


def as_documents(df: DataFrame, out: str = "document") -> DataFrame:
    """Each row as one JSON text; NULLs are kept as null."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(out))


def write_documents(df: DataFrame, path: str) -> None:
    """Replace the documents at the path by the rows, stamped. Every executor writes its own share."""
    stamped(df).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


@dataclass(frozen=True)
class Published:
    """The published tables as they were when this was opened: later publications do not change what it reads."""

    spark: SparkSession
    root: str
    version: Version

    @property
    def names(self) -> list[str]:
        return sorted(self.version.parts)

    def paths(self, name: str) -> list[str]:
        return [f"{self.root}/{p}" for p in self.version.parts[name]]

    def texts(self, name: str) -> DataFrame:
        """The documents of a table, one JSON text in ``value`` each."""
        return self.spark.read.text(self.paths(name))

    def read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).json(self.paths(name))

    def statistics(self, name: str) -> dict:
        """What the write of the table has seen: rows, and NULLs, extremes and different values of each column."""
        return self.version.facts.get("statistics", {}).get(name, {})


def open_published(spark: SparkSession, root: str, number: int | None = None) -> Published:
    """The newest publication, or the one of a number, as far as it is still retained."""
    log = Log(spark, root)
    version = log.latest() if number is None else log.at(number)
    if not version.number:
        raise ValueError(f"nothing was published to {root}")
    return Published(spark, log.root, version)


def publish(
    tables: Mapping[str, DataFrame],
    root: str,
    gate: str,
    floor: int = PUBLISH_FLOOR,
    retained: int = RETAINED,
    mark: str | None = None,
) -> Version:
    """Publish all tables in one step, unless the one named ``gate`` is too small to be complete.

    Every run writes to a folder of its own and then commits a version that names it. Readers that have opened a version
    go on reading it: the ``retained`` newest stay, older ones are deleted, and so is what broken-off runs have left
    (see :class:`~chartspark.sources.versions.Log`). Rows are counted by the write itself: the gate is written first, and
    nothing is read twice. A second publication with the same ``mark`` does nothing.
    """
    spark = tables[gate].sparkSession
    log = Log(spark, root)
    if mark is not None and mark in log.latest().applied:
        return log.latest()
    folder, noted = log.fresh(), {}
    for name in sorted(tables, key=lambda n: n != gate):
        df, seen = observed(tables[name])
        write_documents(df, f"{log.root}/{folder}/{name}")
        noted[name] = statistics(seen)
        if name == gate and noted[name]["rows"] < floor:
            log.forget(folder)
            raise IncompleteData(f"{noted[name]['rows']} rows, {floor} needed to publish")

    def make(version: Version) -> Version:
        version.parts = {name: [f"{folder}/{name}"] for name in tables}
        version.facts = {"statistics": noted, "streams": {}}
        if mark is not None:
            version.applied.append(mark)
        return version

    version = log.change(make)
    log.tidy(retained)
    return version


def append_documents(df: DataFrame, root: str, name: str, stream: str, batch: int) -> bool:
    """Add a stream's batch to a published table; False if the table has it already.

    The version that names the new files says in the same step which batch of the stream was the last, so a batch that is
    repeated after a crash adds nothing. Its files are stamped JSON documents in a folder of their own.
    """
    log = Log(df.sparkSession, root)

    def has(version: Version) -> bool:
        return version.facts.get("streams", {}).get(f"{name}|{stream}", -1) >= batch

    if has(log.latest()):
        return False
    folder = log.fresh()
    write_documents(df, f"{log.root}/{folder}/{name}")
    added = []

    def make(version: Version) -> Version | None:
        added.clear()
        if has(version):
            return None
        version.parts.setdefault(name, []).append(f"{folder}/{name}")
        version.facts.setdefault("streams", {})[f"{name}|{stream}"] = batch
        added.append(folder)
        return version

    log.change(make)
    if not added:
        log.forget(folder)
    return bool(added)


def merge_documents(spark: SparkSession, root: str, name: str, files: int | None = None) -> None:
    """Make one folder of a table that many small batches were added to; batches added meanwhile stay beside it."""
    log = Log(spark, root)
    taken = log.latest().parts.get(name, [])
    if len(taken) < 2:
        return
    folder, texts = log.fresh(), spark.read.text([f"{log.root}/{p}" for p in taken])
    (texts if files is None else texts.coalesce(files)).write.text(f"{log.root}/{folder}/{name}")

    def make(version: Version) -> Version:
        now = version.parts.get(name, [])
        if now[: len(taken)] != taken:
            raise ValueError(f"{name} was published while it was merged")
        version.parts[name] = [f"{folder}/{name}", *now[len(taken) :]]
        return version

    log.change(make)


def published_path(spark: SparkSession, root: str, name: str) -> str:
    """Where the newest publication of a table is to be read; ValueError if batches have been added to it (see
    :func:`open_published`)."""
    (path,) = open_published(spark, root).paths(name)
    return path
