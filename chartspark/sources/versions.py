"""Tables whose files never change: a log of versions says which folders a table consists of.

A writer puts new files into a folder of its own and then commits a version that names all folders of the table. A
version is a small file that appears in one step and is never replaced, so a reader that has opened one keeps reading it
while others write, a writer that breaks off leaves nothing but a folder that no version names, and of two writers that
want to commit the same version one is refused and starts again from the other's.
"""

import json
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from chartspark.operators.relate import same_keys
from chartspark.sources.storage import drop_now, read_text

VERSIONS, DATA = "_versions", "data"
#: Versions that stay readable after newer ones.
RETAINED = 3
#: Age in hours at which a folder that no version names belongs to a run that broke off, not to one that still writes.
ORPHAN_HOURS = 24.0
#: Marks of commits that a version remembers, the newest.
REMEMBERED = 10_000
#: Folders of a bucket that are made one when rows are added.
PARTS = 8


class Conflict(Exception):
    """Another writer has committed the version first."""


@dataclass
class Version:
    """``parts``: the folders of the table by part (a bucket, a day, a batch), relative to its root. ``applied``: marks of
    the commits whose rows it holds. ``facts``: what else the writer noted."""

    number: int = 0
    parts: dict[str, list[str]] = field(default_factory=dict)
    applied: list[str] = field(default_factory=list)
    facts: dict = field(default_factory=dict)


class Log:
    """The versions of what lies under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _system(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _names(self, folder: str) -> list[tuple[str, float]]:
        """(name, time of change in seconds) of what is in a folder."""
        system, path = self._system(), self._path(folder)
        if not system.exists(path):
            return []
        return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in system.listStatus(path)]

    def numbers(self) -> list[int]:
        return sorted(int(name) for name, _ in self._names(VERSIONS) if name.isdigit())

    def at(self, number: int) -> Version:
        text = read_text(self.spark, f"{self.root}/{VERSIONS}/{number:020}")
        if text is None:
            raise ValueError(f"version {number} of {self.root} is gone or was never there")
        return Version(**json.loads(text))

    def latest(self) -> Version:
        numbers = self.numbers()
        return self.at(numbers[-1]) if numbers else Version()

    def commit(self, version: Version) -> Version:
        """Add a version; :class:`Conflict` if there is one with its number."""
        system, draft = self._system(), self._path(f"{VERSIONS}/.{uuid.uuid4().hex}")
        version.applied = version.applied[-REMEMBERED:]
        out = system.create(draft)
        out.write(json.dumps(asdict(version)).encode())
        out.close()
        files = self.spark._jvm.org.apache.hadoop.fs
        context = files.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark._jvm.java.lang.reflect.Array.newInstance(
            self.spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1
        )
        options[0] = getattr(files, "Options$Rename").NONE  # refuses a target that is there
        target = self._path(f"{VERSIONS}/{version.number:020}")
        try:
            context.rename(system.makeQualified(draft), system.makeQualified(target), options)
        except Exception as error:
            system.delete(draft, False)
            if system.exists(target):
                raise Conflict(f"version {version.number} of {self.root} is there") from error
            raise
        return version

    def change(self, make: Callable[[Version], Version | None], attempts: int = 5) -> Version:
        """Commit what ``make`` makes of the latest version, once more from a newer one where another was first.

        ``make`` returns None where there is nothing to do.
        """
        for attempt in range(attempts):
            before = self.latest()
            after = make(Version(**asdict(before)))
            if after is None:
                return before
            after.number = before.number + 1
            try:
                return self.commit(after)
            except Conflict:
                if attempt == attempts - 1:
                    raise
        raise AssertionError

    def fresh(self) -> str:
        """A folder for a writer's files, relative to the root."""
        return f"{DATA}/{uuid.uuid4().hex}"

    def forget(self, folder: str) -> None:
        """Delete a folder of this writer that no version names, and the root where nothing else is in it."""
        drop_now(self.spark, f"{self.root}/{folder}")
        for path in (DATA, ""):
            target = self._path(path) if path else self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
            if len(self._system().listStatus(target)):
                return
            self._system().delete(target, False)

    def tidy(self, retained: int = RETAINED, orphan_hours: float = ORPHAN_HOURS) -> list[str]:
        """Delete all versions but the newest ``retained`` and the folders that none of these names.

        Folders of deleted versions go at once. Others that no version names are kept until they are ``orphan_hours`` old:
        a writer may still be at work in them. Returns the folders deleted.
        """
        numbers = self.numbers()
        keep, old = numbers[-retained:], numbers[:-retained]
        named = {_folder(p) for n in keep for paths in self.at(n).parts.values() for p in paths}
        outdated = {_folder(p) for n in old for paths in self.at(n).parts.values() for p in paths} - named
        limit = time.time() - orphan_hours * 3600
        gone = [name for name, changed in self._names(DATA) if name not in named and (name in outdated or changed <= limit)]
        # versions first: none may name what is not there
        for n in old:
            self._system().delete(self._path(f"{VERSIONS}/{n:020}"), False)
        for name in gone:
            drop_now(self.spark, f"{self.root}/{DATA}/{name}")
        return [f"{DATA}/{name}" for name in sorted(gone)]


def _folder(path: str) -> str:
    """The writer's folder that a path below ``data`` is in."""
    return path.split("/")[1]




class KeyedTable:
    """A Parquet table in buckets by a hash of its keys, in which the rows of some keys can be replaced.

    A change rewrites the buckets that hold one of its keys and takes the others over as they are. Buckets should hold
    what a task can sort: their number is chosen when the table is first written and stays. With the first rows come the
    keys, the number of buckets and the schema; later rows need the same columns.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], schema: str | StructType, buckets: int = 64):
        self.spark, self.keys, self.buckets = spark, list(keys), buckets
        self.log = Log(spark, root)
        self.schema = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema

    def _bucketed(self, rows: DataFrame, n: int) -> DataFrame:
        return rows.withColumn("_bucket", F.pmod(F.xxhash64(*(F.col(f"`{k}`") for k in self.keys)), F.lit(n)).cast("int"))

    def _read(self, version: Version, buckets: Iterable[str] | None = None) -> DataFrame:
        wanted = version.parts if buckets is None else {b: version.parts[b] for b in buckets if b in version.parts}
        paths = sorted(f"{self.log.root}/{p}" for parts in wanted.values() for p in parts)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version; without a number of the latest. The frame goes on reading that version."""
        return self._read(self.log.latest() if number is None else self.log.at(number))

    def exists(self) -> bool:
        return bool(self.log.numbers())

    def add(self, rows: DataFrame, mark: str | None = None) -> Version:
        """Add rows whose keys the table does not have: no file that is there is written again, until a bucket has
        ``PARTS`` of them and they are made one."""
        return self._change(rows, rows.select(*self.keys).distinct(), mark, new=True)

    def replace(self, rows: DataFrame, keys: DataFrame | None = None, mark: str | None = None, only: bool = False) -> Version:
        """Put ``rows`` in the place of all rows that have one of their keys, or one of ``keys``.

        Keys without old rows are added; keys in ``keys`` without new rows are deleted. NULL keys are equal. With a
        ``mark`` a change is made once: a second one with the same mark does nothing. With ``only``, all other rows go.
        Rows and keys should be stored, since they are read twice.
        """
        changed = rows.select(*self.keys) if keys is None else rows.select(*self.keys).union(keys.select(*self.keys))
        return self._change(rows, changed.distinct(), mark, only=only)

    def _change(self, rows: DataFrame, changed: DataFrame, mark: str | None, new: bool = False, only: bool = False) -> Version:
        rows = rows.select(*self.schema.names)

        def make(version: Version) -> Version | None:
            if mark is not None and mark in version.applied:
                return None
            n = version.facts.get("buckets", self.buckets)
            touched = [str(r[0]) for r in self._bucketed(changed, n).select("_bucket").distinct().collect()]  # at most n
            version.facts["buckets"] = n
            if mark is not None:
                version.applied.append(mark)
            if only:
                version.parts = {}
            full = [b for b in touched if b in version.parts and (not new or len(version.parts[b]) >= PARTS)]
            merged = rows
            if full:
                old = self._read(version, full)
                if not new:
                    old = old.alias("l").join(changed.alias("r"), same_keys(self.keys), "left_anti")
                merged = old.unionByName(rows)
            if touched:
                folder = self.log.fresh()
                stored = self._bucketed(merged, n).repartition(len(touched), "_bucket")
                stored.write.partitionBy("_bucket").parquet(f"{self.log.root}/{folder}")
                there = {name for name, _ in self.log._names(folder)}
                for bucket in touched:
                    kept = [] if bucket in full else version.parts.pop(bucket, [])
                    version.parts.pop(bucket, None)
                    if parts := [*kept, *([f"{folder}/_bucket={bucket}"] * (f"_bucket={bucket}" in there))]:
                        version.parts[bucket] = parts
            return version

        return self.log.change(make)

    def tidy(self, retained: int = RETAINED, orphan_hours: float = ORPHAN_HOURS) -> list[str]:
        return self.log.tidy(retained, orphan_hours)


def observed(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, Observation]:
    """The frame, and what a write of it will have seen: rows, and of each column NULLs, extremes and an estimate of
    different values. Columns that have no order have no extremes."""
    columns = df.columns if columns is None else list(columns)
    ordered = {f.name for f in df.schema if f.dataType.typeName() not in ("map", "variant", "array", "struct")}
    seen = Observation()
    measures = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        name = F.col(f"`{c}`")
        measures.append(F.count_if(name.isNull()).alias(f"nulls.{c}"))
        if c in ordered:
            measures += [
                F.min(name).cast("string").alias(f"least.{c}"),
                F.max(name).cast("string").alias(f"most.{c}"),
                F.approx_count_distinct(name).alias(f"different.{c}"),
            ]
    return df.observe(seen, *measures), seen


def statistics(seen: Observation) -> dict:
    """{"rows": n, "columns": {column: {"nulls", "least", "most", "different"}}} of a write that is done."""
    found = {"rows": 0, "columns": {}}
    for name, value in seen.get.items():
        if name == "rows":
            found["rows"] = value
        else:
            what, column = name.split(".", 1)
            found["columns"].setdefault(column, {})[what] = value
    return found


class PartedTable:
    """A table in parts that are replaced whole, such as days or batches: a part written again takes the old one's place."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.log = spark, Log(spark, root)

    def read(self, number: int | None = None, parts: Iterable[str] | None = None) -> DataFrame:
        """The rows of a version, or of some of its parts. The table has to have been written; its first rows give the
        schema."""
        return self._read(self.log.latest() if number is None else self.log.at(number), parts)

    def _read(self, version: Version, parts: Iterable[str] | None = None) -> DataFrame:
        if "schema" not in version.facts:
            raise ValueError(f"nothing was written to {self.log.root}")
        schema = StructType.fromJson(json.loads(version.facts["schema"]))
        names = version.parts if parts is None else [p for p in parts if p in version.parts]
        paths = sorted(f"{self.log.root}/{p}" for name in names for p in version.parts[name])
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def parts(self) -> list[str]:
        return sorted(self.log.latest().parts)

    def put(self, part: str, rows: DataFrame, mark: str | None = None) -> Version:
        """Write a part, new or in the place of the one of that name. A second change with the same mark does nothing."""
        if mark is not None and mark in self.log.latest().applied:
            return self.log.latest()
        return self._put(part, rows, mark)

    def _put(self, part: str, rows: DataFrame, mark: str | None = None, instead_of: dict[str, list[str]] | None = None) -> Version:
        folder, schema = self.log.fresh(), rows.schema.json()
        rows, seen = observed(rows)
        rows.write.parquet(f"{self.log.root}/{folder}")
        noted = statistics(seen)

        def make(version: Version) -> Version | None:
            if mark is not None and mark in version.applied:
                return None
            for gone, paths in (instead_of or {}).items():
                if version.parts.pop(gone, None) != paths:
                    raise ValueError(f"part {gone} of {self.log.root} was written while it was merged")
                version.facts.get("statistics", {}).pop(gone, None)
            version.parts[part] = [folder]
            version.facts.setdefault("schema", schema)
            version.facts.setdefault("statistics", {})[part] = noted
            if mark is not None:
                version.applied.append(mark)
            return version

        return self.log.change(make)

    def merge(self, parts: Sequence[str], into: str, how: Callable[[DataFrame], DataFrame]) -> Version:
        """Put ``how`` of the rows of some parts in their place, as the part ``into`` (which may be one of them).

        ValueError if one of the parts is written meanwhile: the table stays as it is then.
        """
        version = self.log.latest()
        taken = {p: version.parts[p] for p in parts if p in version.parts}
        return self._put(into, how(self._read(version, taken)), instead_of=taken) if taken else version

    def statistics(self) -> dict[str, dict]:
        """What the writes of the parts have seen."""
        return self.log.latest().facts.get("statistics", {})

    def tidy(self, retained: int = RETAINED, orphan_hours: float = ORPHAN_HOURS) -> list[str]:
        return self.log.tidy(retained, orphan_hours)
