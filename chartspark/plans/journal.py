"""What a run has done, so that one that breaks off goes on at the stage that broke."""

import hashlib
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from chartspark.sources.storage import read_text, write_text
from chartspark.sources.versions import VERSIONS


def fingerprint(spark: SparkSession, path: str) -> str | None:
    """A text that changes when a table is written: of a table with versions its versions, else of its files their names,
    sizes and times. None if there is nothing."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return None
    versions = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{VERSIONS}")
    files = system.listFiles(versions if system.exists(versions) else target, True)
    found = []
    while files.hasNext():
        status = files.next()
        found.append(f"{status.getPath().toUri().getPath()} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


@dataclass
class Journal:
    """The stages that the run called ``run`` has finished, one small file each under ``folder``.

    A stage counts as finished while the tables it has read and written are as it left them; so a stage is done again if
    one before it was, or if somebody else has written one of its tables.
    """

    spark: SparkSession
    folder: str
    run: str
    done: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)

    def _path(self, stage: str) -> str:
        return f"{self.folder}/{self.run}/{stage}"

    def _prints(self, paths: Sequence[str]) -> dict[str, str | None]:
        return {path: fingerprint(self.spark, path) for path in paths}

    def stage(self, name: str, action: Callable[[], object], reads: Sequence[str] = (), writes: Sequence[str] = ()) -> None:
        """Run a stage unless this run has finished it. ``reads`` and ``writes`` are paths; a table that a stage both reads
        and writes is among ``writes`` only."""
        noted = read_text(self.spark, self._path(name))
        if noted is not None and json.loads(noted) == {"reads": self._prints(reads), "writes": self._prints(writes)}:
            self.skipped.append(name)
            return
        before = self._prints(reads)
        action()
        write_text(self.spark, self._path(name), json.dumps({"reads": before, "writes": self._prints(writes)}))
        self.done.append(name)
