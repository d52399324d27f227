"""A session with the settings the operators are tuned for."""

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from chartspark.sources.storage import drop_at_exit, fresh_path

# Adaptive execution only merges shuffle partitions, so a session starts with many unless the caller sets their number:
# about two to three per core for local runs, on a cluster the largest shuffle over 128 MB.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
}


INITIAL_PARTITIONS = "4096"


def build_session(name: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master is not None:
        builder = builder.master(master)
    if "spark.sql.shuffle.partitions" not in settings:
        settings = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": INITIAL_PARTITIONS, **settings}
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever they run: it is added to the session as a zip file, once."""
    context = spark.sparkContext
    if getattr(context, "chartspark_shipped", False):
        return
    package = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    where = f"{fresh_path(spark, 'code')}.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(where)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(packed.getvalue())
    out.close()
    drop_at_exit(spark, where)
    context.addPyFile(where)
    context.chartspark_shipped = True
