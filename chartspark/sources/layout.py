"""How the files of a table are laid out, so that later jobs read less and shuffle less of it."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from chartspark.sources.storage import drop_at_exit, fresh_path

#: A key with more than this multiple of a bucket's even share of the rows keeps a table from being bucketed: one task reads
#: a bucket.
MOST_OF_A_BUCKET = 4.0
#: Rows that one task sorts and writes: about 120 MB of a formatted chart in the shuffle before it.
ROWS_PER_PART = 1_000_000


def largest_share(df: DataFrame, keys: Sequence[str]) -> float:
    """The share of the rows that the most frequent key has; 0 without rows."""
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
    return found[0] / found[1] if found[1] else 0.0


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, name: str) -> bool:
    """Write a Parquet table in sorted buckets by the keys and enter it in the session's catalogue as ``name``.

    Joins and aggregates on the keys (or on more columns) then need no shuffle of it. The rows are shuffled once, by the
    same hash, so a bucket is one file. A key with far more rows than a bucket should have would be one long task ever
    after: then nothing is written, and False is returned.
    """
    if largest_share(df, keys) * buckets > MOST_OF_A_BUCKET:
        return False
    spread = df.repartition(buckets, *keys)
    spread.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(name)
    return True


def open_bucketed(spark: SparkSession, path: str, schema: str, keys: Sequence[str], buckets: int, name: str) -> DataFrame:
    """A bucketed table written by another session: it is entered in this one's catalogue, and nothing is read."""
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS "
        f"LOCATION '{path}'"
    )
    return spark.table(name)


def parts_for(rows: int, least: int = 1) -> int:
    """The number of parts for so many rows: it grows with them, so that a part does not."""
    return max(least, -(-rows // ROWS_PER_PART))


def clustered(df: DataFrame, *columns: str, parts: int | None = None) -> DataFrame:
    """The rows in parts by ranges of the columns, sorted in each: files written from it hold narrow ranges, and a filter on
    the first column skips most files and row groups by the extremes that Parquet keeps.

    A value that many rows have is dealt to several parts.
    """
    deal = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns if c not in columns)) if len(df.columns) > len(columns) else F.lit(0)
    by = [*(F.col(f"`{c}`") for c in columns), deal]
    spread = df.repartitionByRange(*by) if parts is None else df.repartitionByRange(parts, *by)
    return spread.sortWithinPartitions(*by[: len(columns)])


def stored_clustered(df: DataFrame, *columns: str, parts: int | None = None) -> DataFrame:
    """The rows, written in the order of :func:`clustered` to the shared folder until the driver ends."""
    path = fresh_path(df.sparkSession, "clustered")
    clustered(df, *columns, parts=parts).write.parquet(path)
    drop_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
