"""Continuous ingest: new files of rows are stamped and appended to a table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery


#: Files of a micro-batch: a backlog is worked off in steps, each of which can be restarted.
FILES_PER_TRIGGER = 1000


def stamp_rows(df: DataFrame, out: str = "ingested_at") -> DataFrame:
    """Add the time of the micro-batch."""
    return df.withColumn(out, F.current_timestamp())


def append_stream(
    spark: SparkSession,
    source: str,
    schema: str,
    sink: str,
    checkpoint: str,
    source_format: str = "parquet",
    sink_format: str = "parquet",
    transform: Callable[[DataFrame], DataFrame] = stamp_rows,
    files_per_trigger: int = FILES_PER_TRIGGER,
    interval: str | None = None,
) -> StreamingQuery:
    """Start appending the rows of all new files at ``source`` to ``sink``.

    A micro-batch takes up to ``files_per_trigger`` files. Without an ``interval`` the query takes what is there, in as
    many batches as needed, and ends. The
    checkpoint and the file sink's log give each row exactly once, also after a restart.
    """
    reader = spark.readStream.format(source_format).schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    writer = (
        transform(reader.load(source))
        .writeStream.format(sink_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", sink)
    )
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    return writer.start()
