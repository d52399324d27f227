"""A stream of rows added to a published table as documents, each batch once."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from chartspark.sources.documents import append_documents
from chartspark.streaming.ingest import FILES_PER_TRIGGER


def index_stream(
    spark: SparkSession,
    source: str,
    schema: str,
    root: str,
    name: str,
    checkpoint: str,
    source_format: str = "parquet",
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    files_per_trigger: int = FILES_PER_TRIGGER,
    interval: str | None = None,
) -> StreamingQuery:
    """Start adding the rows of all new files at ``source`` to the table ``name`` published under ``root``.

    A batch that is run again, since the stream broke off after its files were written and before the checkpoint knew of
    it, is recognised by its number and adds nothing. The checkpoint's path is the stream's name. Without an ``interval``
    the query takes what is there and ends.
    """

    def add(batch: DataFrame, number: int) -> None:
        append_documents(transform(batch), root, name, checkpoint, number)

    reader = spark.readStream.format(source_format).schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    writer = reader.load(source).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    return writer.start()
