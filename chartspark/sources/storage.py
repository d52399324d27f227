"""Reading and writing tables, and the shared folder for intermediate results."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate results, which all executors reach.

    It is the one named by ``spark.checkpoint.dir`` or set on the context; where neither is, a folder in the warehouse. A
    warehouse on a machine's own disk will not do for executors on others: ValueError.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.sparkContext.master.startswith("local") and _on_one_machine(spark, warehouse):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return f"{warehouse}/_shared"


def _on_one_machine(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/chartspark/{name}-{uuid.uuid4().hex}"


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Have the driver delete the path when its JVM ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


def drop_now(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; one that is there is replaced in one step."""
    system = spark._jvm.org.apache.hadoop.fs
    target, draft = system.Path(path), system.Path(f"{path}.{uuid.uuid4().hex}")
    context = system.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(draft)
    out.write(text.encode())
    out.close()
    options = spark._jvm.java.lang.reflect.Array.newInstance(spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
    options[0] = getattr(system, "Options$Rename").OVERWRITE
    context.rename(files.makeQualified(draft), files.makeQualified(target), options)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


#: Paths that the frames made inside a :func:`scratch` are stored at; the innermost scope comes last.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A scope for what is stored on the way to a result: everything that :func:`materialise` stores in it is deleted at its
    end, so the result has to be written by then. A long session needs no more room than its largest scope."""
    paths: list[str] = []
    token = _scopes.set((*_scopes.get(), paths))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in paths:
            drop_now(spark, path)


def materialise(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them from there: the plan before it is not run again.

    The files outlive the call, since the frame returned is lazy: they are deleted at the end of the :func:`scratch` around
    the call, or when the driver ends.
    """
    path = fresh_path(df.sparkSession, "table")
    df.write.parquet(path)
    if _scopes.get():
        _scopes.get()[-1].append(path)
    drop_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame, path: str) -> DataFrame:
    """Write the rows to a path, which no scope deletes, and read them from there."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Read Parquet. A missing path raises."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_if_exists(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read Parquet, or give an empty table of the schema where there is none yet."""
    return read_table(spark, path, schema) if exists(spark, path) else spark.createDataFrame([], schema)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: str | None = None,
    compression: str = "snappy",
) -> tuple[int, int]:
    """Write Parquet and return the numbers of rows and columns, counted by the write itself."""
    observed = Observation()
    writer = df.observe(observed, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.option("compression", compression).parquet(path)
    return observed.get["rows"], len(df.columns)
