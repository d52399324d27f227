"""Helpers shared by the operators."""

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chartspark.session import ship_package
from chartspark.sources.storage import materialise

SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; NULL keys are in fold -1, which every learner may use."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts, F.lit(-1))


def whole(text: Column) -> Column:
    """The text; NULL counts as empty."""
    return F.coalesce(text, F.lit(""))


def under(hashed: Column, share: float) -> Column:
    """Is a 64-bit hash among the given share of all its values, from the smallest on? No share is rounded to none."""
    if share >= 1:
        return F.lit(True)
    return hashed < F.lit(max(1, int(share * 2**64)) - 2**63).cast("long")


def numbered(docs: DataFrame, *columns: Column, row: str | None = None) -> DataFrame:
    """The columns and ``row``, a number for every row of a stored table.

    The number follows from the file split and the place in it, so a task that is run again gives the same numbers; a
    later read can be split in another way, and gives others. Where rows have to be found again, they are given numbers
    that stay first (:func:`stored_rows`), and ``row`` is the column that has them. A frame whose row order can
    change (after a shuffle) has to be stored before.
    """
    return docs.select((F.monotonically_increasing_id() if row is None else F.col(row)).alias("row"), *columns)


#: Bits of a row number that are the row's place in its file.
PLACE_BITS = 28


def stored_rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows of a stored table with a number each, and the name of the column that has it.

    A table that is read as it is gets its numbers from the files' names and the rows' places in them, which no split of
    the files changes, so nothing is written. Other frames are written once more, with numbers.
    """
    number = unused(docs, "_row")
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        file, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
        sizes = docs.groupBy(file.alias("file")).agg(F.max(place).alias("last"))
        if not sizes.filter(F.col("last") >= 1 << PLACE_BITS).limit(1).count():
            for seed in range(8):
                name = F.pmod(F.xxhash64(F.lit(seed), file), F.lit(1 << 63 - PLACE_BITS))
                of_file = sizes.select(F.pmod(F.xxhash64(F.lit(seed), "file"), F.lit(1 << 63 - PLACE_BITS)).alias("name"))
                if not of_file.groupBy("name").count().filter("count > 1").limit(1).count():  # no two files have a name
                    return docs.withColumn(number, name * (1 << PLACE_BITS) + place), number
    return materialise(docs.withColumn(number, F.monotonically_increasing_id())), number


def unused(docs: DataFrame, stem: str) -> str:
    """A column name that the frame does not have (names are compared without case)."""
    taken = {name.lower() for name in docs.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def rows_only(docs: DataFrame, number: str, rows: DataFrame) -> DataFrame:
    """The rows of a frame of :func:`stored_rows` whose number is not in ``rows`` (column ``row``), without the number."""
    gone = rows.select(F.col("row").alias(number))
    return docs.join(gone, number, "left_anti").drop(number)


def portions(batches, column: str, size: int = 2 << 20):
    """The batches in parts with texts of about ``size`` bytes; a longer text is in a part of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        begin, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if i > begin and held + n > size:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += n
        if begin < batch.num_rows:
            yield batch.slice(begin)


def in_arrow(rows: DataFrame, function, schema) -> DataFrame:
    """``rows.mapInArrow`` with a function of this package."""
    ship_package(rows.sparkSession)
    return rows.mapInArrow(function, schema)
