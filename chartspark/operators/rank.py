"""Order within groups: top n, the row that stands for a group, gaps to the next release, id batches."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chartspark.fixed_values import LOOKUP_BATCH
from chartspark.sources.storage import materialise

#: Up to this n Spark cuts every input partition to n rows a group before the shuffle.
CUT_BEFORE_SHUFFLE = 1000
SALTS = 256


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group, numbered.

    Spark cuts every input partition to n rows a group before the shuffle, for n up to the default of
    ``spark.sql.optimizer.windowGroupLimitThreshold``. For more a group is first cut in parts, dealt by a hash of the
    rows, so that a hot group is not one task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    if n > CUT_BEFORE_SHUFFLE:
        parts = Window.partitionBy(*group, "_part").orderBy(*order)
        df = (
            df.withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
            .withColumn("_place", F.row_number().over(parts))
            .filter(F.col("_place") <= n)
            .drop("_part", "_place")
        )
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def nulls_last(*columns: str) -> list[Column]:
    """Struct fields that order by the columns with NULL as the largest value."""
    fields = []
    for i, c in enumerate(columns):
        fields += [F.col(c).isNull().alias(f"_null_{i}"), F.col(c).alias(f"_key_{i}")]
    return fields


def first_row(columns: Sequence[str], order: Sequence[str]) -> Column:
    """Aggregate: the columns of the group's first row by ``order``, as field ``row`` of a struct.

    All values come from one row, NULLs included. Rows equal in ``order`` are told apart by the columns
    themselves. The minimum of minima is the overall minimum, so this can be applied again to its own results.
    """
    return F.min(F.struct(*nulls_last(*order), F.struct(*columns).alias("row")))


def head_rows(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    if n < 0:
        raise ValueError("n must not be negative")
    return df.orderBy(*order).limit(n)


def sorted_rows(df: DataFrame, *order: Column | str) -> DataFrame:
    """Sort, by the whole row where ``order`` ties. Copies of a row are counted before the sort and made again after it."""
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_copies")).orderBy(*order, F.struct(*df.columns))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))).alias("_copy")
    return counted.select(*df.columns, copies).drop("_copy")


def _placed(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """The rows, sorted over the cluster and stored with the number of their sorted part and their place in it."""
    return materialise(
        df.orderBy(*order).withColumns(
            {"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}
        )
    )


def numbered_rows(df: DataFrame, order: Sequence[Column | str], out: str = "number") -> DataFrame:
    """Number all rows from 1 in an order that tells them apart, without a task that sees them all.

    The rows are sorted over the cluster and stored with their place in the sorted part; the sizes of the parts before it
    give the rest. Only these sizes, one for each part, meet in one task.
    """
    stored = _placed(df, order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("_part").agg(F.count("*").alias("_size"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return (
        stored.join(offsets, "_part").withColumn(out, F.col("_before") + F.col("_place") + 1).drop("_part", "_place", "_before")
    )


def all_ranked(df: DataFrame, group: Sequence[str], order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """All rows of each group, numbered from 1 in an order that tells them apart; a hot group is no task of its own.

    The rows are sorted over the cluster by group and order and stored once. A group lies in one part or in several that
    follow one another: where it begins in a part, and how many of its rows the parts before hold, is a row for each part
    and group, and all that the rank needs besides a row's place. Groups are not NULL.
    """
    stored = _placed(df, [*group, *order])
    sizes = stored.groupBy("_part", *group).agg(F.count("*").alias("_size"), F.min("_place").alias("_begin"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("_size").over(before), F.lit(0))
    offsets = sizes.select("_part", *group, (earlier - F.col("_begin") + 1).alias("_add"))
    return (
        stored.join(offsets, ["_part", *group])
        .withColumn(rank, F.col("_place") + F.col("_add"))
        .select(*df.columns, rank)
    )


def next_dates(df: DataFrame, creator: str, date: str) -> DataFrame:
    """Per creator and release date: the number of releases and the next later date.

    Rows are counted per date before the window, so it sees at most one row per calendar day, however many
    releases a creator has.
    """
    dated = df.select(creator, F.col(date).cast("date").alias(date)).filter(F.col(date).isNotNull())
    per_date = dated.groupBy(creator, date).agg(F.count("*").alias("n_releases"))
    window = Window.partitionBy(creator).orderBy(date)
    return per_date.withColumn("next_date", F.lead(date).over(window))


def average_release_gap(df: DataFrame, creator: str, date: str, out: str) -> DataFrame:
    """Per creator: the average number of months from a release to the next one.

    Of the releases of one day all but the last are followed by a release of the same day, a gap of 0.
    """
    gap = F.months_between("next_date", date)
    followed = F.sum("n_releases") - F.count_if(F.col("next_date").isNull())
    return (
        next_dates(df, creator, date)
        .groupBy(creator)
        .agg(F.try_divide(F.coalesce(F.sum(gap), F.lit(0.0)), followed).alias(out))
    )


def with_release_gap(
    df: DataFrame, creator: str, date: str, tiebreak: str, out: str = "months_to_next_release"
) -> DataFrame:
    """Add the months from each release to the creator's next one; NULL for the last.

    ``date`` has to be a date, and ``tiebreak``, which orders the releases of one day, has to differ between them.
    """
    last = (
        df.filter(F.col(date).isNotNull())
        .groupBy(creator, date)
        .agg(F.max(tiebreak).alias("_last"))
        .withColumn("_next", F.lead(date).over(Window.partitionBy(creator).orderBy(date)))
        .withColumnsRenamed({creator: "_creator", date: "_date"})
    )
    following = F.when(F.col(tiebreak) == F.col("_last"), F.col("_next")).otherwise(F.col(date))
    return (
        df.join(last, F.col(creator).eqNullSafe(F.col("_creator")) & (F.col(date) == F.col("_date")), "left")
        .withColumn(out, F.months_between(following, date))
        .drop("_creator", "_date", "_last", "_next")
    )


def id_batches(df: DataFrame, id_column: str, size: int = LOOKUP_BATCH) -> DataFrame:
    """The distinct ids in order, in batches of ``size`` joined by commas, for bulk lookups; only the last is shorter."""
    ids = df.select(F.col(id_column).cast("string").alias("id")).filter(F.col("id").isNotNull()).distinct()
    batch = F.floor((F.col("number") - 1) / size).alias("batch")
    return numbered_rows(ids, ["id"]).groupBy(batch).agg(
        F.array_join(F.array_sort(F.collect_list("id")), ",").alias("ids"), F.count("*").alias("n_ids")
    )


def pick_candidate(
    df: DataFrame, group: Sequence[str], order: Sequence[str], columns: Sequence[str], clean: Column
) -> DataFrame:
    """Per group of candidate rows: the first clean one by ``order``, else the last."""
    place = F.struct(*nulls_last(*order))
    row = F.struct(*columns)
    return (
        df.groupBy(*group)
        .agg(
            F.min_by(F.when(clean, row), F.when(clean, place)).alias("_clean"),
            F.max_by(row, place).alias("_last"),
        )
        .select(*group, F.coalesce("_clean", "_last").alias("_row"))
        .select(*group, "_row.*")
    )
