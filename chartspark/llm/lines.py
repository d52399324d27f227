"""Line deduplication by overlapping windows of three lines."""

from pyspark.sql import DataFrame, functions as F

from chartspark.llm.common import numbered, stored_rows, whole
from chartspark.sources.storage import materialise

WINDOW_LINES = 3


def window_names(docs: DataFrame, key: str, text: str, size: int = WINDOW_LINES, row: str | None = None) -> DataFrame:
    """(row, key, pos, a, b): every window of ``size`` lines with a hash of 128 bits, of its first line's place."""
    lines = F.split(whole(F.col(text)), "\n", -1)
    hashed = numbered(
        docs,
        F.col(key).alias("key"),
        F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"))).alias("lines"),
        row=row,
    ).filter(F.size("lines") >= size)
    windows = F.transform(
        F.sequence(F.lit(0), F.size("lines") - size),
        lambda i: F.struct(
            F.xxhash64(*(F.get("lines", i + k)["a"] for k in range(size))).alias("a"),
            F.xxhash64(*(F.get("lines", i + k)["b"] for k in range(size))).alias("b"),
        ),
    )
    return hashed.select("row", "key", F.posexplode(windows).alias("pos", "window")).select("row", "key", "pos", "window.*")


def line_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW_LINES) -> DataFrame:
    """Remove lines that repeat, in the same or another document, as part of the same ``size`` consecutive lines.

    Lines end at ``\\n``. Every window of ``size`` lines is hashed; of windows that are equal anywhere in the table, the
    first by (key, place in the table, line) stays and the others' lines go. Overlapping windows are merged, so a
    removed passage is one stretch. Each removed line has an equal one at an earlier place that stays. Documents with
    fewer lines have no window and stay as they are; so does an empty text. NULL text counts as empty, NULL keys come
    after all others. ``docs`` is a stored table.

    Returns row, key, text (what is left), n_lines, removed (array of the places of the removed lines, from 0), one row
    for every row of ``docs``. Rows are found again by numbers that stay (see
    :func:`~chartspark.llm.common.stored_rows`). Hot windows are counted before the shuffle; the look-up that marks the
    repeats joins two stored tables, so that adaptive execution splits a window that very many documents share.
    """
    docs, number = stored_rows(docs)
    docs = docs.select(F.col(key).alias("key"), whole(F.col(text)).alias("text"), number)
    windows = materialise(window_names(docs, "key", "text", size, number))
    place = F.struct(F.col("key").isNull().alias("no_key"), "key", "row", "pos")
    repeated = materialise(
        windows.groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("first"))
        .filter("times > 1")
        .select("a", "b", F.col("first.row").alias("first_row"), F.col("first.pos").alias("first_pos"))
    )
    later = windows.join(repeated, ["a", "b"]).filter(
        (F.col("row") != F.col("first_row")) | (F.col("pos") != F.col("first_pos"))
    )
    covered = (
        later.groupBy("row")
        .agg(F.collect_set("pos").alias("starts"))
        .select(
            "row",
            F.array_sort(
                F.array_distinct(
                    F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (size - 1))))
                )
            ).alias("removed"),
        )
    )
    texts = numbered(docs, F.col("key"), F.col("text"), row=number)
    lines = F.split("text", "\n", -1)
    none = F.array().cast("array<int>")
    return texts.join(covered, "row", "left").select(
        "row",
        "key",
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(_without(lines, F.col("removed"))).alias("text"),
        F.size(lines).alias("n_lines"),
        F.coalesce("removed", none).alias("removed"),
    )


def _without(lines, removed):
    """The lines outside the sorted places, joined again: the stretches between neighbouring removed places."""
    ends = F.concat(removed, F.array(F.size(lines)))
    starts = F.concat(F.array(F.lit(-1)), removed)
    kept = F.transform(
        F.arrays_zip(starts.alias("s"), ends.alias("e")),
        lambda x: F.slice(lines, x["s"] + 2, x["e"] - x["s"] - 1),
    )
    return F.array_join(F.flatten(kept), "\n")
