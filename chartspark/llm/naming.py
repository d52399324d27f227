"""Exact deduplication by block naming: equal texts get one integer, found by sorting fixed-size blocks."""

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from chartspark.llm.common import SPACE, numbered, whole
from chartspark.sources.storage import materialise

#: Bytes of a block. One row of a shuffle holds one block, however long a text is.
BLOCK_BYTES = 4096


def salts_for(rows: int) -> int:
    """Parts into which the rows of one content are dealt: the square root of their number, so that neither a part nor
    the number of parts is large."""
    return max(16, math.isqrt(rows))


def name_contents(rows: DataFrame, content: list[str], salts: int) -> DataFrame:
    """Replace the columns ``content`` by ``name``: an integer that rows share exactly if their contents are equal.

    ``rows`` has an integer ``occ`` of its own in every row; the smallest one among equal contents is their name. The
    rows are sorted by content twice. The first sort deals the copies of a content into ``salts`` parts, so that a
    content with a third of all rows is spread over many tasks; of each part one row goes into the second sort. There
    a content has at most ``salts`` rows. The other copies carry numbers only and look the name up.
    """
    rest = [c for c in rows.columns if c not in content and c != "occ"]
    part = F.pmod(F.xxhash64("occ"), F.lit(salts))
    first = rows.withColumn("part", part).withColumn("first", F.min("occ").over(Window.partitionBy(*content, "part")))
    copy = F.col("first") != F.col("occ")
    # a copy needs its content no more: it is a group of its own in the second sort
    once = first.select(
        "occ", "first", *rest, *(F.when(~copy, F.col(c)).alias(c) for c in content), F.when(copy, F.col("occ")).alias("own")
    )
    named = materialise(
        once.withColumn("name", F.min("first").over(Window.partitionBy(*content, "own"))).drop(*content, "own")
    )
    leaders = named.filter(~copy)
    copies = named.filter(copy).drop("name").join(leaders.select("first", "name"), "first")
    return leaders.select(*rest, "name").unionByName(copies.select(*rest, "name"))


def _blocks(data: Column, size: int) -> Column:
    last = F.floor((F.greatest(F.octet_length(data), F.lit(1)) - 1) / size).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(data, i * size + 1, F.lit(size)))


def document_names(docs: DataFrame, data: str, carried: list[str], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row, *carried, level, name): rows have equal ``data`` (binary) exactly if level and name are equal.

    Level 0 names the blocks of all documents. Every further level names pairs of adjacent names, so the documents with
    more than one name left get half as many, until each has one. A document ends at level ceil(log2(its blocks)), and
    an odd last name is paired with NULL, so texts of different lengths never share level and name.
    """
    blocks = docs.select("row", F.struct(*carried).alias("facts"), _blocks(F.col(data), block_bytes).alias("blocks"))
    occurrences = blocks.select("row", "facts", F.posexplode("blocks").alias("pos", "block")).select(
        F.monotonically_increasing_id().alias("occ"),
        "row",
        "pos",
        F.when(F.col("pos") == 0, F.col("facts")).alias("facts"),
        "block",
    )
    done, level = None, 0
    named = name_contents(occurrences, ["block"], salts_for(docs.count()))
    while True:
        names = F.transform(F.sort_array(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"])
        facts = F.first("facts", ignorenulls=True)  # of the one block that has them
        arrays = materialise(named.groupBy("row").agg(names.alias("names"), facts.alias("facts")))
        finished = arrays.filter(F.size("names") == 1).select(
            "row", "facts.*", F.lit(level).alias("level"), F.col("names")[0].alias("name")
        )
        done = finished if done is None else done.unionByName(finished)
        open_ = arrays.filter(F.size("names") > 1)
        left = open_.count()
        if not left:
            return done
        half = ((F.size("names") - 1) / 2).cast("int")
        pairs = F.transform(
            F.sequence(F.lit(0), half),
            lambda i: F.struct(F.get("names", i * 2).alias("a"), F.get("names", i * 2 + 1).alias("b")),
        )
        occurrences = open_.select("row", "facts", F.posexplode(pairs).alias("pos", "pair")).select(
            F.monotonically_increasing_id().alias("occ"),
            "row",
            "pos",
            F.when(F.col("pos") == 0, F.col("facts")).alias("facts"),
            "pair.a",
            "pair.b",
        )
        named, level = name_contents(occurrences, ["a", "b"], salts_for(left)), level + 1


def exact_dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, row: str | None = None
) -> DataFrame:
    """Groups of documents with equal text, and the one that stays.

    Texts are equal when they are identical after deleting white space (``[\\x20\\x09-\\x0D]``). Of equal texts the one
    with the most code points stays, then the smallest key; NULL keys come last, and of rows equal in both the first in
    the table. A NULL text counts as empty. ``docs`` is a stored table (see :func:`~chartspark.llm.common.numbered`);
    ``row`` names its column of row numbers, if it has one.

    Returns a row for every row of ``docs``: row (its number), key, keep_key, group_size, kept, text_sha256 (of the
    text without white space). An empty table gives an empty result; other columns of ``docs`` are not looked at.
    """
    squeezed = F.regexp_replace(whole(F.col(text)), f"[{SPACE}]+", "").cast("binary")
    texts = numbered(docs, F.col(key).alias("key"), F.char_length(whole(F.col(text))).alias("points"), squeezed.alias("data"), row=row)
    texts = texts.withColumn("sha", F.unhex(F.sha2("data", 256)))
    named = materialise(document_names(texts, "data", ["key", "points", "sha"], block_bytes))
    best = F.min(F.struct(-F.col("points"), F.col("key").isNull(), F.col("key"), F.col("row")))
    groups = materialise(
        named.groupBy("level", "name")
        .agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
        .select("level", "name", "group_size", F.col("best.key").alias("keep_key"), F.col("best.row").alias("keep_row"))
    )
    return named.join(groups, ["level", "name"]).select(
        "row",
        "key",
        "keep_key",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
