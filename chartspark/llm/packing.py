"""Packing documents into sequences of a fixed number of tokens by the sum-of-squares rule."""

import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chartspark.llm.common import in_arrow, numbered, whole
from chartspark.llm.tokens import encoder
from chartspark.session import ship_package
from chartspark.sources.storage import materialise

CAPACITY = 2048
#: Pieces that one task packs, about. More leave less room unused.
SHARD = 10_000
#: A sequence with more room left than this share of the capacity is opened again in the second round.
ROOM = 1 / 64


def pieces_of(docs: DataFrame, path: str, key: str, text: str, capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """(row, key, piece, start, length, ids_crc32): the documents' token ids, ``end`` appended, cut where longer.

    All pieces of a document but the first are full. ``ids_crc32`` is of the ids as little-endian unsigned 32-bit
    numbers.
    """

    def cut(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, stop = encoder(path).encode, np.array([end], "<u4").tobytes()
        for batch in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                ids = encode(text.as_py()) + stop
                n = len(ids) // 4
                begin, k = 0, 0
                while begin < n:
                    stop_at = begin + (n - begin - 1) % capacity + 1
                    at.append(i)
                    piece.append(k)
                    start.append(begin)
                    length.append(stop_at - begin)
                    crc.append(zlib.crc32(memoryview(ids)[4 * begin : 4 * stop_at]))
                    begin, k = stop_at, k + 1
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").take(take),
                    batch.column("key").take(take),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["row", "key", "piece", "start", "length", "ids_crc32"],
            )

    rows = numbered(docs, F.col(key).alias("key"), whole(F.col(text)).alias("text"))
    schema = rows.drop("text").schema
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long")):
        schema = schema.add(name, kind)
    return in_arrow(rows, cut, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every item. The longest items come first.

    Of the open bins that have room, an item goes where the squares of the numbers of open bins with equal room add up
    to the least afterwards: taking a bin with room g from n(g) and giving one with g - s to n(g - s) changes the sum by
    2 (n(g - s) - n(g)) + 2; filling a bin changes it by 1 - 2 n(g). Ties go to the least room. A bin is opened only
    if no open one has room.
    """
    count = np.zeros(capacity + 1, np.int64)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    used = 0
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        rooms = np.flatnonzero(count[s:capacity]) + s
        if len(rooms):
            change = 2 * (count[rooms - s] - count[rooms]) + 2
            if rooms[0] == s:
                change[0] = 1 - 2 * count[s]
            room = int(rooms[np.argmin(change)])
            count[room] -= 1
            bin_ = open_[room].pop()
        else:
            room, bin_, used = capacity, used, used + 1
        bins[i], offsets[i] = bin_, capacity - room
        if room > s:
            count[room - s] += 1
            open_[room - s].append(bin_)
    return bins, offsets


def _packed(shards: DataFrame, tasks: int, capacity: int) -> DataFrame:
    """(shard, item, length) with the place of each item: shard, item, length, bin, offset. A shard is many rows of few
    bytes, so the number of tasks is given: by their bytes shards would be merged into a few."""

    ship_package(shards.sparkSession)

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("item", kind="stable")
        bins, offsets = sum_of_squares(rows["length"].to_numpy(), capacity)
        return rows.assign(bin=bins, offset=offsets)

    return shards.repartition(tasks, "shard").groupBy("shard").applyInPandas(pack, "shard long, item long, length long, bin long, offset long")


def _dealt(items: DataFrame, n: int, shard: int) -> tuple[DataFrame, int]:
    """The items with a shard each, and the number of shards."""
    shards = max(1, -(-n // shard))
    return items.select(F.pmod(F.xxhash64("item"), F.lit(shards)).alias("shard"), "item", "length"), shards


def best_fit_packing(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    shard: int = SHARD,
) -> DataFrame:
    """Where each piece of each document goes: row, key, piece, start, length, ids_crc32, sequence_id, offset.

    Documents are encoded by the tokenizer file, id 0 is appended, and only longer ones than ``capacity`` are cut. Full
    pieces are sequences of their own. The others, one of a document at most, are packed by :func:`sum_of_squares` in
    shards of about ``shard`` pieces, dealt by a hash of their number, so that a task holds a bounded number of small
    rows. Each shard leaves a few sequences with room; those of all shards are packed once more as items of their
    filled length, in shards again. Sequence ids are any numbers; offsets are gapless from 0.

    A NULL or empty text is the one token 0. Equal rows are packed each on its own. An empty table gives an empty
    result. ``docs`` is a stored table.
    """
    pieces = materialise(pieces_of(docs, tokenizer, key, text, capacity))
    part = F.col("length") < capacity
    items = pieces.filter(part).select(F.col("row").alias("item"), "length")
    packed = materialise(_packed(*_dealt(items, items.count(), shard), capacity))
    # a sequence of the first round is (shard, bin)
    number = F.col("shard") * (1 << 31) + F.col("bin")
    filled = packed.groupBy(number.alias("item")).agg(F.sum("length").alias("length"))
    again = materialise(filled.filter(F.col("length") <= capacity * (1 - ROOM)))
    moved = _packed(*_dealt(again, again.count(), shard), capacity).select(
        F.col("item").alias("first"), "shard", "bin", F.col("offset").alias("shift")
    )
    placed = (
        packed.select(F.col("item").alias("row"), number.alias("first"), "offset")
        .join(materialise(moved), "first", "left")
        .select(
            "row",
            # two kinds of packed sequences and the full ones have numbers of their own
            F.when(F.col("shard").isNull(), F.col("first") * 4).otherwise((F.col("shard") * (1 << 31) + F.col("bin")) * 4 + 1).alias("sequence_id"),
            (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
        )
    )
    columns = ["row", "key", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    full = pieces.filter(~part).select(
        "*", (F.monotonically_increasing_id() * 4 + 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return full.select(*columns).unionByName(pieces.filter(part).join(placed, "row").select(*columns))
