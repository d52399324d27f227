"""Near-duplicates by SimHash: fingerprints linked within a few bits, found at the anchors of covering codes."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from chartspark.llm.common import in_arrow, numbered, whole
from chartspark.llm.components import components
from chartspark.sources.storage import materialise

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 17
#: Pairs of fingerprints compared at a time, rows of a task read at a time, links kept before they are thinned out.
PAIRS, ROWS, LINKS = 1 << 21, 1 << 18, 1 << 19
#: Rows that may meet at one anchor; those of a larger one are dealt into tiles.
TILE_ROWS = 8192
#: Groups of anchors that are counted to find the large ones.
BUCKETS = 1 << 16
#: Different fingerprints from which on longer codes are taken: here a fingerprint's comparisons, at 13 ns each, cost as much
#: as the 60 rows more that longer codes need, at 6 microseconds each.
WIDE_FROM = 1 << 29


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """64 bits: a bit is 1 if it is set in over half the hashes of the text's shingles, repeats included."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(b" ".join(tokens), SEED)
    joined, digest = b" ".join(tokens), xxhash.xxh64_intdigest
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts, stops = (ends - lengths)[: 1 - words], ends[words - 1 :]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(starts), CHUNK):
        pairs = zip(starts[i : i + CHUNK].tolist(), stops[i : i + CHUNK].tolist())
        counts += _bit_counts([digest(joined[a:b], SEED) for a, b in pairs])
    return _packed(counts * 2 > len(starts))


def _bit_counts(hashes: list[int]) -> np.ndarray:
    return np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
        axis=0, dtype=np.int64
    )


def _packed(bits: np.ndarray) -> int:
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, key: str, text: str, words: int = SHINGLE_WORDS, row: str | None = None
) -> DataFrame:
    """(row, key, print): the fingerprint as a signed long."""

    def prints(batches):
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), words) for t in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("key"), pa.array(found)], names=["row", "key", "print"]
            )

    rows = numbered(docs, F.col(key).alias("key"), whole(F.col(text)).alias("text"), row=row)
    schema = rows.drop("text").schema.add("print", "long")
    return in_arrow(rows, prints, schema)


class Code:
    """The anchors of some bits of the fingerprint: codewords of a Hamming code on the first of them, any other bits.

    The bits are ``bits`` from ``shift`` on, joined with ``more`` such places, 15 or more in all. With 31 or more the code is
    (31, 26), else (15, 11). Every value is within ``RADIUS`` 1 of an anchor, its home. Two values that differ in one bit
    meet: the home of one is within radius plus threshold, 2, of the other.
    """

    RADIUS = 1

    def __init__(self, shift: int, bits: int, *more: tuple[int, int]):
        self.pieces = ((shift, bits), *more)
        self.bits = sum(n for _, n in self.pieces)
        self.length = 31 if self.bits >= 31 else 15
        places = np.arange(1 << 16)
        tables = np.zeros((2, 1 << 16), np.uint8)  # what the first and the next 16 bits add to the syndrome
        for bit in range(self.length):
            tables[bit // 16] ^= ((places >> bit % 16 & 1) * (bit + 1)).astype(np.uint8)
        self.syndromes, self.upper = tables
        # flips that lead from a value with the syndrome to all anchors within two bits, the home first
        rest = [1 << b for b in range(self.length, self.bits)]
        self.flips = {0: [0] + rest + [a | b for i, a in enumerate(rest) for b in rest[i + 1 :]]}
        for s in range(1, self.length + 1):
            home = 1 << (s - 1)
            pairs = {tuple(sorted((i, i ^ s))) for i in range(1, self.length + 1) if 0 < i ^ s != i}
            self.flips[s] = [home] + [home | r for r in rest] + [1 << (i - 1) | 1 << (j - 1) for i, j in sorted(pairs)]

    def syndrome(self, values: np.ndarray) -> np.ndarray:
        return self.syndromes[values & 0xFFFF] ^ self.upper[values >> 16 & 0xFFFF]

    def anchors(self, prints: np.ndarray):
        """(places of the fingerprints, anchors, is it the home) of all anchors within two bits."""
        values = _joined(prints, self.pieces)
        syndromes = self.syndrome(values)
        for s, flips in self.flips.items():
            at = np.flatnonzero(syndromes == s)
            if len(at):
                near = values[at][:, None] ^ np.array(flips, np.int64)[None, :]
                home = np.zeros(near.shape, bool)
                home[:, 0] = True
                yield np.repeat(at, len(flips)), near.ravel(), home.ravel()


class Exact:
    """All values of some bits are anchors: radius 0, threshold 0."""

    def __init__(self, shift: int, bits: int):
        self.shift, self.bits = shift, bits

    def anchors(self, prints: np.ndarray):
        values = _joined(prints, [(self.shift, self.bits)])
        yield np.arange(len(values)), values, np.ones(len(values), bool)


def _joined(prints: np.ndarray, pieces) -> np.ndarray:
    values = np.zeros(len(prints), np.uint64)
    for shift, bits in pieces:
        values = values << np.uint64(bits) | prints >> np.uint64(shift) & np.uint64((1 << bits) - 1)
    return values.astype(np.int64)


#: Six blocks of the fingerprint, and triples of them: however four bits fall on the blocks, some triple has one at most.
#: (Blocks in pairs; each pair goes with either block of the next. So any two blocks are in a triple, and of any four
#: blocks three are one.)
BLOCKS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
TRIPLES = [(0, 1, 2), (0, 1, 3), (2, 3, 4), (2, 3, 5), (4, 5, 0), (4, 5, 1)]


def covering(max_bits: int, prints: int = 0) -> list:
    """Bits to be covered, so that fingerprints within ``max_bits`` differ by no more than the threshold in one part.

    Parts that do not overlap do so if their thresholds, each plus one, sum up to more than ``max_bits``. For four bits
    these are two segments of 24 bits at threshold 1 (2 ** 20 anchors each, about 19 within two bits of a value) and one of
    16 bits that has to agree: 39 rows a fingerprint, and of random fingerprints one pair in 20,000 is compared. With
    ``WIDE_FROM`` fingerprints or more, comparisons, which grow with the square, outweigh rows, and triples of blocks
    are taken: six codes on 31 to 33 bits, 99 rows a fingerprint, one pair in 1.2 million. Either finds all.
    """
    if max_bits <= 2:
        return [Code(0, 32), Exact(32, 32)]
    if max_bits <= 4 and prints >= WIDE_FROM:
        return [Code(*BLOCKS[i], BLOCKS[j], BLOCKS[k]) for i, j, k in TRIPLES]
    if max_bits <= 4:
        return [Code(0, 24), Code(24, 24), Exact(48, 16)]
    if max_bits <= 7:
        return [Code(16 * i, 16) for i in range(4)]
    raise ValueError("more than 7 differing bits are not supported")


def thinned(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes: each node with the smallest of its component."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = places[: len(a)], places[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    at = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[at], nodes[label[at]]


def _close(prints, homes, starts, ends, max_bits):
    """Links of every row at ``homes`` with the rows of its group, ``starts`` to ``ends``; some millions at a time."""
    sizes = ends - starts
    upto = np.cumsum(sizes)
    i = 0
    while i < len(homes):
        before = upto[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(upto, before + PAIRS, "right")))
        part = sizes[i:j]
        left = np.repeat(homes[i:j], part)
        right = np.arange(part.sum()) - np.repeat(upto[i:j] - part - before, part) + np.repeat(starts[i:j], part)
        differ = np.bitwise_count(prints[left] ^ prints[right])
        at = np.flatnonzero((differ <= max_bits) & (differ > 0))
        yield prints[left[at]], prints[right[at]]
        i = j


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links that connect all fingerprints within ``max_bits`` of each other. ``prints`` holds each one once.

    Every fingerprint goes to the anchors of its segments within radius plus threshold, and is compared there with the
    fingerprints that have their home there. A task gives the links that join something for the first time only, at
    most one for each of its fingerprints, since components are all that is wanted. Anchors in groups with far more rows
    than ``TILE_ROWS`` are cut into tiles of homes times others, so no task gets a large one whole; the list of those
    groups, at most ``BUCKETS``, is all that is broadcast.
    """
    codes = covering(max_bits, prints.count())

    def anchored(batches):
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            for segment, code in enumerate(codes):
                for at, anchor, home in code.anchors(own):
                    for k in range(0, len(at), ROWS):
                        part = slice(k, k + ROWS)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(anchor[part] * 8 + segment), pa.array(own[at[part]].view(np.int64)), pa.array(home[part])],
                            names=["anchor", "print", "home"],
                        )

    def compared(batches):
        found, held = [], 0
        for key, own, home in _groups(batches):
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            last = np.r_[first[1:], len(key)]
            group = np.cumsum(np.r_[True, key[1:] != key[:-1]]) - 1
            at = np.flatnonzero(home & (last - first > 1)[group])
            for a, b in _close(own, at, first[group[at]], last[group[at]], max_bits):
                found.append((a, b))
                held += len(a)
                if held > LINKS:
                    found = [thinned(*map(np.concatenate, zip(*found)))]
                    held = len(found[0][0])
        if held:
            a, b = thinned(*map(np.concatenate, zip(*found)))
            for k in range(0, len(a), ROWS):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[k : k + ROWS].view(np.int64)) for x in (a, b)], names=["a", "b"]
                )

    rows = materialise(in_arrow(prints.select("print"), anchored, "anchor long, print long, home boolean"))
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(BUCKETS))
    counts = rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    mean = rows.count() / BUCKETS
    large = counts.filter(F.col("n") > max(TILE_ROWS, 4 * mean)).select(
        "bucket", F.ceil(F.col("n") / TILE_ROWS).cast("int").alias("tiles")
    )
    dealt = rows.withColumn("bucket", bucket).join(F.broadcast(large), "bucket", "left")
    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    own_tile = F.pmod(F.xxhash64("print"), F.col("tiles")).cast("int")
    as_other = F.transform(every, lambda i: F.struct(i.alias("i"), own_tile.alias("j"), F.lit(False).alias("home")))
    as_home = F.transform(every, lambda j: F.struct(own_tile.alias("i"), j.alias("j"), F.lit(True).alias("home")))
    whole_ = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.col("home").alias("home")))
    tiles = F.when(F.col("tiles").isNull(), whole_).when(F.col("home"), F.concat(as_home, as_other)).otherwise(as_other)
    tiled = dealt.select("anchor", "print", F.explode(tiles).alias("tile")).select(
        "anchor", "print", "tile.home", F.xxhash64("anchor", "tile.i", "tile.j").alias("group")
    )
    together = tiled.repartition("group").sortWithinPartitions("group").select("group", "print", "home")
    return in_arrow(together, compared, "a long, b long")


def _groups(batches):
    """Whole groups of rows sorted by group, about ``ROWS`` rows at a time: (group, print, home)."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size >= ROWS:
            key, own, home = _columns(held)
            end = int(np.searchsorted(key, key[-1], "left"))
            if end:
                yield key[:end], own[:end], home[:end]
                held, size = [_rest(held, end)], size - end
    if size:
        yield _columns(held)


def _columns(batches):
    rows = pa.Table.from_batches(batches)
    return (
        rows.column(0).to_numpy(),
        rows.column(1).to_numpy().view(np.uint64),
        rows.column(2).to_numpy(zero_copy_only=False),
    )


def _rest(batches, start):
    return pa.Table.from_batches(batches).slice(start).combine_chunks().to_batches()[0]


def simhash_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
    row: str | None = None,
) -> DataFrame:
    """Documents linked by fingerprints within ``max_bits`` of each other, directly or over others.

    The shingles are ``words`` words long (lower-cased A-Z, split at ASCII white space); a text with fewer words is one
    shingle, a text without words (empty or NULL) has fingerprint zero and is linked like any other.

    Returns a row for every row of the stored table ``docs``: row (from its column of that name, if one is named), key,
    fingerprint (16 hexadecimal digits), component (smallest key that is not NULL among all linked rows), kept (the row with
    that key; of several the first in the table). Equal fingerprints are one node, so copies cost one row; hot ones are split by the join's skew handling. An
    empty table gives an empty result.
    """
    rows = materialise(fingerprints(docs, key, text, words, row))
    first = F.struct(F.col("key").isNull().alias("no_key"), F.col("key").alias("key"), F.col("row").alias("row"))
    nodes = materialise(rows.groupBy("print").agg(F.min(first).alias("first")))
    roots = components(links(nodes, max_bits)).withColumnRenamed("node", "print")
    rooted = materialise(nodes.join(roots, "print", "left").select("print", F.coalesce("root", "print").alias("root"), "first"))
    best = materialise(rooted.groupBy("root").agg(F.min("first").alias("best")))
    named = materialise(rooted.select("print", "root").join(best, "root").select("print", "best.key", "best.row"))
    named = named.select("print", F.col("key").alias("component"), F.col("row").alias("best_row"))
    return rows.join(named, "print").select(
        "row",
        "key",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component",
        (F.col("row") == F.col("best_row")).alias("kept"),
    )
