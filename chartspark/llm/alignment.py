"""Cross-tokenizer alignment: which ids of one vocabulary end together with which ids of another, counted over all texts."""

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType

from chartspark.llm.common import in_arrow, numbered, portions
from chartspark.llm.tokens import byte_level_entries, encoder
from chartspark.sources.storage import materialise

#: Pairs of ids that are sent to the tasks with their counts; all others are joined by a shuffle.
FREQUENT = 1 << 18
#: Different pairs that a task holds before it gives their counts away.
HELD = 1 << 20
#: Characters that the piece model encodes at a time, about.
STRETCH = 1 << 16

# How piece models write a space, and a byte.
_SPACE = "▁"
_BYTE = re.compile("<0x([0-9A-F]{2})>")
# End of the fixed values.

_CUT = re.compile(r"(?<=[^ ]) (?=[^ ])")


class Pieces:
    """Ids and bytes of a piece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.entries = []
        for i, name in enumerate(names):
            byte = _BYTE.fullmatch(name) if self.model.is_byte(i) else None
            outside = self.model.is_control(i) or self.model.is_unknown(i)
            self.entries.append(b"" if outside else bytes([int(byte[1], 16)]) if byte else name.replace(_SPACE, " ").encode())
        #: No piece goes on behind a space, so a long text can be cut at one between two words.
        self.cuts = not any(_SPACE in name.lstrip(_SPACE) for name in names)

    def encode(self, text: str) -> list[int]:
        if len(text) <= STRETCH or not self.cuts:
            return self.model.encode(text)
        ids, at = [], 0
        while len(text) - at > STRETCH:
            cut = _CUT.search(text, at + STRETCH)
            if not cut:
                break
            ids += self.model.encode(text[at : cut.start()])
            at = cut.end()  # the model puts the space back
        return ids + self.model.encode(text[at:])


class Aligner:
    """Both vocabularies, and ``same``: for each id of A the id of B with the same bytes, -1 where there is none."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.pieces = encoder(a_path, plain=True), Pieces(b_path)
        self.a_entries, self.b_entries = byte_level_entries(a_path), self.pieces.entries
        self.a_size = np.array([len(x) for x in self.a_entries], np.int64)
        self.b_size = np.array([len(x) for x in self.b_entries], np.int64)
        self.same = same_bytes(self.a_entries, self.b_entries)
        n = len(self.a_entries)
        self.marks = [
            *(f"{i},".encode() for i in range(n)), *(f"{i}|".encode() for i in range(n)),
            *(f"{i},".encode() for i in range(len(self.b_entries))), *(f"{i};".encode() for i in range(len(self.b_entries))),
        ]

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both, or None where their bytes are not those of the text behind a space."""
        if not text:
            return None
        whole = b" " + text.encode()
        a, b = np.frombuffer(self.a.encode(" " + text), "<u4"), self.pieces.encode(text)
        if b"".join([self.b_entries[i] for i in b]) != whole or b"".join([self.a_entries[i] for i in a.tolist()]) != whole:
            return None
        return a.astype(np.int64), np.array(b, np.int64)

    def written(self, a, b, last_a, last_b) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: the ids in order, by groups that end at the places ``last_a`` and ``last_b``."""
        n, m = len(self.a_entries), len(self.b_entries)
        a_marks, b_marks = a.copy(), b + 2 * n
        a_marks[last_a] += n
        b_marks[last_b] += m
        # behind all of B in earlier groups; behind all of A in its own and earlier ones
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.r_[0, last_b + 1][np.searchsorted(last_a, np.arange(len(a)))]] = a_marks
        order[np.arange(len(b)) + (last_a + 1)[np.searchsorted(last_b, np.arange(len(b)))]] = b_marks
        return b"".join([self.marks[i] for i in order.tolist()])[:-1]


def same_bytes(a_entries: list[bytes], b_entries: list[bytes]) -> np.ndarray:
    """For each entry of A the place of the one of B with the same bytes (the last, if several), -1 where there is none."""
    of = {entry: i for i, entry in enumerate(b_entries) if entry}
    return np.array([of.get(entry, -1) for entry in a_entries], np.int64)


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """The worker's pair of vocabularies."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def _lists(values: np.ndarray, sizes: np.ndarray, kind) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


class _Counts:
    """Numbers of occurrences of pairs, as sorted keys."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray) -> None:
        found, n = np.unique(keys, return_counts=True)
        self.parts.append((found, n))
        self.held += len(found)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        found, at = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        n = np.bincount(at, np.concatenate([n for _, n in self.parts]), len(found)).astype(np.int64)
        self.parts, self.held = [(found, n)], len(found)
        return found, n


#: Rows with a document; with numbers of one-to-one groups by id of A; with numbers of other pairs.
DOCUMENT, REGULAR, IRREGULAR = range(3)
_LONGS = pa.list_(pa.int64())
#: Numbers in one row of counts.
CHUNK = 1 << 16


def _encoded(docs: DataFrame, a_path: str, b_path: str, key: str, text: str, groups: bool) -> DataFrame:
    """A row for each document with its links, and at the end of each task rows with the numbers of what it has linked."""

    def align(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        both = aligner(a_path, b_path)
        n, m = len(both.a_entries), len(both.b_entries)
        regular_counts, pairs = np.zeros(n, np.int64), _Counts()
        kind = None

        def counts_rows():
            at = np.flatnonzero(regular_counts)
            keys, held = pairs.merged()
            for what, ids, other, number in (
                (REGULAR, at, both.same[at], regular_counts[at]), (IRREGULAR, keys // m, keys % m, held)
            ):
                for begin in range(0, len(ids), CHUNK):
                    part = slice(begin, begin + CHUNK)
                    size = np.array([len(ids[part])])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([what], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, kind),
                            *(pa.array([0], pa.int64()),) * 4, pa.array([""]), pa.nulls(1, pa.string()),
                            _lists(ids[part], size, pa.int32()), _lists(other[part], size, pa.int64()), _lists(number[part], size, pa.int64()),
                        ],
                        names=NAMES,
                    )

        for batch in portions(batches, "text"):
            kind = batch.column("key").type
            size = batch.num_rows
            n_a, n_b, n_groups, hashes, strings, links = [], [], [], [], [], []
            for x in batch.column("text"):
                found = both.encode(x.as_py())
                if found is None:
                    n_a.append(0), n_b.append(0), n_groups.append(0), hashes.append(""), strings.append(""), links.append(None)
                    continue
                a, b = found
                a_end, b_end = np.cumsum(both.a_size[a]), np.cumsum(both.b_size[b])
                at = np.searchsorted(b_end, a_end)
                last_a = np.flatnonzero(b_end[at] == a_end)
                last_b = at[last_a]
                written = both.written(a, b, last_a, last_b)
                one = (np.diff(last_a, prepend=-1) == 1) & (np.diff(last_b, prepend=-1) == 1)
                plain = one & (both.same[a[last_a]] == b[last_b])
                regular, odd = a[last_a[plain]], ~plain
                links.append((regular, a[last_a[odd]], b[last_b[odd]]))
                n_a.append(len(a)), n_b.append(len(b)), n_groups.append(len(last_a))
                hashes.append(hashlib.sha256(written).hexdigest()), strings.append(written.decode() if groups else None)
            some = [x for x in links if x is not None]
            regular, odd_a, odd_b = (np.concatenate([x[i] for x in some] or [np.zeros(0, np.int64)]) for i in range(3))
            regular_counts += np.bincount(regular, minlength=n)
            pairs.add(odd_a * m + odd_b)
            sizes = [np.array([0 if x is None else len(x[i]) for x in links]) for i in range(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(size, DOCUMENT), pa.int32()), batch.column("row"), batch.column("key"),
                    *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_groups)), pa.array(hashes, pa.string()),
                    pa.array(strings if groups else [None] * size, pa.string()),
                    _lists(regular, sizes[0], pa.int32()), _lists(odd_a * m + odd_b, sizes[1], pa.int64()),
                    pa.nulls(size, _LONGS),
                ],
                names=NAMES,
            )
            if pairs.held > HELD:
                pairs.merged()
                if pairs.held > HELD // 2:
                    yield from counts_rows()
                    regular_counts[:], pairs = 0, _Counts()
        if kind is not None:
            yield from counts_rows()

    rows = numbered(docs, F.col(key).alias("key"), F.col(text).alias("text"))
    schema = "kind int, row long, key {}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, first array<int>, second array<bigint>, n array<bigint>"
    return in_arrow(rows, align, schema.format(rows.schema["key"].dataType.simpleString()))


NAMES = ["kind", "row", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "first", "second", "n"]


def _pair_counts(encoded: DataFrame) -> DataFrame:
    """(a, b, n) of all pairs, from the rows that the tasks have counted."""
    counted = encoded.filter(F.col("kind") != DOCUMENT).select(
        "kind", F.explode(F.arrays_zip("first", "second", "n")).alias("x")
    )
    parts = counted.select("kind", F.col("x.first").alias("a"), F.col("x.second").cast("int").alias("b"), F.col("x.n").alias("n"))
    return parts.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _threshold(pairs: DataFrame, most: int) -> int:
    """The least power of two that at most ``most`` pairs reach; 0 if all pairs are no more than that."""
    sizes = pairs.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).agg(F.count(F.lit(1)).alias("n")).collect()
    total, least = 0, None
    for power, n in sorted((tuple(r) for r in sizes), reverse=True):
        total += n
        if total > most:
            return 1 << (power + 1)
        least = power
    return 0


def alignment(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    key: str = "doc_id",
    text: str = "text",
    groups: bool = False,
    frequent: int = FREQUENT,
) -> tuple[DataFrame, DataFrame]:
    """How the tokens of a byte-level vocabulary A and a piece model B lie over each other in every text.

    A encodes the text behind a space, B the text (and adds the space itself); strings of special tokens are plain text.
    Places where tokens of both end cut the tokens into groups, and the last tokens of a group are linked. Groups of one
    token each with the same bytes are the rule: an array that is made beforehand gives the id of B for that of A, they
    are counted in a vector as long as the vocabulary of A, and only one row per task and id is added up. Other links are
    counted per task too, and go through the shuffle as pairs.

    For what a document's links are worth over all texts its links are looked up among the counts: the vector and the
    highest count of each id of B, as long as the vocabularies, and the ``frequent`` most frequent pairs are sent to the
    tasks. Rarer pairs are joined; none of them can be hot.

    Returns two tables. A row for every row of ``docs``: row, key, n_a, n_b, n_groups, n_links, n_best (links whose
    count is the highest of their id of B, ties included), count_sum (the links' counts added up), groups_sha256 (of
    ``a1,a2|b1;a3|b2,b3``), and with ``groups`` that string. And the pairs of ids: a, b, n. Texts that are NULL or empty,
    or that the bytes of A's or B's tokens do not spell behind a space, have no tokens: zeros, an empty string for the
    hash. Repeated rows count each. An empty table gives empty results. ``docs`` is a stored table.
    """
    encoded = materialise(_encoded(docs, a_path, b_path, key, text, groups))
    pairs = materialise(_pair_counts(encoded))
    spark = docs.sparkSession
    both = aligner(a_path, b_path)
    n, m = len(both.a_entries), len(both.b_entries)
    # as long as the vocabularies: at most one row for each id
    best = np.zeros(m, np.int64)
    for b, most in pairs.groupBy("b").agg(F.max("n")).collect():
        best[b] = most
    least = _threshold(pairs, frequent)
    known = sorted((a * m + b, count) for a, b, count in pairs.filter(F.col("n") >= least).collect())
    keys = np.array([k for k, _ in known], np.int64)
    counts = np.array([c for _, c in known], np.int64)
    vector = np.zeros(n, np.int64)
    same = spark.createDataFrame([(i, b) for i, b in enumerate(both.same.tolist()) if b >= 0], "a int, b int")
    for a, count in pairs.join(same, ["a", "b"]).select("a", "n").collect():
        vector[a] = count
    shared = spark.sparkContext.broadcast((vector, vector == best[both.same], best, keys, counts))

    def value(batches):
        vector, is_best, best, keys, counts = shared.value
        for batch in batches:
            def sums(values, offsets):
                total = np.r_[0, np.cumsum(values)]
                return total[offsets[1:]] - total[offsets[:-1]]

            first, second = batch.column("first"), batch.column("second")
            a, a_offsets = first.flatten().to_numpy(zero_copy_only=False), first.offsets.to_numpy()
            odd, odd_offsets = second.flatten().to_numpy(zero_copy_only=False), second.offsets.to_numpy()
            a_offsets, odd_offsets = a_offsets - a_offsets[0], odd_offsets - odd_offsets[0]
            at = np.minimum(np.searchsorted(keys, odd), max(0, len(keys) - 1))
            known = keys[at] == odd if len(keys) else np.zeros(len(odd), bool)
            count = np.where(known, counts[at], 0) if len(keys) else np.zeros(len(odd), np.int64)
            n_best = sums(is_best[a], a_offsets) + sums(known & (count == best[odd % m]), odd_offsets)
            count_sum = sums(vector[a], a_offsets) + sums(count, odd_offsets)
            rare = _lists(odd[~known], sums(~known, odd_offsets), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in KEPT), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), rare],
                names=[*KEPT, "n_best", "count_sum", "rare"],
            )

    documents = encoded.filter(F.col("kind") == DOCUMENT).select(*KEPT, "first", "second")
    schema = documents.select(*KEPT).schema.add("n_best", "long").add("count_sum", "long").add("rare", ArrayType(LongType()))
    valued = in_arrow(documents, value, schema)
    order = ["row", "key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *["groups"] * groups]
    if not least:
        return valued.select(*order), pairs
    valued = materialise(valued)
    highest = spark.createDataFrame([(b, most) for b, most in enumerate(best.tolist()) if most], "b int, most long")
    worth = pairs.filter(F.col("n") < least).join(highest, "b").select(
        (F.col("a").cast("long") * m + F.col("b")).alias("pair"), "n", (F.col("n") == F.col("most")).alias("is_best")
    )
    links = valued.select("row", F.explode("rare").alias("pair")).groupBy("row", "pair").agg(F.count(F.lit(1)).alias("times"))
    more = links.join(worth, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"),
    )
    out = valued.join(more, "row", "left").withColumns(
        {
            "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
            "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0)),
        }
    )
    return out.select(*order), pairs


KEPT = ["row", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups"]
