"""Benchmark decontamination: suffix arrays of the documents' words, in which every suffix of the benchmark is looked up."""

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chartspark.llm.common import in_arrow, numbered, portions, rows_only, stored_rows
from chartspark.sources.storage import materialise

#: Consecutive words of an item that count as a passage of it.
WINDOW = 10
#: Words of a shard, about: documents are whole in a shard, so a longer one is a shard of its own.
SHARD = 1 << 20
#: Bytes of item texts that are sent to the tasks at a time; a longer item is a block of its own.
BLOCK_BYTES = 16 << 20

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """The runs of digits, letters and characters beyond ASCII of a UTF-8 text, A-Z in lower case."""
    return text.translate(_FOLD).split() if text else []


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in their order, by doubling the number of symbols that have been compared.

    Symbol 0 ends a suffix; nothing starts at it, and suffixes that are equal up to it are in any order. The last symbol
    is 0.
    """
    n = len(symbols)
    ends = np.flatnonzero(symbols == 0)
    length = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
    starts = np.flatnonzero(symbols)
    array = starts[np.argsort(symbols[starts], kind="stable")]
    rank = np.zeros(n, np.int64)  # 1 + the first place in the array that the suffix may have; 0 where none starts
    new = np.r_[True, symbols[array[1:]] != symbols[array[:-1]]] if len(array) else np.zeros(0, bool)
    rank[array] = np.maximum.accumulate(np.where(new, np.arange(len(array)) + 1, 0))
    places, done = np.arange(len(array)), 1
    while True:
        # a suffix is settled if no other has its rank or if its end has been compared
        mine = rank[array[places]]
        same = mine[1:] == mine[:-1]
        open_ = np.r_[False, same] | np.r_[same, False] if len(places) else np.zeros(0, bool)
        places = places[open_ & (length[array[places]] >= done)]
        if not len(places):
            return array
        at = array[places]
        key = rank[at] * (n + 1) + rank[at + done]
        order = np.argsort(key, kind="stable")
        key, array[places] = key[order], at[order]
        new = np.r_[True, key[1:] != key[:-1]]
        rank[array[places]] = np.maximum.accumulate(np.where(new, places + 1, 0))
        done *= 2


def _bound(text, array, depth, low, high, symbol, after):
    """By halving: the first place in low..high whose suffix has a symbol at ``depth`` not below (``after``: above) ``symbol``."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) >> 1
        found = text[array[middle] + depth]
        below = found <= symbol[open_] if after else found < symbol[open_]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]


class Block:
    """Items whose suffixes are looked up together.

    Their words are numbered from 1 on, and 0 stands behind each item. ``width`` is the length of the window that starts
    at a place, 0 where none does; equal windows are one class, and ``classes`` has the items of each.
    """

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        symbols, width, self.ids, self.start = [], [], [], []
        of, self.classes = {}, []
        number = []
        for name, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if not words:
                continue
            self.ids.append(name)
            self.start.append(len(symbols))
            size = min(window, len(words))
            for i in range(len(words)):
                passage = tuple(words[i : i + size]) if i + size <= len(words) else None
                width.append(size if passage else 0)
                number.append(of.setdefault(passage, len(of)) if passage else -1)
                if passage and number[-1] == len(self.classes):
                    self.classes.append(set())
                if passage:
                    self.classes[number[-1]].add(len(self.ids) - 1)
            symbols += [*words, 0]
            width.append(0)
            number.append(-1)
        self.symbols = np.array(symbols, np.int64)
        self.width, self.number = np.array(width, np.int64), np.array(number, np.int64)

    def look_up(self, text: np.ndarray, array: np.ndarray):
        """Narrow the places of the array that start as each item suffix does, word by word, until none is left.

        Returns (low, high) of the places that hold the window at each suffix, and for each suffix the length of its
        longest match and a place of it.
        """
        n = len(self.symbols)
        low, high = np.zeros(n, np.int64), np.zeros(n, np.int64)
        longest, where = np.zeros(n, np.int64), np.zeros(n, np.int64)
        first = np.searchsorted(text[array], np.arange(len(self.vocabulary) + 2))
        at = np.flatnonzero(self.symbols)
        from_, to = first[self.symbols[at]], first[self.symbols[at] + 1]
        depth = 0
        while True:
            some = from_ < to
            at, from_, to = at[some], from_[some], to[some]
            if not len(at):
                return low, high, longest, where
            depth += 1
            longest[at], where[at] = depth, array[from_]
            window = self.width[at] == depth
            low[at[window]], high[at[window]] = from_[window], to[window]
            goes_on = self.symbols[at + depth] > 0
            at, from_, to = at[goes_on], from_[goes_on], to[goes_on]
            symbol = self.symbols[at + depth]
            from_, to = (_bound(text, array, depth, from_, to, symbol, after) for after in (False, True))


def _shards(texts, vocabulary, size):
    """(numbers of the texts, start of each, symbols): texts of about ``size`` words together, 0 behind each."""
    members, starts, symbols = [], [], []
    for i, text in enumerate(texts):
        words = words_of(text)
        if symbols and len(symbols) + len(words) > size:
            yield members, np.array(starts), np.array(symbols, np.int64)
            members, starts, symbols = [], [], []
        members.append(i)
        starts.append(len(symbols))
        symbols += [vocabulary.get(w, 0) for w in words]
        symbols.append(0)
    if members:
        yield members, np.array(starts), np.array(symbols, np.int64)


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """low[0]..high[0]-1, low[1]..high[1]-1, ..."""
    sizes = high - low
    return np.arange(sizes.sum()) + np.repeat(low - np.cumsum(sizes) + sizes, sizes)


def blocks(items: DataFrame, key: str, text: str, window: int = WINDOW, size: int = BLOCK_BYTES):
    """The benchmark in blocks of bounded size, one at a time."""
    held, total = [], 0
    rows = items.select(F.col(key).cast("string").alias("key"), F.col(text).cast("binary").alias("text"))
    for row in rows.filter("text IS NOT NULL").toLocalIterator():
        data = bytes(row.text)
        if held and total + len(data) > size:
            yield Block(held, window)
            held, total = [], 0
        held.append((row.key, data))
        total += len(data)
    if held:
        yield Block(held, window)


def _affected(docs: DataFrame, block: Block, key: str, text: str, row: str | None, shard: int) -> DataFrame:
    """(row, key, n_words, spans, items) of every document, for the items of one block."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def find(batches):
        block, names = shared.value, {}
        for batch in portions(batches, "text", 16 << 20):
            n_words, spans, items = [], [], []
            texts = (x.as_py() for x in batch.column("text"))
            for _, starts, symbols in _shards(texts, block.vocabulary, shard):
                array = suffix_array(symbols)
                low, high, _, _ = block.look_up(symbols, array)
                found = np.flatnonzero(low < high)
                # equal windows have equal places: one of each class will do
                found = found[np.unique(block.number[found], return_index=True)[1]]
                low, high = low[found], high[found]
                at = array[_ranges(low, high)]
                size = np.repeat(block.width[found], high - low)
                change = np.bincount(at, minlength=len(symbols) + 1) - np.bincount(at + size, minlength=len(symbols) + 1)
                edge = np.diff(np.r_[0, np.cumsum(change) > 0, 0].astype(np.int8))
                begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                # documents in order, with the classes found in each
                doc = np.searchsorted(starts, at, "right") - 1
                pairs = np.unique(doc * len(block.classes) + np.repeat(block.number[found], high - low))
                pair_doc, pair_class = np.divmod(pairs, max(1, len(block.classes)))
                first = np.searchsorted(pair_doc, np.arange(len(starts) + 1)).tolist()
                of_span = np.searchsorted(begin, np.r_[starts, len(symbols)]).tolist()
                n_words += (np.diff(np.r_[starts, len(symbols)]) - 1).tolist()
                for i, start in enumerate(starts.tolist()):
                    inside = slice(of_span[i], of_span[i + 1])
                    spans.append([{"start": b - start, "end": e - start} for b, e in zip(begin[inside].tolist(), end[inside].tolist(), strict=True)])
                    held = tuple(pair_class[first[i] : first[i + 1]].tolist())
                    if held not in names:
                        if len(names) > 10_000:
                            names.clear()
                        every = set().union(*(block.classes[c] for c in held))
                        names[held] = sorted({block.ids[x] for x in every if block.ids[x] is not None})
                    items.append(names[held])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("key"),
                    pa.array(n_words, pa.int64()),
                    pa.array(spans, span),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=["row", "key", "n_words", "spans", "items"],
            )

    rows = numbered(docs, F.col(key).alias("key"), F.col(text).cast("binary").alias("text"), row=row)
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"row long, key {kind}, n_words long, spans array<struct<start: long, end: long>>, items array<string>"
    return in_arrow(rows, find, schema)


def n_covered(spans: Column) -> Column:
    """Places covered by spans that are sorted by their start."""
    zero = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("reached"))

    def add(so_far, span):
        fresh = F.greatest(span["end"] - F.greatest(span["start"], so_far["reached"]), F.lit(0))
        return F.struct(
            (so_far["total"] + fresh).alias("total"), F.greatest(so_far["reached"], span["end"]).alias("reached")
        )

    return F.aggregate(spans, zero, add)["total"]


def contamination(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    row: str | None = None,
    shard: int = SHARD,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Which words of which documents are in passages of the benchmark, and of which items.

    Words are runs of digits, letters and characters beyond ASCII, A-Z in lower case. A passage is ``window`` consecutive
    words of an item, or all words of an item with fewer. The documents of a task are made into suffix arrays of about
    ``shard`` words; every suffix of every item is looked up in each by halving, word by word, and the places that share
    its first ``window`` words are the passage's occurrences. Words that no item has match nothing and start no suffix.

    The items are the stated set of questions: they come block by block, and each block is sent to the tasks whole. With
    several blocks the documents are read once for each. ``docs`` is a stored table.

    Returns a row for every row of ``docs``: row, key, n_words, spans (array of start and end in words; sorted, of one
    block free of overlaps), items (ids as text, different ones, sorted). A NULL text has no words; a NULL id of an item
    counts for the spans but is not listed; equal ids are one. Without items nothing is found. Repeated documents are
    each found. An empty table gives an empty result; other columns are not looked at.
    """
    found = None
    for i, block in enumerate(blocks(items, item_key, item_text, window, block_bytes)):
        if i == 1 and row is None:  # rows are matched between the blocks, so their numbers are stored
            docs, row = stored_rows(docs)
            found = [_affected(docs, first, key, text, row, shard)]
        first = block
        found = [*(found or []), _affected(docs, block, key, text, row, shard)]
    if found is None:
        found = [_affected(docs, Block([], window), key, text, row, shard)]
    if len(found) == 1:
        return found[0]
    merged = reduce(DataFrame.unionByName, found).groupBy("row").agg(
        F.first("key").alias("key"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return merged


def decontaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that hold no passage of the benchmark; see :func:`contamination`."""
    docs, row = stored_rows(docs)
    return rows_only(docs, row, contamination(docs, items, row=row, **options).filter(F.size("spans") > 0).select("row"))


def longest_matches(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    shard: int = SHARD,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The longest verbatim match of every suffix of every item: item, start, length, row, key, place.

    ``start`` and ``place`` are in words, from 0. Suffixes of which no document has the first word are not listed. Of
    several longest matches the one in the first row, at the first place there that its shard has found, is told.
    """
    docs, row = stored_rows(docs)
    out = None
    for block in blocks(items, item_key, item_text, size=block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def find(batches, shared=shared):
            block = shared.value
            begin = np.array([*block.start, len(block.symbols)], np.int64)
            item = np.repeat(np.arange(len(block.ids)), np.diff(begin))
            for batch in portions(batches, "text", 16 << 20):
                texts = (x.as_py() for x in batch.column("text"))
                for members, starts, symbols in _shards(texts, block.vocabulary, shard):
                    _, _, longest, where = block.look_up(symbols, suffix_array(symbols))
                    at = np.flatnonzero(longest)
                    doc = np.searchsorted(starts, where[at], "right") - 1
                    take = pa.array(np.array(members, np.int64)[doc])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([block.ids[i] for i in item[at].tolist()], pa.string()),
                            pa.array(at - begin[item[at]]),
                            pa.array(longest[at]),
                            batch.column("row").take(take),
                            batch.column("key").take(take),
                            pa.array(where[at] - starts[doc]),
                        ],
                        names=["item", "start", "length", "row", "key", "place"],
                    )

        rows = numbered(docs, F.col(key).alias("key"), F.col(text).cast("binary").alias("text"), row=row)
        kind = rows.schema["key"].dataType.simpleString()
        schema = f"item string, start long, length long, row long, key {kind}, place long"
        part = in_arrow(rows, find, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        kind = docs.schema[key].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item string, start long, length long, row long, key {kind}, place long")
    best = F.min(F.struct(-F.col("length"), "row", "place", "key")).alias("best")
    found = materialise(out.groupBy("item", "start").agg(best))
    return found.select(
        "item", "start", (-F.col("best.col1")).alias("length"), "best.row", "best.key", "best.place"
    )
