"""Toxicity by compression distance: windows compressed with a dictionary of ordinary and one of toxic text."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from chartspark.llm.common import in_arrow, whole
from chartspark.llm.learning import Logistic, class_sizes, class_weights, held_out, marks, sample
from chartspark.sources.storage import materialise

#: Distinct texts of each class that are learnt from, about.
TEXTS_PER_CLASS = 4000
#: Bytes of a window and from one window to the next.
WINDOW, STEP = 64, 48
#: Bytes of the ordinary dictionary; number and bytes of the pieces that it is trained on.
DICTIONARY, PIECES, PIECE = 16_384, 24_000, 256
#: Units around which the toxic windows are cut, at most; how much more frequent in toxic text they have to be; units that
#: are tested twice at most; and letters of the beginnings of words that are units.
TOXIC_UNITS, RATIO, CANDIDATES, BEGINNINGS = 1024, 4.0, 20_000, (4, 5, 6, 7)
#: What is tried for the toxic dictionary: characters on either side of a window's word, bytes of the dictionary, and bytes
#: of the segments that the trainer takes over. The calibrating texts decide.
SIDES, SIZES, SEGMENTS, SUBSTRING = (1, 2, 3), (1024, 4096), (12, 16), 8
LEVEL = 9
#: Ends every window and both dictionaries: a window that nothing else matches is then never stored uncompressed,
#: and its length shows every byte saved.
TAIL = bytes(random.Random(7).choices(b"0123456789ABCDEFGHJKLMNPQRSTUVWXYZ", k=40))

_WORD = re.compile(r"[^\W\d_]+")


def units(word: str) -> list[str]:
    """What is counted of a word: its beginnings (" idio") and the whole (" idiot "), as they stand in a text."""
    return [f" {word[:n]}" for n in BEGINNINGS if n < len(word)] + [f" {word} "]


def _counted(rows: DataFrame) -> DataFrame:
    """(unit, a, b, all_a, all_b): toxic and ordinary texts with the unit, and its occurrences in them."""

    def count(batches):
        texts, occurrences = (Counter(), Counter()), (Counter(), Counter())
        for batch in batches:
            for y, text in zip(batch.column("y").to_pylist(), batch.column("text")):
                here = Counter(u for w, n in Counter(_WORD.findall(text.as_py().lower())).items() for u in units(w) * min(n, 3))
                texts[y].update(here.keys())
                occurrences[y].update(here)
        found = list(texts[0].keys() | texts[1].keys())
        for i in range(0, len(found), 1 << 16):
            part = found[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string())] + [pa.array([c[u] for u in part], pa.int64()) for c in (texts[1], texts[0], occurrences[1], occurrences[0])],
                names=["unit", "a", "b", "all_a", "all_b"],
            )

    counts = in_arrow(rows.select("y", "text"), count, "unit string, a long, b long, all_a long, all_b long")
    return counts.groupBy("unit").agg(*(F.sum(c).alias(c) for c in ("a", "b", "all_a", "all_b")))


def _contexts(rows: DataFrame, wanted: list[str]) -> DataFrame:
    """(unit, a, b): of the wanted units, in how many different surroundings (the words around) they occur."""
    wanted = frozenset(wanted)

    def find(batches):
        for batch in batches:
            found = set()
            for y, text in zip(batch.column("y").to_pylist(), batch.column("text")):
                words = _WORD.findall(text.as_py().lower())
                known = {w: [u for u in units(w) if u in wanted] for w in set(words)}
                for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                    for unit in known[word]:
                        found.add((y, unit, zlib.crc32(f"{before} {word} {after}".encode("utf-8", "replace"))))
            for part in (list(found)[i : i + (1 << 16)] for i in range(0, len(found), 1 << 16)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*part), (pa.int32(), pa.string(), pa.int64()))],
                    names=["y", "unit", "around"],
                )

    surroundings = in_arrow(rows.select("y", "text"), find, "y int, unit string, around long").distinct()
    return surroundings.groupBy("unit").agg(
        F.sum(F.col("y").cast("long")).alias("a"), F.sum((1 - F.col("y")).cast("long")).alias("b")
    )


def _significant(counts: DataFrame, all_a: int, all_b: int, least: float) -> DataFrame:
    """The units that are more frequent in toxic text by a likelihood ratio test, the surest first."""
    a, b, t = F.col("a"), F.col("b"), F.col("a") + F.col("b")
    share = all_a / (all_a + all_b)
    gain = 2 * (a * F.log(a / (t * share)) + F.when(b > 0, b * F.log(b / (t * (1 - share)))).otherwise(0.0))
    often = counts.filter((a > 0) & (a / all_a > RATIO * (b + 0.5) / all_b))
    return often.withColumn("gain", gain).filter(F.col("gain") > least).orderBy(F.desc("gain"), "unit")


def toxic_units(rows: DataFrame) -> list[str]:
    """Words and beginnings of words that are over-represented in toxic texts, the surest first.

    The first test counts texts and leaves at most ``CANDIDATES``. The second counts different surroundings, so that a
    passage which many texts share counts once. Both allow for as many tests as there are units.
    """
    counts = materialise(_counted(rows))
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return []
    total = counts.agg(F.sum("all_a").alias("a"), F.sum("all_b").alias("b"), F.count(F.lit(1)).alias("n")).first()
    if not total["a"] or not total["b"]:
        return []
    least = 2 * math.log(total["n"]) + 10
    candidates = [r["unit"] for r in _significant(counts, sizes[1], sizes[0], least).limit(CANDIDATES).collect()]
    found = _significant(_contexts(rows, candidates), total["a"], total["b"], least).limit(TOXIC_UNITS).collect()
    return [r["unit"] for r in found]


def toxic_dictionaries(rows: DataFrame, found: list[str]) -> list[bytes]:
    """zstandard's own dictionaries of windows of toxic text, one for each setting.

    Most of a toxic text is ordinary, so a dictionary of all of it would hold what the ordinary one holds. The windows are
    cut around the words that have one of the ``found`` units; those with the smallest hashes are taken. What of them
    comes back often enough is the trainer's choice. The windows themselves where there are too few to train on.
    """
    wanted = frozenset(found)

    def cut(batches):
        for batch in batches:
            for text in batch.column("text"):
                low = text.as_py().lower()
                spans = [m.span() for m in _WORD.finditer(low) if not wanted.isdisjoint(units(m[0]))]
                if spans:
                    pieces = [[low[max(0, a - n) : b + n].encode("utf-8", "replace") for n in SIDES] for a, b in spans]
                    places = [zlib.crc32(f"{a} {low}".encode("utf-8", "replace")) for a, _ in spans]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(pieces, pa.list_(pa.binary())), pa.array(places, pa.int64())], names=["pieces", "place"]
                    )

    windows = in_arrow(rows.select("text"), cut, "pieces array<binary>, place long")
    chosen = windows.orderBy("place", "pieces").limit(PIECES).collect()
    out = []
    for i in range(len(SIDES)):
        pieces = [bytes(r["pieces"][i]) for r in chosen]
        for size in SIZES:
            for segment in SEGMENTS:
                try:
                    trained = zstandard.train_dictionary(size, pieces, k=segment, d=SUBSTRING, level=3).as_bytes()
                except (zstandard.ZstdError, ValueError):
                    trained = b"".join(dict.fromkeys(pieces))[:size]
                if trained not in out:
                    out.append(trained)
    return out


def _loss(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The weighted log loss of a curve on the half of the rows that it was not fitted to, for either half."""
    total, half = 0.0, np.arange(len(y)) % 2 == 0
    for fitted in (half, ~half):
        p = np.clip(Logistic(x[fitted], y[fitted], weight[fitted])(x[~fitted]), 1e-6, 1 - 1e-6)
        truth = y[~fitted]
        total -= float((weight[~fitted] * (truth * np.log(p) + (1 - truth) * np.log(1 - p))).sum())
    return total


def ordinary_dictionary(rows: DataFrame) -> bytes:
    """zstandard's own dictionary of pieces of the texts; the pieces themselves if there are too few to train on.

    The pieces are those with the smallest hashes, wherever in a text they are.
    """

    def cut(batches):
        for batch in batches:
            for text in batch.column("text"):
                data = text.as_py().lower().encode("utf-8", "replace")
                for i in range(0, len(data), 1 << 20):
                    pieces = [data[j : j + PIECE] for j in range(i, min(len(data), i + (1 << 20)), PIECE)]
                    yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.binary())], names=["piece"])

    pieces = in_arrow(rows.select("text"), cut, "piece binary")
    chosen = [bytes(r["piece"]) for r in pieces.orderBy(F.xxhash64("piece"), "piece").limit(PIECES).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY, chosen, level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(chosen)[:DICTIONARY]


class Compressors:
    """The lengths saved by the toxic dictionary, window by window.

    The toxic side has the toxic dictionary before the ordinary one, so a window without anything toxic comes out equally
    long on both, and what is saved is the toxic dictionary's.
    """

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.pair = [_compressor(content + TAIL) for content in (ordinary, toxic + ordinary)]

    def saved(self, text: str) -> list[int]:
        ordinary, toxic = (c.compress for c in self.pair)
        data = text.lower().encode("utf-8", "replace")
        return [
            len(ordinary(w)) - len(toxic(w))
            for w in [data[i : i + WINDOW] + TAIL for i in range(0, max(1, len(data) - WINDOW + STEP), STEP)]
        ]


def _compressor(content: bytes):
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False
    )


def features(saved: list[int]) -> list[float]:
    """The four largest savings, how many windows save two, three and four bytes, and the number of windows."""
    best = [float(x) for x in sorted((x for x in saved if x > 0), reverse=True)[:4]]
    counts = [math.log1p(sum(x >= least for x in saved)) for least in (2, 3, 4)]
    return best + [0.0] * (4 - len(best)) + counts + [math.log1p(len(saved))]


class Model:
    """score(text): the probability that a text is toxic. Without texts of both classes, the share of toxic ones."""

    def __init__(self, ordinary: bytes, toxic: bytes, curve=None, share: float = 0.0):
        self.ordinary, self.toxic, self.curve, self.share = ordinary, toxic, curve, share

    def scorer(self):
        compressors = Compressors(self.ordinary, self.toxic)

        def score(texts: list[str]) -> np.ndarray:
            if self.curve is None or not texts:
                return np.full(len(texts), self.share)
            return self.curve(np.array([features(compressors.saved(t)) for t in texts]))

        return score


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          texts_per_class: int = TEXTS_PER_CLASS) -> Model:
    """Dictionaries and thresholds from a bounded sample of the labelled texts.

    Seven tenths of it give the dictionaries, which zstandard trains: the ordinary one on pieces of ordinary texts, the
    toxic ones on windows of toxic texts around the units of :func:`toxic_units`. The rest, which the dictionaries have
    not seen, gives the savings by which one toxic dictionary is chosen and the score is calibrated, with classes weighted
    as they are among all labelled texts.
    """
    marked = marks(labels, label, key)
    sizes = class_sizes(marked)
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if len(sizes) < 2:
        return Model(b"", b"", None, share)
    build, check = F.col("part") < 7, F.col("part") >= 7
    chosen = materialise(sample(docs, marked, texts_per_class, key, text))
    tried = toxic_dictionaries(chosen.filter(build & (F.col("y") == 1)), toxic_units(chosen.filter(build)))
    ordinary = ordinary_dictionary(chosen.filter(build & (F.col("y") == 0)))

    def measured(batches):
        compressors = [Compressors(ordinary, toxic) for toxic in tried]
        for batch in batches:
            found = [[x for c in compressors for x in features(c.saved(t))] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(found, pa.list_(pa.float64()))], names=["y", "x"])

    seen = in_arrow(chosen.filter(check).orderBy(F.xxhash64("text"), "text").select("y", "text"), measured, "y int, x array<double>").toArrow()
    y = seen.column("y").to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        return Model(b"", b"", None, share)
    weight = class_weights(y.astype(int), sizes)
    x = np.split(np.array(seen.column("x").to_pylist()), len(tried), axis=1)
    best = min(range(len(tried)), key=lambda i: _loss(x[i], y, weight))
    return Model(ordinary, tried[best], Logistic(x[best], y, weight))


def ordinary_rows(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores below the threshold; scored where they are read."""

    docs.select(F.col(text))  # an unknown or ambiguous name is Spark's error
    exact = docs.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    place = [c if exact else c.lower() for c in docs.columns].index(text if exact else text.lower())

    def kept(batches):
        score = model.scorer()
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(score(texts) < threshold, pa.bool_()))

    return in_arrow(docs, kept, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.7,
             model: Model | None = None) -> DataFrame:
    """key, held_out, score, predicted for every row of ``docs``.

    The whole text is compressed in windows, in batches of rows and with no regard to its key or other columns. NULL
    counts as empty; an empty text has one empty window, which saves nothing. Without usable labels all texts score the
    share of toxic labels (0 without any). Equal texts have equal scores. An empty table gives an empty result.
    """
    model = model or train(docs, labels, key, text)

    def scored(batches):
        score = model.scorer()
        for batch in batches:
            found = score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.float64())], names=["key", "score"])

    rows = docs.select(F.col(key).alias("key"), whole(F.col(text)).alias("text"))
    schema = rows.drop("text").schema.add("score", "double")
    return in_arrow(rows, scored, schema).select(
        "key", held_out(F.col("key")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
