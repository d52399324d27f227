"""Quality by naive Bayes support vectors: n-gram indicators scaled by log-count ratios, fitted by dual coordinate descent."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chartspark.llm.common import in_arrow, whole
from chartspark.llm.learning import (
    Logistic, class_sizes, class_weights, held_out, labelled, marks, sample,
)

#: Distinct texts of each class to which the linear model is fitted, about. Counts are taken over all labelled texts.
TEXTS_PER_CLASS = 2000
BUCKET_BITS = 17
#: Repetition n-grams: so many places back, so many words in a row.
REPEATS = [(back, times) for back in (1, 2, 3) for times in (1, 2, 3, 5)]
#: Bytes of a text whose n-grams are looked up at a time.
STRETCH = 1 << 20
COST, SWEEPS = 1.0, 30
SMOOTHING = 1.0


def grams(text: str) -> np.ndarray:
    """The buckets of the text's n-grams, each once, in order: byte n-grams of length 1 to 3, digits counting as one, and
    n-grams of repetition, that is whether up to five words in a row equal the ones one to three places before them."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if not len(data):
        return np.empty(0, np.int64)
    data[(data >= 48) & (data <= 57)] = 48
    on = np.zeros(1 << BUCKET_BITS, bool)
    for i in range(0, len(data), STRETCH):
        part = data[i : i + STRETCH + 2]
        two = part[:-1] | part[1:] << 8 | 1 << 24
        three = part[:-2] | part[1:-1] << 8 | part[2:] << 16 | 2 << 24
        for codes in (part, two, three):
            on[(codes * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)] = True
    on[: len(REPEATS)] = False  # kept for repetition
    words = _word_codes(data)
    for bucket, (back, times) in enumerate(REPEATS):
        same = words[back:] == words[:-back]
        if len(same) >= times:
            run = np.cumsum(np.r_[0, same])
            on[bucket] = bool((run[times:] - run[:-times] == times).any())
    return np.flatnonzero(on)


def _word_codes(data: np.ndarray) -> np.ndarray:
    """A number for each word (bytes between white space), equal for equal words."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    starts = np.flatnonzero(~space & np.r_[True, space[:-1]])
    if not len(starts):
        return np.empty(0, np.uint64)
    place = np.arange(len(data)) - np.repeat(np.r_[0, starts[1:]], np.diff(np.r_[0, starts[1:], len(data)]))
    powers = np.cumprod(np.full(1 << 10, 0x9E3779B97F4A7C15, np.uint64))
    code = np.where(space, 0, data.astype(np.uint64) * powers[place & 1023])
    return np.add.reduceat(code, starts)


def log_ratios(rows: DataFrame) -> np.ndarray:
    """ln of the share of a bucket among the n-grams of class 1 over that of class 0, over all rows."""

    def counted(batches):
        totals = np.zeros((2, 1 << BUCKET_BITS), np.int64)
        for batch in batches:
            for y, text in zip(batch.column("y").to_pylist(), batch.column("text")):
                totals[y, grams(text.as_py())] += 1
        at = np.flatnonzero(totals.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(totals[0, at]), pa.array(totals[1, at])], names=["bucket", "n0", "n1"]
        )

    sums = (
        in_arrow(rows.select("y", "text"), counted, "bucket long, n0 long, n1 long")
        .groupBy("bucket")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .toArrow()
    )
    n = np.full((2, 1 << BUCKET_BITS), SMOOTHING)
    at = sums.column("bucket").to_numpy()
    n[0, at] += sums.column("n0").to_numpy()
    n[1, at] += sums.column("n1").to_numpy()
    return np.log(n[1] / n[1].sum()) - np.log(n[0] / n[0].sum())


def fit(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights of the buckets that minimise |w|^2 / 2 plus the rows' costs times their hinge losses.

    Dual coordinate descent: one row's multiplier is set to its best value between 0 and its cost, over and over, in
    random order; the weights follow. Rows are scaled to length one; the last weight is the bias.
    """
    x = [_scaled(r, ratios) for r in rows]
    sign = np.where(y > 0, 1.0, -1.0)
    w, alpha = np.zeros(len(ratios) + 1), np.zeros(len(x))
    order = np.random.default_rng(0)
    for _ in range(SWEEPS):
        moved = 0.0
        for i in order.permutation(len(x)):
            at, values = rows[i], x[i]
            gradient = sign[i] * (w[at] @ values + w[-1]) - 1
            new = min(max(alpha[i] - gradient / (values @ values + 1), 0.0), cost[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                w[at] += step * values
                w[-1] += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def _scaled(row: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    values = ratios[row]
    return values / (np.sqrt(values @ values) + 1e-12)


class Model:
    def __init__(self, ratios=None, weights=None, curve=None, share: float = 0.5):
        self.ratios, self.weights, self.curve, self.share = ratios, weights, curve, share

    def margin(self, row: np.ndarray) -> float:
        return float(self.weights[row] @ _scaled(row, self.ratios) + self.weights[-1])

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        if self.curve is None or not rows:
            return np.full(len(rows), self.share)
        return self.curve(np.array([[self.margin(r)] for r in rows]))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          texts_per_class: int = TEXTS_PER_CLASS) -> Model:
    """Log-count ratios from all labelled texts, weights and calibration from a bounded sample (70 % and 30 % of it)."""
    marked = marks(labels, label, key)
    sizes = class_sizes(marked)
    share = sizes.get(1, 0) / sum(sizes.values()) if sizes else 0.5
    if len(sizes) < 2:
        return Model(share=share)
    ratios = log_ratios(labelled(docs, marked, key, text))
    chosen = sample(docs, marked, texts_per_class, key, text)

    def found(batches):
        for batch in batches:
            at = [grams(t.as_py()).astype(np.int32) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), batch.column("part"), pa.array(at, pa.list_(pa.int32()))], names=["y", "part", "at"]
            )

    seen = in_arrow(chosen, found, "y int, part long, at array<int>").toArrow()
    y, part = seen.column("y").to_numpy(), seen.column("part").to_numpy()
    at = [np.array(x.as_py(), np.int64) for x in seen.column("at")]
    build = part < 7
    if len(set(y[build].tolist())) < 2 or len(set(y[~build].tolist())) < 2:
        return Model(share=share)
    n = np.array([(y[build] == c).sum() for c in (0, 1)])
    cost = COST * (n.sum() / 2 / n)[y[build]]
    model = Model(ratios, None, None, share)
    model.weights = fit([at[i] for i in np.flatnonzero(build)], y[build], ratios, cost)
    margins = np.array([[model.margin(at[i])] for i in np.flatnonzero(~build)])
    model.curve = Logistic(margins, y[~build].astype(float), class_weights(y[~build], sizes))
    return model


def quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.5,
            model: Model | None = None) -> DataFrame:
    """key, held_out, score, predicted for every row of ``docs``, from the n-grams of its whole text.

    NULL counts as empty; a text without n-grams is scored by the bias alone. Without labels of both classes all texts
    score the share of label 1 (one half without any). Equal texts have equal scores. An empty table gives an empty
    result.
    """
    model = model or train(docs, labels, key, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a bounded number of weights

    def scored(batches):
        for batch in batches:
            found = shared.value.score([grams(t.as_py()) for t in batch.column("text")])
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.float64())], names=["key", "score"])

    rows = docs.select(F.col(key).alias("key"), whole(F.col(text)).alias("text"))
    schema = rows.drop("text").schema.add("score", "double")
    return in_arrow(rows, scored, schema).select(
        "key", held_out(F.col("key")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
