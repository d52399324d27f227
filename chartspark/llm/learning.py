"""What the classifiers share: labelled rows, bounded samples, and a calibrated logistic score."""

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from chartspark.llm.common import fold, under, whole
from chartspark.sources.storage import materialise

#: Parts into which keys are dealt, and the one that no classifier learns from.
FOLDS, HELD_OUT = 3, 1


def marks(labels: DataFrame, label: str, key: str) -> DataFrame:
    """(key, y) to learn from: labelled 0 or 1 and not in the held-out fold. A key that is labelled more than once counts
    with its largest label; NULL keys have no label."""
    return (
        labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("y"))
        .filter(F.col("y").isin(0, 1) & (fold(F.col("key"), FOLDS) != HELD_OUT))
        .groupBy("key")
        .agg(F.max("y").alias("y"))
    )


def labelled(docs: DataFrame, marked: DataFrame, key: str, text: str) -> DataFrame:
    """(key, y, text) of all labelled documents."""
    texts = docs.select(F.col(key).alias("key"), whole(F.col(text)).alias("text"))
    # labels grow with the documents: sorted and merged at every size
    return texts.join(marked.hint("merge"), "key")


def held_out(key: Column) -> Column:
    return fold(key, FOLDS) == HELD_OUT


def class_sizes(marked: DataFrame) -> dict[int, int]:
    return {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}


def sample(docs: DataFrame, marked: DataFrame, per_class: int, key: str, text: str) -> DataFrame:
    """(y, text, part) of about ``per_class`` distinct labelled texts of each class, all where there are no more.

    Texts are chosen by their hash, with a chance by the number of distinct texts, so copies of a text count once. For
    that only keys, labels and hashes are shuffled; one key of each chosen text, about twice ``per_class`` in all, is
    broadcast, and no text is shuffled but the chosen ones. ``part`` deals the texts into ten by a hash; copies are in
    the same part.
    """
    texts = docs.select(F.col(key).alias("key"), whole(F.col(text)).alias("text"))
    hashes = texts.select("key", F.xxhash64("text").alias("hash")).join(marked.hint("merge"), "key")
    once = materialise(hashes.groupBy("y", "hash").agg(F.min("key").alias("key")))
    chosen = F.lit(False)
    for y, n in class_sizes(once).items():
        chosen = chosen | ((F.col("y") == y) & under(F.col("hash"), per_class / n))
    part = F.pmod(F.xxhash64(F.lit(7), F.col("text")), F.lit(10))
    rows = texts.withColumn("hash", F.xxhash64("text")).join(F.broadcast(once.filter(chosen)), ["key", "hash"])
    return rows.select("y", "text", part.alias("part")).dropDuplicates(["y", "text"])


class Logistic:
    """A logistic function of some features, fitted with a small ridge by Newton's method, rows weighted."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2):
        self.mean, self.scale = (x.mean(axis=0), x.std(axis=0) + 1e-9) if len(x) else (0.0, 1.0)
        z = np.column_stack([np.ones(len(x)), (x - self.mean) / self.scale])
        self.beta = np.zeros(z.shape[1])
        penalty = np.full(z.shape[1], ridge * max(1.0, weight.sum()) / 100)
        for _ in range(50):
            p = _sigmoid(z @ self.beta)
            gradient = z.T @ (weight * (y - p)) - penalty * self.beta
            hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(hessian, gradient)
            self.beta += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(np.column_stack([np.ones(len(x)), (x - self.mean) / self.scale]) @ self.beta)


def _sigmoid(v):
    return 1 / (1 + np.exp(-np.clip(v, -35, 35)))


def class_weights(y: np.ndarray, sizes: dict[int, int]) -> np.ndarray:
    """Weights that give the classes of a sample the shares they have in all rows."""
    present = {c: (y == c).sum() for c in (0, 1)}
    total = sum(sizes.values())
    return np.array([sizes[c] / total * len(y) / present[c] for c in y.tolist()])
