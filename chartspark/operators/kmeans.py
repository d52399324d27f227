"""K-means for several numbers of clusters at once: every round is one scan of the vectors, however many numbers there are."""

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from chartspark.session import ship_package

#: Rounds of choosing candidates for first centres, and how many a round takes, in multiples of the most clusters.
CANDIDATE_ROUNDS, OVERSAMPLING = 2, 5
#: Tries of drawing first centres from the candidates, of which the best counts.
DRAWS = 8
ROUNDS, TOLERANCE = 20, 1e-4


@dataclass
class Fit:
    """Centres (a row each) and the sum of squared distances to the nearest of them."""

    centres: np.ndarray
    inertia: float


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    values = batch.column(column)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, points x centres."""
    found = (points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1)[None, :]
    return np.maximum(found, 0)


def _sums(vectors: DataFrame, column: str, groups: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """(size, sum, inertia) of the clusters about each group of centres, in one scan. A task gives one row per centre."""
    starts = np.cumsum([0, *map(len, groups)])
    shared = vectors.sparkSession.sparkContext.broadcast(groups)

    def add(batches):
        groups = shared.value
        sizes = [np.zeros(len(g)) for g in groups]
        totals = [np.zeros(g.shape) for g in groups]
        inertia = [np.zeros(len(g)) for g in groups]
        for batch in batches:
            points = _matrix(batch, column)
            for i, centres in enumerate(groups):
                squares = _squares(points, centres)
                nearest = squares.argmin(axis=1)
                own = np.zeros((len(points), len(centres)))
                own[np.arange(len(points)), nearest] = 1
                sizes[i] += own.sum(axis=0)
                totals[i] += own.T @ points
                inertia[i] += np.bincount(nearest, squares[np.arange(len(points)), nearest], len(centres))
        flat = np.concatenate(totals)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(len(flat))),
                pa.array(np.concatenate(sizes)),
                pa.FixedSizeListArray.from_arrays(pa.array(flat.ravel()), flat.shape[1]).cast(pa.list_(pa.float64())),
                pa.array(np.concatenate(inertia)),
            ],
            names=["centre", "size", "total", "inertia"],
        )

    parts = vectors.select(column).mapInArrow(add, "centre long, size double, total array<double>, inertia double")
    width = groups[0].shape[1]
    added = Summarizer.metrics("sum").summary(array_to_vector("total"))["sum"]
    rows = parts.groupBy("centre").agg(F.sum("size"), added, F.sum("inertia")).collect()  # a row for each centre
    size, total, inertia = np.zeros(starts[-1]), np.zeros((starts[-1], width)), np.zeros(starts[-1])
    for centre, n, vector, squares in rows:
        size[centre], total[centre], inertia[centre] = n, vector.toArray(), squares
    return [(size[a:b], total[a:b], float(inertia[a:b].sum())) for a, b in zip(starts[:-1], starts[1:], strict=True)]


def _candidates(vectors: DataFrame, column: str, most: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Points spread over all vectors, and how many vectors each is nearest to: k-means||.

    A vector is taken with a chance that grows with its squared distance to those taken before; the chance is drawn from
    a hash of the vector, so a task that runs again takes the same ones, and equal vectors are one candidate.
    """
    hashed = F.xxhash64(F.lit(seed), F.col(column))
    first = vectors.select(column).orderBy(hashed, column).limit(1).collect()
    if not first:
        return np.zeros((0, 0)), np.zeros(0)
    taken = np.array([first[0][0]], float)
    for round_ in range(CANDIDATE_ROUNDS):
        (_, _, cost), = _sums(vectors, column, [taken])
        if cost <= 0:
            break
        shared = vectors.sparkSession.sparkContext.broadcast((taken, OVERSAMPLING * most / cost))

        def chosen(batches, shared=shared):
            taken, rate = shared.value
            for batch in batches:
                chance = batch.column("chance").to_numpy(zero_copy_only=False)
                near = _squares(_matrix(batch, column), taken).min(axis=1)
                yield batch.filter(pa.array(chance < rate * near)).select([column])

        drawn = (F.xxhash64(F.lit(seed + round_ + 1), F.col(column)).cast("double") / 2.0**64 + 0.5).alias("chance")
        found = vectors.select(column, drawn).mapInArrow(chosen, f"{column} array<double>").distinct()
        # about OVERSAMPLING * most different vectors
        new = [r[0] for r in found.collect()]
        taken = np.unique(np.concatenate([taken, np.array(new, float).reshape(len(new), taken.shape[1])]), axis=0)
    (size, _, _), = _sums(vectors, column, [taken])
    return taken, size


def _first_centres(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """The best of several draws of k-means++ over weighted points, each mended by a few rounds over the points."""
    best = None
    k = min(k, len(points))
    for draw in range(DRAWS):
        pick = np.random.default_rng((seed, k, draw))
        centres = points[pick.choice(len(points), p=weights / weights.sum())][None]
        while len(centres) < k:
            chance = weights * _squares(points, centres).min(axis=1)
            if chance.sum() <= 0:
                break
            centres = np.vstack([centres, points[pick.choice(len(points), p=chance / chance.sum())]])
        for _ in range(30):
            nearest = _squares(points, centres).argmin(axis=1)
            size = np.bincount(nearest, weights, len(centres))
            sums = np.zeros(centres.shape)
            np.add.at(sums, nearest, points * weights[:, None])
            moved = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-300)[:, None], centres)
            if np.allclose(moved, centres, atol=1e-12):
                break
            centres = moved
        cost = (weights * _squares(points, centres).min(axis=1)).sum()
        if best is None or cost < best[0]:
            best = cost, centres
    return best[1]


def kmeans(
    vectors: DataFrame, ks: Sequence[int], column: str, seed: int = 0, rounds: int = ROUNDS, tolerance: float = TOLERANCE
) -> dict[int, Fit]:
    """Centres for each number of clusters in ``ks`` of the ``array<double>`` vectors of a stored table.

    The candidates for first centres are chosen once for all numbers. A round scores every vector against the centres of
    all numbers and sums up by number and cluster inside the tasks, so the driver gets one row per centre. A number is done
    when a round has lowered its inertia by no more than the share ``tolerance``. With fewer different vectors than clusters there are fewer centres;
    without vectors there are none.
    """
    ship_package(vectors.sparkSession)
    points, weights = _candidates(vectors, column, max(ks), seed)
    if not len(points):
        return {k: Fit(np.zeros((0, 0)), 0.0) for k in ks}
    centres = {k: _first_centres(points, weights, k, seed) for k in ks}
    moving, before = list(ks), dict.fromkeys(ks, np.inf)
    for _ in range(rounds):
        if not moving:
            break
        found = _sums(vectors, column, [centres[k] for k in moving])
        still = []
        for k, (size, total, inertia) in zip(moving, found, strict=True):
            centres[k] = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres[k])
            if before[k] - inertia > tolerance * inertia:
                still.append(k)
            before[k] = inertia
        moving = still
    final = _sums(vectors, column, [centres[k] for k in ks])
    return {k: Fit(centres[k], inertia) for k, (_, _, inertia) in zip(ks, final, strict=True)}
