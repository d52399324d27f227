"""Exact nearest vectors by inner product: histograms of all scores locate each query's k-th value."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from chartspark.llm.common import in_arrow

#: Queries held by a task at a time; the list of them is what is broadcast. More queries take more passes.
QUERIES = 8192
#: Scores computed at a time in a task.
SCORES = 1 << 21
#: Bins of a histogram: a pass narrows a k-th value down to a range so many times smaller.
BINS = 4096
#: Integers up to here are exact in double precision.
EXACT = 1 << 53
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def quantised(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(key, v): floor(scale * x) of every component, as doubles; vectors that are NULL or hold NULL, NaN or infinity
    are left out, and so are empty ones."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    # the whole numbers a double can hold; floor() to a long would fail beyond its range
    floored = F.transform(x, lambda c: F.when(F.abs(c) < 2.0**44, F.floor(c * scale).cast("double")).otherwise(F.least(F.greatest(c, F.lit(-1e300)), F.lit(1e300)) * scale))
    return vectors.filter(F.col(vector).isNotNull() & (F.size(vector) > 0)).filter(good).select(
        F.col(key).alias("key"), floored.alias("v")
    )


def _matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    """One row each; shorter vectors are filled up with zeros, longer ones lose what no query has."""
    offsets, flat = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    if (sizes == width).all():
        return flat[offsets[0] : offsets[-1]].reshape(-1, width)
    taken = np.minimum(sizes, width)
    place = np.arange(taken.sum()) - np.repeat(np.cumsum(taken) - taken, taken)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), taken), place] = flat[np.repeat(offsets[:-1], taken) + place]
    return out


def _products(queries, vectors):
    """Integer inner products. Sums beyond 2 ** 53 are added up without loss, and held at the ends of a long."""
    with np.errstate(over="ignore"):
        bound = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * queries.shape[1]
    if bound < EXACT:
        return (queries @ vectors.T).astype(np.int64)
    whole = lambda m: [[int(x) for x in row] for row in m.tolist()]
    left, right = whole(queries), whole(vectors)
    return np.array(
        [[min(max(sum(a * b for a, b in zip(q, v)), _LEAST), _MOST) for v in right] for q in left], np.int64
    ).reshape(len(left), len(right))


def _scored(batches, queries):
    """(keys, own, scores) by blocks: scores[i, j] of query i and vector j; own marks a query's own row."""
    for batch in batches:
        keys = batch.column("key")
        values = batch.column("v")
        step = max(1, SCORES // max(1, len(queries["keys"])))
        numbers = np.array([_MOST if k is None else k for k in keys.to_pylist()], np.int64)
        null = np.array(keys.is_null().to_numpy(zero_copy_only=False), bool)
        for i in range(0, batch.num_rows, step):
            block = _matrix(values.slice(i, step), queries["v"].shape[1])
            part = slice(i, i + len(block))
            own = (queries["keys"][:, None] == numbers[part][None, :]) & ~null[part][None, :]
            yield numbers[part], null[part], own, _products(queries["v"], block)


def _best(scores, own, k):
    """For each query, (query, vector) places of scores from its block's k-th best on, own rows left out."""
    usable = np.where(own, _LEAST, scores)
    k = min(k, usable.shape[1])
    least = np.partition(usable, usable.shape[1] - k, axis=1)[:, usable.shape[1] - k]
    return np.nonzero((usable >= least[:, None]) & ~own)


def top_k(
    vectors: DataFrame,
    queries,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    scale: int = 256,
) -> DataFrame:
    """Each query's ``k`` highest integer inner products with all other vectors: query_id, rank, vec_id, score.

    ``queries`` is a condition on the key. Components x become floor(scale * x). Vectors that are NULL, empty or hold
    NULL or non-finite components take no part. Ties go to the smaller key, a NULL key comes last. A row with the
    query's key is its own and no candidate; rows that share a query's key are queries each. Vectors of unlike lengths
    are compared in the components that both have. Fewer candidates than ``k`` are returned all.

    Queries are taken ``QUERIES`` at a time. For such a part the scores of all vectors are computed where the vectors
    are, and counted in histograms that are summed over the cluster; a bin below a task's own k-th value cannot hold the
    k-th value of all, so a task reports at most the bins of its ``k`` best. Each round looks into the bin that holds a
    query's k-th value, until that value is known. The last pass keeps the scores from there on, of ties with the k-th
    value those with the smallest keys of each block of vectors, and ranks them. Scores are computed anew in each pass
    and never stored.
    """
    spark = vectors.sparkSession
    whole = quantised(vectors, key, vector, scale)
    asked = whole.filter(queries)
    parts = max(1, -(-asked.count() // QUERIES))
    results = [_part(spark, whole, asked, i, parts, k) for i in range(parts)]
    result = results[0]
    for other in results[1:]:
        result = result.unionByName(other)
    return result


def _part(spark, whole, asked, part, parts, k):
    chosen = asked.filter(F.pmod(F.xxhash64("key", "v"), F.lit(parts)) == part).toArrow()
    values = chosen.column("v").combine_chunks()
    width = int(np.diff(values.offsets.to_numpy()).max(initial=1))
    held = {"keys": np.array(chosen.column("key").to_pylist(), np.int64), "v": _matrix(values, width)}
    n = len(held["keys"])
    # the sums of absolute values bound the scores
    most = whole.agg(F.max(F.array_max(F.transform("v", lambda c: F.abs(c))))).first()[0] or 0.0
    with np.errstate(over="ignore"):
        sums = np.abs(held["v"]).sum(axis=1) * most + 1
    bounds = [int(min(b, float(_MOST >> 2))) for b in sums.tolist()]
    low = np.array([-b for b in bounds], np.int64)
    width = np.array([-(-(2 * b + 1) // BINS) for b in bounds], np.int64)
    high = low + width * BINS  # the k-th value is from low on and below high
    above = np.zeros(n, np.int64)
    exact = np.zeros(n, bool)
    queries = spark.sparkContext.broadcast(held)
    while n and not exact.all():
        state = spark.sparkContext.broadcast((low.copy(), high.copy(), width.copy(), ~exact))

        def histogram(batches, queries=queries, state=state):
            low, high, width, open_ = state.value
            counted = {}
            for _, _, own, scores in _scored(batches, queries.value):
                q, v = _best(scores, own, k)
                q, v = q[open_[q]], v[open_[q]]
                bins = (np.clip(scores[q, v], low[q], None) - low[q]) // width[q]
                inside = (scores[q, v] >= low[q]) & (scores[q, v] < high[q])
                for item, times in zip(*np.unique(q[inside] * BINS + bins[inside], return_counts=True)):
                    counted[int(item)] = counted.get(int(item), 0) + int(times)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i // BINS for i in counted], pa.int64()), pa.array([i % BINS for i in counted], pa.int64()), pa.array(list(counted.values()), pa.int64())],
                names=["q", "bin", "n"],
            )

        counts = in_arrow(whole, histogram, "q long, bin long, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        best_first = Window.partitionBy("q").orderBy(F.desc("bin"))
        upto = counts.withColumn("upto", F.sum("n").over(best_first.rowsBetween(Window.unboundedPreceding, 0)))
        needed = spark.createDataFrame(
            pa.table({"q": np.arange(n), "needed": k - above}), schema="q long, needed long"
        )
        found = (
            upto.join(F.broadcast(needed), "q")
            .filter((F.col("upto") >= F.col("needed")) & (F.col("upto") - F.col("n") < F.col("needed")))
            .select("q", "bin", (F.col("upto") - F.col("n")).alias("over"))
            .toArrow()
        )
        at = found.column("q").to_numpy()
        short = np.setdiff1d(np.arange(n)[~exact], at)  # fewer candidates than k: all of them count
        exact[short] = True
        low[short] = _LEAST
        at_, bins, over = at, found.column("bin").to_numpy(), found.column("over").to_numpy()
        open_ = ~exact[at_]
        at_, bins, over = at_[open_], bins[open_], over[open_]
        low[at_] += bins * width[at_]
        high[at_] = low[at_] + width[at_]
        above[at_] += over
        done = width[at_] == 1
        exact[at_[done]] = True
        rest = at_[~done]
        width[rest] = -(-width[rest] // BINS)
    threshold = spark.sparkContext.broadcast(low)

    def kept(batches):
        for numbers, null, own, scores in _scored(batches, queries.value):
            q, v = np.nonzero((scores >= threshold.value[:, None]) & ~own)
            order = np.lexsort((numbers[v], null[v], -scores[q, v], q))
            q, v = q[order], v[order]
            first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, int)
            nth = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
            q, v = q[nth < k], v[nth < k]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(q, pa.int64()),
                    pa.array(queries.value["keys"][q], pa.int64()),
                    pa.array(numbers[v], pa.int64(), mask=null[v]),
                    pa.array(scores[q, v], pa.int64()),
                ],
                names=["q", "query_id", "vec_id", "score"],
            )

    order = Window.partitionBy("q").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return (
        in_arrow(whole, kept, "q long, query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
