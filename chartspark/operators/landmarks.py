"""Layouts by distances to landmarks: multidimensional scaling of a bounded number of rows, by which all others are placed."""

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from chartspark.operators.kmeans import _matrix, _squares
from chartspark.session import ship_package

#: Rows that are landmarks if none are given: they are held by the driver and sent to the tasks.
LANDMARKS = 200


def chosen_landmarks(vectors: DataFrame, vector: str, n: int = LANDMARKS) -> np.ndarray:
    """Different vectors, those with the smallest hashes; all of them if there are no more than ``n``."""
    values = vectors.select(vector_to_array(vector).alias("v")).distinct()
    return np.array([r.v for r in values.orderBy(F.xxhash64("v"), "v").limit(n).collect()])


def layout(landmarks: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, operator, mean squares): classical scaling of the landmarks in n dimensions, and what places others.

    A vector with squared distances s to the landmarks is at -(operator @ (s - mean squares)) / 2. Dimensions that the
    landmarks do not have are 0.
    """
    squares = _squares(landmarks, landmarks)
    centred = squares - squares.mean(axis=0) - squares.mean(axis=1)[:, None] + squares.mean()
    values, axes = np.linalg.eigh(-centred / 2)
    order = np.argsort(-values)[:n]
    values, axes = values[order], axes[:, order]
    # the sign that makes the largest part of an axis positive, so that equal landmarks give equal layouts
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1, 1)
    real = values > max(1e-12, values.max(initial=0) * 1e-12)
    root = np.where(real, np.sqrt(np.maximum(values, 1e-300)), np.inf)
    operator = (axes / root).T
    positions = axes * np.where(real, root, 0)
    if len(order) < n:
        more = n - len(order)
        operator, positions = np.pad(operator, ((0, more), (0, 0))), np.pad(positions, ((0, 0), (0, more)))
    return positions, operator, squares.mean(axis=0)


def with_landmark_components(
    vectors: DataFrame, n: int, prefix: str, vector: str, landmarks: np.ndarray | None = None
) -> DataFrame:
    """Add n coordinates that keep the distances to the landmarks as well as n dimensions can.

    Where the vectors lie in n dimensions all distances are kept. Every row is placed by its own distances, so this is
    one pass without a shuffle; the landmarks are few, whatever the number of rows.
    """
    landmarks = chosen_landmarks(vectors, vector) if landmarks is None else np.asarray(landmarks, float)
    if not len(landmarks):
        return vectors.withColumns({f"{prefix}{i + 1}": F.lit(0.0) for i in range(n)})
    ship_package(vectors.sparkSession)
    _, operator, mean = layout(landmarks, n)
    shared = vectors.sparkSession.sparkContext.broadcast((landmarks, operator, mean))
    held, added = "_landmark_vector", [f"{prefix}{i + 1}" for i in range(n)]

    def put(batches):
        landmarks, operator, mean = shared.value
        for batch in batches:
            places = -((_squares(_matrix(batch, held), landmarks) - mean) @ operator.T) / 2
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(p) for p in places.T)], names=[*batch.schema.names, *added]
            )

    # a vector has no Arrow form: it goes as an array and is made again from it
    plain = vectors.withColumn(held, vector_to_array(vector)).drop(vector)
    schema = StructType([*plain.schema.fields, *[StructField(name, DoubleType()) for name in added]])
    return plain.mapInArrow(put, schema).withColumn(vector, array_to_vector(held)).select(*vectors.columns, *added)
