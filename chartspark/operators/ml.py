"""Clusters and low-dimensional layouts of songs with Spark ML."""

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from chartspark.fixed_values import ELBOW_RANGE, ML_CLUSTERS, ML_FEATURES, ML_SEED
from chartspark.functions.features import with_minmax
from chartspark.operators.kmeans import kmeans
from chartspark.operators.landmarks import with_landmark_components
from chartspark.operators.quality import complete_rows
from chartspark.sources.storage import materialise

VECTOR = "_features"


def scaled_features(df: DataFrame, features: Sequence[str] = ML_FEATURES, suffix: str = "_scaled") -> DataFrame:
    """The complete rows with every feature scaled to 0-1; a feature without spread becomes 0."""
    complete = complete_rows(df, features)
    return with_minmax(complete, {c: f"{c}{suffix}" for c in features}, constant=0.0)


def scaled_vectors(df: DataFrame, features: Sequence[str] = ML_FEATURES) -> DataFrame:
    """The complete rows with their scaled features as one vector. ``df`` should be stored: every fit reads it again."""
    scaled = [f"_scaled_{i}" for i in range(len(features))]
    rows = with_minmax(complete_rows(df, features), dict(zip(features, scaled)), constant=0.0)
    return VectorAssembler(inputCols=scaled, outputCol=VECTOR).transform(rows).drop(*scaled)


def clusters(vectors: DataFrame, k: int = ML_CLUSTERS, seed: int = ML_SEED, out: str = "Cluster", vector: str = VECTOR):
    """The fitted model."""
    return KMeans(k=k, seed=seed, featuresCol=vector, predictionCol=out).fit(vectors)


def with_clusters(
    vectors: DataFrame, k: int = ML_CLUSTERS, seed: int = ML_SEED, out: str = "Cluster", vector: str = VECTOR
) -> DataFrame:
    return clusters(vectors, k, seed, out, vector).transform(vectors)


def with_components(
    vectors: DataFrame, n: int = 2, method: str = "pca", prefix: str = "Component_", vector: str = VECTOR
) -> DataFrame:
    """Add coordinates in n dimensions: the centred scores of the first principal components (``pca``), or places that
    keep the distances to a bounded number of landmarks (``landmarks``)."""
    if method == "landmarks":
        return with_landmark_components(vectors, n, prefix, vector)
    if method != "pca":
        raise ValueError(f"unknown method: {method}")
    centre = StandardScaler(inputCol=vector, outputCol="_centred", withMean=True, withStd=False).fit(vectors)
    centred = centre.transform(vectors)
    scores = PCA(k=n, inputCol="_centred", outputCol="_scores").fit(centred).transform(centred)
    values = vector_to_array("_scores")
    return scores.withColumns({f"{prefix}{i + 1}": values[i] for i in range(n)}).drop("_centred", "_scores")


def enhanced_songs(
    songs: DataFrame,
    features: Sequence[str] = ML_FEATURES,
    n_components: int = 2,
    k: int = ML_CLUSTERS,
    seed: int = ML_SEED,
    method: str = "pca",
) -> DataFrame:
    """The songs with all features, their components and cluster. Their vectors are stored once: the fits scan them."""
    vectors = scaled_vectors(songs, features)
    held = materialise(vectors.withColumn(VECTOR, vector_to_array(VECTOR)))
    vectors = held.withColumn(VECTOR, array_to_vector(VECTOR))
    return vectors.transform(with_components, n_components, method).transform(with_clusters, k, seed).drop(VECTOR)


def elbow_curve(
    vectors: DataFrame, ks: Sequence[int] | None = None, seed: int = ML_SEED, vector: str = VECTOR
) -> DataFrame:
    """Inertia for each number of clusters. The vectors are stored once; a round scans them once for all numbers."""
    low, high = ELBOW_RANGE
    ks = list(range(low, high + 1) if ks is None else ks)
    stored = materialise(vectors.select(vector_to_array(vector).alias("v")))
    curve = [(k, fit.inertia) for k, fit in kmeans(stored, ks, "v", seed).items()]
    return vectors.sparkSession.createDataFrame(curve, "k int, inertia double")


def cluster_profile(
    songs: DataFrame, label: str = "genre", cluster: str = "Cluster", components: Sequence[str] = ("Component_1", "Component_2")
) -> DataFrame:
    """Songs and average position of each cluster and genre."""
    return songs.groupBy(cluster, label).agg(
        F.count("*").alias("n_songs"), *[F.avg(c).alias(f"avg_{c}") for c in components]
    )
