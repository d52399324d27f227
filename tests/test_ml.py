import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array

from chartspark.operators import kmeans as km
from chartspark.operators import ml
from chartspark.plans.workload import QUERIES

FEATURES = ["a", "b", "c", "flat"]


@pytest.fixture(scope="module")
def songs(spark):
    values = np.random.default_rng(3).normal(size=(300, 3))
    values[:100] += 6
    values[100:200, 0] -= 6
    data = [(i, *map(float, v), 4.0, f"g{i % 2}") for i, v in enumerate(values)]
    data.append((-1, None, 0.0, 0.0, 4.0, "g0"))
    return spark.createDataFrame(data, "id int, a double, b double, c double, flat double, genre string")


def scaled(songs):
    table = songs.filter("id >= 0").orderBy("id").toPandas()[["a", "b", "c"]].to_numpy()
    spread = (table - table.min(axis=0)) / (table.max(axis=0) - table.min(axis=0))
    return np.hstack([spread, np.zeros((len(table), 1))])


def test_scaled_vectors(songs):
    rows = ml.scaled_vectors(songs, FEATURES).select("id", vector_to_array(ml.VECTOR).alias("v")).orderBy("id").collect()
    np.testing.assert_allclose([r.v for r in rows], scaled(songs), atol=1e-12)


def test_components_match_a_singular_value_decomposition(songs):
    rows = ml.with_components(ml.scaled_vectors(songs, FEATURES)).orderBy("id").collect()
    found = np.array([(r.Component_1, r.Component_2) for r in rows])
    centred = scaled(songs) - scaled(songs).mean(axis=0)
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    np.testing.assert_allclose(np.abs(found), np.abs(centred @ axes[:2].T), atol=1e-9)
    with pytest.raises(ValueError):
        ml.with_components(songs, method="tsne")


def test_clusters(songs):
    vectors = ml.scaled_vectors(songs, FEATURES)
    first = [r.Cluster for r in ml.with_clusters(vectors, k=3).orderBy("id").collect()]
    second = [r.Cluster for r in ml.with_clusters(vectors, k=3).orderBy("id").collect()]
    assert first == second and len(first) == 300
    # the three blobs are told apart
    assert all(len(set(first[i:i + 100])) == 1 for i in (0, 100, 200)) and len(set(first)) == 3


def test_enhanced_songs_and_profile(songs):
    enhanced = ml.enhanced_songs(songs, FEATURES, k=3)
    assert enhanced.columns == [*songs.columns, "Component_1", "Component_2", "Cluster"]
    profile = ml.cluster_profile(enhanced).collect()
    assert sum(r.n_songs for r in profile) == 300
    assert len(profile) == 6


def test_elbow_falls(songs):
    curve = ml.elbow_curve(ml.scaled_vectors(songs, FEATURES), range(2, 7)).orderBy("k").collect()
    assert [r.k for r in curve] == [2, 3, 4, 5, 6]
    assert all(b.inertia <= a.inertia * 1.05 for a, b in zip(curve, curve[1:]))


def plain_kmeans(points, centres, rounds=20):
    """Lloyd's rounds, one point after the other."""
    for _ in range(rounds):
        nearest = [min(range(len(centres)), key=lambda c: ((p - centres[c]) ** 2).sum()) for p in points]
        centres = np.array([points[[n == c for n in nearest]].mean(axis=0) if c in nearest else centres[c] for c in range(len(centres))])
    return centres, sum(((p - centres).__pow__(2)).sum(axis=1).min() for p in points)


def test_one_scan_a_round_gives_what_plain_rounds_give(spark, songs, monkeypatch):
    points = scaled(songs)[:, :3]
    stored = spark.createDataFrame([(list(map(float, p)),) for p in points], "v array<double>").repartition(5).cache()
    first = points[:5]
    found = km._sums(stored, "v", [first[:2], first])
    for (size, total, inertia), centres in zip(found, (first[:2], first), strict=True):
        squares = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
        nearest = squares.argmin(axis=1)
        np.testing.assert_array_equal(size, np.bincount(nearest, minlength=len(centres)))
        np.testing.assert_allclose(total, [points[nearest == c].sum(axis=0) for c in range(len(centres))], atol=1e-9)
        assert inertia == pytest.approx(squares.min(axis=1).sum())
    monkeypatch.setattr(km, "_first_centres", lambda p, w, k, seed: first[:k])
    fits = km.kmeans(stored, [2, 5], "v", tolerance=0.0)
    for k, fit in fits.items():
        centres, inertia = plain_kmeans(points, first[:k])
        np.testing.assert_allclose(fit.centres, centres, atol=1e-9)
        assert fit.inertia == pytest.approx(inertia)
    stored.unpersist()


def test_all_numbers_of_clusters_are_as_good_as_one_by_one(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select(array_to_vector("embedding").alias(ml.VECTOR)).cache()
    curve = {r.k: r.inertia for r in ml.elbow_curve(vectors).collect()}
    assert sorted(curve) == list(range(2, 21))
    for k, inertia in curve.items():
        assert inertia <= KMeans(k=k, seed=42, featuresCol=ml.VECTOR).fit(vectors).summary.trainingCost * 1.01
    vectors.unpersist()


def test_jobs_do_not_grow_with_the_numbers_of_clusters(spark, songs):
    stored = ml.scaled_vectors(songs, FEATURES).select(vector_to_array(ml.VECTOR).alias("v")).cache()
    calls = []
    sums = km._sums

    def counting(vectors, column, groups):
        calls.append(len(groups))
        return sums(vectors, column, groups)

    km._sums = counting
    try:
        km.kmeans(stored, range(2, 21), "v", rounds=6)
    finally:
        km._sums = sums
    assert len(calls) <= km.CANDIDATE_ROUNDS + 1 + 6 + 1 and max(calls) == 19
    stored.unpersist()


def test_few_or_no_vectors(spark):
    same = spark.createDataFrame([([1.0, 2.0],)] * 5 + [([3.0, 2.0],)] * 2, "v array<double>")
    fits = km.kmeans(same, [1, 2, 4], "v")
    assert [len(fits[k].centres) for k in (1, 2, 4)] == [1, 2, 2]
    assert fits[2].inertia == pytest.approx(0) and fits[1].inertia == pytest.approx(4 * 5 * 2 / 7)
    assert km.kmeans(same.limit(0), [2], "v")[2].inertia == 0


def test_landmarks_keep_all_distances_in_a_plane(spark):
    made = np.random.default_rng(5)
    plane = made.normal(size=(400, 2)) @ made.normal(size=(2, 7)) + made.normal(size=7)
    frame = spark.createDataFrame([(i, list(map(float, p))) for i, p in enumerate(plane)], "id int, v array<double>")
    vectors = frame.withColumn(ml.VECTOR, array_to_vector("v")).drop("v")
    placed = ml.with_components(vectors, 2, "landmarks")
    assert placed.columns == ["id", ml.VECTOR, "Component_1", "Component_2"]
    rows = placed.orderBy("id").collect()
    found = np.array([(r.Component_1, r.Component_2) for r in rows])
    gaps = lambda x: np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.testing.assert_allclose(gaps(found), gaps(plane), atol=1e-6)
    np.testing.assert_allclose([r[ml.VECTOR].toArray() for r in rows], plane)


def test_more_dimensions_than_landmarks_have(spark):
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(3)], "id int, v array<double>")
    vectors = line.withColumn(ml.VECTOR, array_to_vector("v")).drop("v")
    rows = ml.with_components(vectors, 4, "landmarks").orderBy("id").collect()
    assert [abs(rows[i].Component_1 - rows[0].Component_1) for i in range(3)] == pytest.approx([0, 5**0.5, 2 * 5**0.5])
    assert all(abs(r[f"Component_{i}"]) < 1e-6 for r in rows for i in (2, 3, 4))
    assert ml.with_components(vectors.limit(0), 2, "landmarks").count() == 0


def test_components_profile_and_clusters_reach_the_queries(spark):
    folder = "/root/testdata/sf0.001"
    rows = QUERIES["kmeans_rows"](spark, folder).collect()
    points = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    members = {c: [r.vec_id for r in rows if r.Cluster == c] for c in {r.Cluster for r in rows}}
    centres = {c: np.mean([points[i] for i in ids], axis=0) for c, ids in members.items()}
    # the rounds may end before the centres stand still: nearly all are nearest to the mean of their own
    own = [min(centres, key=lambda c: ((points[r.vec_id] - centres[c]) ** 2).sum()) == r.Cluster for r in rows]
    assert len(rows) == len(points) and np.mean(own) > 0.95
    places = QUERIES["pca_layout"](spark, folder).collect()
    matrix = np.array([points[r.vec_id] for r in places])
    _, _, axes = np.linalg.svd(matrix - matrix.mean(axis=0), full_matrices=False)
    found = np.array([(r.Component_1, r.Component_2) for r in places])
    np.testing.assert_allclose(np.abs(found), np.abs((matrix - matrix.mean(axis=0)) @ axes[:2].T), atol=1e-6)
    curve = QUERIES["elbow_inertia"](spark, folder).orderBy("k").collect()
    assert curve[0].gain is None and all(r.inertia > 0 for r in curve)
    profile = QUERIES["cluster_profile"](spark, folder).collect()
    assert {r.Cluster for r in profile} <= set(range(7)) and sum(r.n_songs for r in profile) > 7
    assert all(r.avg_Component_1 is not None for r in profile)
