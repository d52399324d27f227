"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from chartspark.plans import inputs
from chartspark.plans.workload import QUERIES

FOLDER = "/root/testdata/sf0.001"
LAZY = sorted(set(QUERIES) - {
    "parquet_roundtrip", "publish_docs", "stream_ingest", "incremental_append", "kmeans_clusters", "pca_components",
    "elbow_curve", "cluster_genre", "kmeans_rows", "pca_layout", "elbow_inertia", "cluster_profile", "landmark_layout",
})


@pytest.fixture
def no_broadcast(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("name,charts", [("formatted_chart", 1), ("formatted_chart_b", 1), ("unioned_charts", 2), ("unique_items", 2)])
def test_a_chart_is_read_twice_at_most(spark, no_broadcast, name, charts):
    """Once for its extremes and last day, which come from one aggregate, and once for its rows."""
    assert plan(QUERIES[name](spark, FOLDER)).count("lineitem.parquet") <= 2 * charts


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_costly_operator(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow"):
        assert costly not in text


def test_top_n_is_cut_before_the_shuffle(spark):
    assert plan(QUERIES["chart_topn"](spark, FOLDER)).count("WindowGroupLimit") == 2


def test_filters_and_columns_reach_the_scan(spark):
    lines = inputs.table(spark, FOLDER, "lineitem").filter(F.col("l_quantity") <= 14).select("l_orderkey")
    text = lines._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "LessThanOrEqual(l_quantity,14.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text


def test_genre_performance_joins_aggregated_rows(spark):
    """The charts are reduced to a row per artist below the join with the artists."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["genre_performance"](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    lines = text.split("\n")
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert any("HashAggregate(keys=[artist" in line for line in lines[join + 1:join + 4])


def test_a_layout_by_landmarks_is_one_pass(spark):
    """Rows are placed on Arrow batches, the one Python step, and nothing is shuffled."""
    text = plan(QUERIES["landmark_layout"](spark, FOLDER))
    assert text.count("MapInArrow") == 1 and "Exchange" not in text
