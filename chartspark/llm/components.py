"""Connected components of a graph given as links between long integers."""

from pyspark.sql import DataFrame, functions as F

from chartspark.sources.storage import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b) but the roots; a root is a component's smallest node.

    Each round hooks every node to its smallest smaller neighbour, shortens the chains to their ends by pointer jumping
    and joins what is linked still between different ends. At least one of any two linked nodes goes with each round, so
    their number falls quickly. Every step is stored, and joins have stored tables on both sides, so that adaptive
    execution splits a node with very many links. Only "is anything left" comes to the driver.
    """
    left = materialise(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    )
    rounds = []
    while not left.isEmpty():
        roots = _shortened(materialise(left.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))))
        rounds.append(roots)
        left = materialise(_moved(_moved(left, "a", roots), "b", roots).filter("a != b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        ).distinct())
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    known = rounds[0]
    for roots in rounds[1:]:
        known = materialise(_moved(known, "root", roots).unionByName(roots))
    return known


def _moved(rows: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    """``rows`` with the column's nodes replaced by their roots."""
    to = roots.select(F.col("node").alias(column), F.col("root").alias("_to"))
    return rows.join(to, column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to")


def _shortened(parents: DataFrame) -> DataFrame:
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = materialise(parents.join(up, "root", "left").select("node", F.coalesce("next", "root").alias("root"), "next"))
        parents = jumped.select("node", "root")
        if jumped.filter("next IS NOT NULL").isEmpty():
            return parents
