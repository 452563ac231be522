"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from themata.cluster import materialise


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; a component is named by its smallest node.

    Every round points each node to its smallest neighbour, follows the pointers to their roots, and keeps only
    edges between different roots; at least half the roots of a component go each round. All steps are combined
    aggregates and equi-joins over stored tables, so hubs are pre-aggregated or split by adaptive joins.
    """
    edges = materialise(edges.where("a <> b").select("a", "b").distinct())
    mapping = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")))
        parents = _follow(parents)
        if mapping is None:
            mapping = parents
        else:
            step = parents.select(F.col("node").alias("component"), F.col("component").alias("root"))
            joined = mapping.join(step, "component", "left")
            mapping = materialise(joined.select("node", F.coalesce("root", "component").alias("component")))
        edges = materialise(_renamed(_renamed(edges, parents, "a"), parents, "b").where("a <> b").distinct())
        if edges.isEmpty():
            return mapping


def _renamed(edges: DataFrame, parents: DataFrame, side: str) -> DataFrame:
    names = parents.select(F.col("node").alias(side), F.col("component").alias("root"))
    return edges.join(names, side).drop(side).withColumnRenamed("root", side).select("a", "b")


def _follow(parents: DataFrame) -> DataFrame:
    """Pointers replaced by the roots they lead to."""
    while True:
        above = parents.select(F.col("node").alias("component"), F.col("component").alias("root"))
        jumped = materialise(parents.join(above, "component").select("node", F.col("root").alias("component"), (F.col("root") != F.col("component")).alias("moved")))
        parents = jumped.select("node", "component")
        if jumped.where("moved").isEmpty():
            return parents
