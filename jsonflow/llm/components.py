"""Connected components of a graph of document ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonflow.llm.common import stored


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, the larger node first."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _local_minima(edges: DataFrame) -> DataFrame:
    """``node, component``: where a walk to ever smaller neighbours ends, its length halved by each jump."""
    both = edges.select(F.col("a").alias("node"), "b").union(edges.select(F.col("b").alias("node"), F.col("a").alias("b")))
    hops = stored(both.groupBy("node").agg(F.least(F.min("b"), F.col("node")).alias("component")))
    while True:
        far = hops.select(F.col("node").alias("over"), F.col("component").alias("beyond"))
        jumped = stored(hops.join(far, hops["component"] == far["over"]).select("node", F.col("component").alias("old"), F.col("beyond").alias("component")))
        hops = jumped.select("node", "component")
        if jumped.where("old <> component").isEmpty():
            return hops


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node on an edge ``a, b``.

    In each round all nodes walk to a local minimum, and the graph is contracted to the minima, at
    most half of its nodes; rounds go on until no edge is left. A hub's edges are gone after the first
    round. Minima are reduced on the map side; what a round leaves is written.
    """
    edges, labels = stored(_oriented(edges)), None
    while True:
        hops = _local_minima(edges)
        if labels is None:
            labels = hops
        else:
            over = hops.select(F.col("node").alias("over"), F.col("component").alias("beyond"))
            labels = labels.join(over, labels["component"] == over["over"], "left")
            labels = stored(labels.select("node", F.coalesce("beyond", "component").alias("component")))
        for end in ("a", "b"):
            other = "b" if end == "a" else "a"
            moved = edges.join(hops, edges[end] == hops["node"])
            edges = moved.select(F.col("component").alias(end), other)
        edges = stored(_oriented(edges))
        if edges.isEmpty():
            return labels
