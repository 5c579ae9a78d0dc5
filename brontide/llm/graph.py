"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brontide.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node with an edge.

    Each round takes the least label among a node's neighbours and then the label of that label, so
    that paths shorten twice as fast; the labels of a round are a table in the shared folder. Nulls
    and loops are left out.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    both = materialize(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("root")), "cc-labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("m"))
        own = labels.select(F.col("node").alias("a"), F.col("root").alias("old"))
        lower = near.join(own, "a").select(F.col("a").alias("node"), "old", F.least("m", "old").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("root").alias("far"))
        found = lower.join(jump, "mid").select("node", F.least("mid", "far").alias("root"), "old")
        found = materialize(found, "cc-labels")
        changed = found.filter("root <> old").limit(1).count()
        labels = found.select("node", "root")
        if not changed:
            return labels
