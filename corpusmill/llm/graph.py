"""Connected components of large graphs, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, join_keyed, materialize

MAX_ROUNDS = 64


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest node.

    Each round gives every node the smallest label among its neighbours and then
    follows labels of labels, so a chain of n nodes takes about log n rounds. Only
    a count comes to the driver. Every round is written to the shared folder, and
    that before it deleted. Nodes with very many neighbours and labels that very
    many nodes share are joined by broadcast.
    No links give no rows; links from a node to itself count as a node.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct()
    both = materialize(both, "links")
    first = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component"), F.count(F.lit(1)).alias("n"))
    labels = materialize(first, "labels")
    for _ in range(MAX_ROUNDS):
        told = join_keyed(both, labels.withColumnRenamed("node", "other"), "other", "n")
        heard = told.groupBy("node").agg(F.min("component").alias("heard"))
        nearer = labels.join(heard, "node").select("node", "n", F.least("component", "heard").alias("via"), F.col("component").alias("before"))
        nearer = materialize(nearer, "nearer")
        shared = nearer.groupBy("via").agg(F.count(F.lit(1)).alias("sharing"))
        jump = materialize(shared.join(labels.select(F.col("node").alias("via"), F.col("component").alias("next")), "via"), "jump")
        after = join_keyed(nearer, jump, "via", "sharing").select("node", F.least("via", "next").alias("component"), "before", "n")
        after = materialize(after, "labels")
        forget(labels, nearer, jump)
        changed = after.where("component <> before").limit(1).count()
        labels = after.drop("before")
        if not changed:
            forget(both)
            return labels.select("node", "component")
    raise RuntimeError("components did not settle")
