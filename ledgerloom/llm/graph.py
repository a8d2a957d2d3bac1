"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .durable import cut


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) for all nodes of ``edges`` (a, b).

    Each round gives a node the smallest label around it, then the label of that label, so
    chains halve; rounds end when nothing changes.  Labels are kept in the checkpoint
    folder.  No node's edges are ever gathered: minima are taken before shuffling.  Loops
    and repeated edges are as one; edges with a null end are none; no edges, no nodes.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct())
    labels = cut(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).select(F.col("a").alias("node"), "label"))
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near, labels.node == near.a).select("node", F.least("label", "near").alias("to"), F.col("label").alias("was"))
        up = labels.select(F.col("node").alias("to"), F.col("label").alias("up"))
        after = cut(hooked.join(up, "to", "left").select("node", F.least("to", F.coalesce("up", "to")).alias("label"), "was"))
        changed = after.filter("label <> was").limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")
