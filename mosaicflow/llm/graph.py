"""Connected components of an edge table, without gathering edges anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of edges (a, b): component is the smallest node that edges lead to.

    Each round takes the least label of the neighbours and then the label's own label, so that chains halve; labels
    are written to the shared folder after every round. No edges give no rows; self-loops and repeats do no harm.
    """
    both = edges.select("a", "b").filter("a <> b")
    both = stored(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    while True:
        known = labels.select(F.col("node").alias("b"), F.col("component").alias("label"))
        near = both.join(known, "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.least("component", "near").alias("to"), F.col("component").alias("was"))
        up = labels.select(F.col("node").alias("to"), F.col("component").alias("top"))
        new = stored(lower.join(up, "to").select("node", F.least("to", "top").alias("component"), "was"), "labels")
        moved = new.filter("component <> was").limit(1).count()
        drop_stored(labels)
        labels = new
        if not moved:
            drop_stored(both)
            return labels.select("node", "component")
