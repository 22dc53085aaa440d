"""Connected components of an edge table, by smallest label with pointer jumping; tables between the rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.workspace import Workspace


def connected_components(edges: DataFrame, ws: Workspace) -> DataFrame:
    """(node, component) for every node of the edges ``a``, ``b``; component is the smallest node reachable.

    Each round a node takes the smallest label among its neighbours', those offered to nodes that it is the
    label of, and its own label's label, so the number of rounds follows the logarithm of a path's length in
    practice. Labels are pre-aggregated before they move, so a node with many edges, or a label that many
    nodes have, costs its task no more than others. A round writes one table.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    both = ws.save(both.filter("a <> b").distinct(), "edges")
    labels = ws.save(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node"))
        offered = labels.join(near.agg(F.min("component").alias("offer")), "node")
        own = F.struct("node", F.least("component", "offer").alias("offer"), F.col("component").alias("old"))
        told = F.struct(F.col("component").alias("node"), "offer", F.lit(None).cast("long").alias("old"))
        offered = offered.select(F.inline(F.array(own, told))).groupBy("node").agg(F.min("offer").alias("offer"), F.max("old").alias("old"))
        jump = labels.select(F.col("node").alias("old"), F.col("component").alias("further"))
        merged = offered.join(jump, "old", "left").select("node", F.least("offer", "further").alias("component"), "old")
        labels, seen = ws.save_measured(merged, "labels", changed=F.coalesce(F.sum((F.col("component") != F.col("old")).cast("long")), F.lit(0)))
        labels = labels.select("node", "component")
        if not seen.get("changed"):
            return labels
