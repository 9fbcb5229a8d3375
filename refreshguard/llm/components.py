"""Connected components of a graph of links, without the graph in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that links (a, b) reach from each linked node.

    Each round takes the least label among the neighbours and then the label of
    that label, so long chains shorten by half.  Rounds are written to the
    shared folder; the loop ends when no label changed.
    """
    pairs = links.select("a", "b").filter("a <> b")
    both = stored(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .dropDuplicates(["a", "b"]), "links")
    labels = stored(both.groupBy(F.col("a").alias("node"))
                    .agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a")
                .agg(F.min("component").alias("near")))
        lower = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("component").alias("old"),
            F.least("component", "near").alias("label"))
        roots = labels.select(F.col("node").alias("label"), F.col("component").alias("root"))
        labels = stored(lower.join(roots, "label", "left").select(
            "node", "old", F.least("label", "root").alias("component")), "labels")
        if labels.filter("component < old").isEmpty():
            return labels.select("node", "component")
