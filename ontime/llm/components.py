"""Connected components of a link table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of a link; label is the smallest node reachable.

    Each round takes the smallest label among a node's neighbours and then follows labels
    of labels, so long chains shrink by half or more. Labels are written to the shared
    folder each round. Hubs are pre-aggregated by the partial minimum, and the joins can be
    split by the adaptive skew join.
    """
    pairs = links.select(F.col(a).alias("node"), F.col(b).alias("other")).filter("node <> other")
    edges = staged(pairs.union(pairs.select("other", "node")).distinct(), "edges")
    labels = staged(edges.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")), "labels")
    while True:
        near = (edges.join(labels.toDF("other", "label"), "other").groupBy("node").agg(F.min("label").alias("near")))
        lower = labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        jump = labels.toDF("to", "further")
        new = staged(lower.join(jump, F.col("label") == F.col("to"), "left").select(
            "node", F.least("label", F.coalesce("further", "label")).alias("label"), "was"), "labels")
        labels = new.select("node", "label")
        if new.filter("label <> was").isEmpty():
            return labels
