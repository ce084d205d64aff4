"""Connected components of links, by the least label and pointer jumping, in written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgraph.scratch import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` of every node of ``(a, b)``: the label is the least node of the component.

    Each round takes the least label of a node's neighbours and then the label of its
    label, so the rounds grow with the logarithm of a chain's length. A round is a
    table; only the number of changed labels comes to the driver.
    """
    links = links.where("a <> b")
    both = cut_lineage(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("node"), "label")
    labels = cut_lineage(labels)
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        lower = cut_lineage(
            labels.join(near.withColumnRenamed("a", "node"), "node", "left").select("node", "label", F.least("label", F.coalesce("near", "label")).alias("lower"))
        )
        jump = lower.select(F.col("node").alias("lower"), F.col("lower").alias("jumped"))
        after = cut_lineage(
            lower.join(jump, "lower", "left").select("node", F.least("lower", F.coalesce("jumped", "lower")).alias("new"), "label")
        )
        labels = after.select("node", F.col("new").alias("label"))
        if after.where("new <> label").limit(1).count() == 0:
            return labels
