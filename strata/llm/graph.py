"""Connected components as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm._util import cut


def components(links: DataFrame) -> DataFrame:
    """(node, label): for each node of ``links`` (a, b) the least node that it reaches.

    Each round takes the least label among the neighbours and then follows labels one
    step (pointer jumping), so chains halve in length. The state of a round is a written
    table; nothing but the number of changed rows comes to the driver.
    """
    edges = cut(links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
                .where("a <> b").distinct(), "edges")
    labels = cut(edges.groupBy(F.col("a").alias("node"))
                 .agg(F.least(F.min("b"), F.first("a")).alias("label"))
                 .select("node", "label", F.lit(True).alias("moved")), "labels")
    while not labels.where("moved").isEmpty():
        near = (edges.join(labels, edges.b == labels.node)
                .groupBy("a").agg(F.min("label").alias("near")))
        step = (labels.join(near, labels.node == near.a)
                .select("node", F.col("label").alias("old"),
                        F.least("label", "near").alias("label")))
        to = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = cut(step.join(to, "label", "left")
                     .select("node", F.least("label", F.coalesce("next", "label")).alias("label"), "old")
                     .select("node", "label", (F.col("label") < F.col("old")).alias("moved")),
                     "labels")
    return labels.select("node", "label")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) with the components joined that ``links`` (a, b) connect.

    Only the graph of the components is walked. A node without a label is its own.
    """
    a, b = labels.toDF("a", "from_label"), labels.toDF("b", "to_label")
    between = (links.join(a, "a", "left").join(b, "b", "left")
               .select(F.coalesce("from_label", "a").alias("a"), F.coalesce("to_label", "b").alias("b"))
               .where("a <> b").distinct())
    joined = components(between).toDF("label", "joined")
    old = labels.join(joined, "label", "left").select("node", F.coalesce("joined", "label").alias("label"))
    # a label is itself a node; those that had no row are new
    new = joined.join(labels.select(F.col("node").alias("label")), "label", "left_anti").toDF("node", "label")
    return old.union(new)
