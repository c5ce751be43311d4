"""Connected components by repeated joins; nothing but a count reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillmark.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node in ``edges`` (``a, b``): the smallest node it reaches (an action).

    Each round takes the smallest label among the neighbours and then the label of that label,
    so that paths shrink to half their length. Every round is written to the checkpoint folder:
    lineage stays short and lost executors cost one round at most. Loops and repeated edges do
    no harm; an empty table gives no rows.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = stage(both.distinct(), "links")
    labels = stage(links.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("label")), "labels")
    while True:
        seen = links.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("low"))
        nearer = labels.join(seen.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "low").alias("near")
        )
        of = labels.select(F.col("node").alias("near"), F.col("label").alias("next"))
        after = stage(
            nearer.join(of, "near").select("node", F.least("near", "next").alias("label"), "old"), "labels"
        )
        labels = after.select("node", "label")
        if after.where(F.col("label") < F.col("old")).isEmpty():
            return labels
