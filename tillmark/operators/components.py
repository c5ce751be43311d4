"""Connected components by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillmark.operators.skew import join_unique
from tillmark.staging import stage


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, label``: for each node of ``edges`` the smallest node it is connected with (an action).

    A round takes the smallest label among a node and its neighbours and then the label of that
    label, which halves the way that is left. Rounds are written tables; no node or label but a
    yes or no reaches the driver. A label that a large component shares is met without one hot task.
    """
    there, back = edges.select(F.col(a).alias("x"), F.col(b).alias("y")), edges.select(F.col(b).alias("x"), F.col(a).alias("y"))
    links = stage(there.union(back).where("x <> y").distinct(), "links")
    labels = stage(links.groupBy("x").agg(F.min("y").alias("y")).select(F.col("x").alias("node"), F.least("x", "y").alias("label")), "labels")
    while True:
        beside = join_unique(links, labels.select(F.col("node").alias("y"), "label"), ["y"])
        best = beside.groupBy("x").agg(F.min("label").alias("best")).withColumnRenamed("x", "node")
        moved = stage(labels.join(best, "node").select("node", F.col("label").alias("old"), F.least("label", "best").alias("label")), "moved")
        step = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        after = stage(join_unique(moved, step, ["label"]).select("node", "old", F.least("label", "beyond").alias("label")), "labels")
        labels = after.select("node", "label")
        if after.where(F.col("label") < F.col("old")).isEmpty():
            return labels
