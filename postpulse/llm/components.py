"""Connected components as iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for all nodes of the edges (a, b): the smallest node of
    the component. In each round a node takes the least label among itself and
    its neighbours, then its label's label; only the node with very many
    neighbours is hot, and its labels are reduced before the shuffle."""
    links = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = stage(links.distinct(), "cc-links")
    labels = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    labels = stage(labels.select("node", F.least("node", "least").alias("label")), "cc-labels")
    while True:
        near = (
            links.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("least"))
        )
        hooked = labels.join(near, "node").select(
            "node", F.col("label").alias("before"), F.least("label", "least").alias("label")
        )
        up = hooked.select(F.col("node").alias("label"), F.col("label").alias("above"))
        moved = hooked.join(up, "label", "left").select(
            "node", "before", F.least("label", F.coalesce("above", "label")).alias("label")
        )
        moved = stage(moved, "cc-labels")
        labels = moved.select("node", "label")
        if moved.filter(F.col("before") != F.col("label")).isEmpty():
            return labels
