"""Connected components of a graph of any size, by contracting it round after round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlprism.session import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, label)`` of all ends of ``links (a, b)``; the label is the least node of the component.

    Each round sends every node to the least of its neighbours, follows that down to the end by doubling the step, and
    joins the nodes that meet. Only nodes without a lesser neighbour are left, no two of them linked before, so a
    component shrinks at least by half. Rounds are written to the shared folder, so lost executors cost a retry.
    """
    edges = links.select("a", "b").filter("a != b").distinct()
    edges = materialize(edges, "edges")
    ends = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = materialize(ends.select("node", F.col("node").alias("label")), "labels")
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        least = materialize(least.withColumn("moved", F.lit(True)), "least")
        while not least.filter("moved").isEmpty():
            on = least.select(F.col("a").alias("m"), F.col("m").alias("on"))
            least = materialize(least.join(on, "m").select("a", F.col("on").alias("m"), (F.col("on") != F.col("m")).alias("moved")), "least")
        to = lambda side: least.select(F.col("a").alias(side), F.col("m").alias(f"{side}_to"))  # noqa: E731, B023
        moved = edges.join(to("a"), "a").join(to("b"), "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
        labels = materialize(labels.join(to("label"), "label", "left").select("node", F.coalesce("label_to", "label").alias("label")), "labels")
        edges = materialize(moved.filter("a != b").distinct(), "edges")
    return labels
