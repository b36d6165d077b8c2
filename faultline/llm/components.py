"""Connected components of a link table as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import written_step


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b): the smallest node of its
    component, of any orderable type.

    Each round every node takes the smallest label among itself and its
    neighbours (an aggregate, so a node with many neighbours is one row per
    task) and then its label's label, which halves the distance to the
    smallest node.  Rounds are written out, so lineage stays short; they end
    when nothing changed.  No link, no row.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written_step(both.where("a <> b").distinct(), "component-links")
    labels = written_step(both.groupBy("a").agg(F.min("b").alias("b"))
                          .select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "component-labels")
    while True:
        seen = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("seen")))
        near = (labels.join(seen, "node")
                .select("node", F.col("label").alias("old"), F.least("label", "seen").alias("label")))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        moved = written_step(near.join(up, "label", "left")
                             .select("node", "old", F.least("label", F.coalesce("up", "label")).alias("label")),
                             "component-labels")
        labels = moved.select("node", "label")
        if moved.where("old <> label").isEmpty():
            return labels
