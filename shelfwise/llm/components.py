"""Connected components by label passing and pointer jumping; every round is a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.llm import tables


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the least node of its component, for all nodes of ``edges`` (``a``, ``b``).

    Rounds grow with the logarithm of a component's diameter; the driver only learns how many labels changed.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = tables.stage(both, "edges")
    labels = tables.stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        nearer = labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("via"))
        far = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        moved = tables.stage(nearer.join(far, "via").select("node", "old", F.least("via", "far").alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.where("old <> label").isEmpty():
            return labels
