"""Connected components of an edge table."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from llm.common import checkpoint


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of the edges ``a``, ``b`` (long).

    Each round takes the least label among neighbours, then the label of that label, until nothing
    changes. Labels stay in tables; only the number of changes reaches the driver.
    """
    both = checkpoint(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = checkpoint(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        moved = labels.join(near, "node").select("node", F.least("label", "near").alias("next"), "label")
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        moved = checkpoint(moved.join(jump, "next").select("node", F.least("next", "far").alias("next"), "label"))
        if moved.filter("next <> label").isEmpty():
            return labels.withColumnRenamed("label", "component")
        labels = moved.select("node", F.col("next").alias("label"))
