"""Connected components of an edge table by joins: smallest labels spread over edges and along label chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node of its component) for every node of the edges ``a``, ``b``."""
    forth, back = edges.select("a", "b"), edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = stored(forth.unionByName(back).distinct(), "edges")
    first = both.groupBy("a").agg(F.min("b").alias("low"))
    labels = stored(
        first.select(F.col("a").alias("node"), F.least("a", "low").alias("label")), "labels"
    )
    while True:
        beside = both.join(labels.select(F.col("node").alias("b"), "label"), "b")
        lowest = beside.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low"))
        spread = labels.join(lowest, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "low").alias("label")
        )
        spread = stored(spread, "labels")
        # A label is itself a node: its own label is lower still or the same.
        parents = spread.select(F.col("node").alias("label"), F.col("label").alias("top"))
        joined = spread.join(parents, "label").select("node", "old", F.col("top").alias("label"))
        joined = stored(joined, "labels")
        labels = joined.select("node", "label")
        if joined.filter("label <> old").isEmpty():
            return labels
