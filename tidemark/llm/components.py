"""Connected components of an edge table by repeated contraction, every step a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``node, component`` for all ends of ``edges`` (columns a, b of type long); equal component means connected.

    In each round every node joins the neighbour, or itself, that comes first in an order by hash that is drawn anew for the
    round; edges are then renamed to those.  Chains shrink by a constant share per round whatever their numbering, and a star
    takes two rounds.  No group is ever collected: a round is a grouped minimum and joins.
    """
    left = stage(edges.select("a", "b").filter("a <> b").distinct(), "cc-edges")
    labels = left.select(F.col("a").alias("node")).union(left.select("b")).distinct().withColumn("component", F.col("node"))
    labels = stage(labels, "cc-labels")
    for turn in range(most_rounds):
        if not left.limit(1).count():
            return labels
        both = left.union(left.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), F.col(c).alias("id"))
        parent = both.groupBy("a").agg(F.min(rank("b")).alias("m")).select("a", F.least(F.col("m"), rank("a"))["id"].alias("top"))
        parent = stage(parent, "cc-parents")
        labels = stage(
            labels.join(parent.withColumnRenamed("a", "component"), "component", "left").select("node", F.coalesce("top", "component").alias("component")),
            "cc-labels",
        )
        renamed = left.join(parent, "a").select(F.col("top").alias("a"), "b")
        renamed = renamed.join(parent.withColumnRenamed("a", "b"), "b").select("a", F.col("top").alias("b")).filter("a <> b")
        left = stage(renamed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    raise RuntimeError(f"components not found in {most_rounds} rounds")
