"""Connected components of an edge table, as a loop of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postline.llm.common import cut


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): every node of ``edges`` (a, b) with the smallest node it reaches.

    Each round gives a node the smallest label among itself and its neighbours,
    then follows that label to its own label (pointer jumping), so a chain of n
    nodes needs about log n rounds.  Minima have map-side partials, so the hub
    of a large star is one row per task; the joins are split by AQE where a node
    is hot.  Every round is cut, so a lost executor repeats one round at most.
    Rows with a null end are not edges.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    both = cut(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root"))
    labels = cut(labels, "labels")
    for _ in range(max_rounds):
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        lower = labels.join(near, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("to"))
        hop = labels.select(F.col("node").alias("to"), F.col("root").alias("next"))
        moved = cut(lower.join(hop, "to").select(
            "node", "old", F.least("to", "next").alias("root")), "labels")
        labels = moved.select("node", "root")
        if moved.where("old <> root").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
