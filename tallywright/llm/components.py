"""Connected components by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import few, written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node it reaches.

    Each round takes the smallest label among the neighbours, then the label of the label,
    and is written to the shared folder.  Nodes without an edge do not appear.
    """
    near = edges.where("a <> b").select("a", "b")
    # both directions; an edge may repeat
    near = written(near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = written(near.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")), "labels")
    while True:
        known = few(labels)
        lowest = (
            near.join(known.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("lowest"))
        )
        lower = lowest.join(known, "node").select("node", "component", F.least("component", "lowest").alias("next"))
        jump = known.select(F.col("node").alias("next"), F.col("component").alias("beyond"))
        moved = written(
            lower.join(jump, "next").select("node", "component", F.least("next", "beyond").alias("next")),
            "labels",
        )
        labels = moved.select("node", F.col("next").alias("component"))
        if moved.where("component <> next").isEmpty():
            return labels
