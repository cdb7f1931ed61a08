"""Connected components of an edge table, by joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.staging import staged


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``edges``; the component is its smallest node.

    Each round, a node takes the smallest label among its own and its neighbours', then
    the label of that label (pointer jumping), so long chains shrink by doubling. A hot
    node's neighbours meet in partial aggregates. Each round is a staged table; the loop
    ends with the round that changes no label. Edges with a null end are left out; loops,
    repeated edges and an empty table are fine.
    """
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null")
    both = staged(e.union(e.select("y", "x")).distinct(), "edges")
    labels = staged(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("l")), "labels")
    while True:
        near = (both.join(labels.select(F.col("x").alias("y"), "l"), "y")
                .groupBy("x").agg(F.min("l").alias("m")))
        low = labels.join(near, "x").select("x", "l", F.least("l", "m").alias("m"))
        jump = labels.select(F.col("x").alias("m"), F.col("l").alias("mm"))
        step = staged(low.join(jump, "m").select("x", F.least("m", "mm").alias("l"), (F.least("m", "mm") < F.col("l")).alias("moved")),
                      "labels")
        labels = step.select("x", "l")
        if step.where("moved").isEmpty():
            return labels.select(F.col("x").alias("node"), F.col("l").alias("component"))
