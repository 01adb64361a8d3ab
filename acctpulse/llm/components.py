"""Connected components of a graph given as edges, without a graph on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctpulse.llm.tables import keep


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, from edges ``a``, ``b``.

    Each round every node takes the smallest label among its neighbours and then its label's own
    label, so a path of n nodes needs about log n rounds. Labels are written each round. A node
    with many neighbours is one partial minimum per task. Nodes without edges are not in the result.
    """
    both = keep(
        edges.where(F.col("a") != F.col("b"))
        .select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"),
                                                               F.col("a").alias("b")))).alias("e"))
        .select("e.*")
        .distinct(),
        "edges",
    )
    labels = keep(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")), "labels")
    for _ in range(rounds):
        near = (
            both.join(labels.select(F.col("a").alias("b"), "root"), "b")
            .groupBy("a")
            .agg(F.min("root").alias("near"))
        )
        own = labels.select(F.col("a"), F.col("root").alias("old")).join(near, "a")
        step = own.select("a", "old", F.least("old", "near").alias("new"))
        jump = labels.select(F.col("a").alias("new"), F.col("root").alias("far"))
        moved = step.join(jump, "new").select("a", "old", F.least("new", "far").alias("root"))
        moved = keep(moved, "labels")
        labels = moved.select("a", "root")
        if moved.where(F.col("old") != F.col("root")).isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return labels.select(F.col("a").alias("node"), "root")
