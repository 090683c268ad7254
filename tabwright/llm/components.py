"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges(a, b)``: ``root`` is one node per component.

    Each round hooks every node to its smallest neighbour, follows these pointers twice
    as far until they end, and contracts the edges, so the nodes at least halve. All
    states are written tables; nothing is collected. Minima are combined before the
    shuffle, so a hub costs one row per task.
    """
    edges = materialize(edges.select("a", "b").where("a <> b").distinct(), "cc-edges")
    labels = materialize(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("root", F.col("node")), "cc-labels")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        hook = materialize(hook.select("node", F.least("node", "low").alias("to")), "cc-hooks")
        while True:
            far = hook.select(F.col("node").alias("to"), F.col("to").alias("far"))
            jumped = materialize(hook.join(far, "to", "left").select("node", F.coalesce("far", "to").alias("next"), "to"), "cc-jumps")
            done = jumped.where("next <> to").isEmpty()
            hook = jumped.select("node", F.col("next").alias("to"))
            if done:
                break
        step = hook.select(F.col("node").alias("root"), "to")
        labels = materialize(labels.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "cc-labels")
        a, b = (hook.select(F.col("node").alias(n), F.col("to").alias(f"{n}_to")) for n in ("a", "b"))
        edges = materialize(
            edges.join(a, "a").join(b, "b").where("a_to <> b_to")
            .select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(),
            "cc-edges",
        )
    return labels
