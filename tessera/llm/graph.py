"""Connected components of an edge table by contraction."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.tables import written


def _rooted(near: DataFrame) -> DataFrame:
    """(node, label) with every label followed to the end: paths halve in each round."""
    labels = written(near, "labels")
    while True:
        further = labels.where("node <> label").select(F.col("node").alias("n"), F.col("label").alias("further"))
        new = written(labels.join(further, F.col("label") == F.col("n"), "left").select("node", F.coalesce("further", "label").alias("label"), F.col("further").isNotNull().alias("moved")), "labels")
        moved = new.where("moved").limit(1).count()
        labels = new.select("node", "label")
        if not moved:
            return labels


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is named by its smallest node.

    Every round sends each node of the edges that are left to its smallest
    neighbour, if that is smaller, follows these steps to their ends, and replaces both ends of
    every edge by them; loops and repeats go, so the edge table shrinks and a
    node of very many edges is gone after one round.  Aggregates combine before
    the shuffle; nothing but one count reaches the driver.
    """
    left = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while labels is None or left.limit(1).count():
        near = left.select(F.col("a").alias("node"), F.col("b").alias("to")).union(left.select("b", "b")).groupBy("node").agg(F.min("to").alias("label"))
        step = _rooted(near)  # a node without a smaller neighbour is an end
        if labels is None:
            labels = step
        else:
            follow = step.select(F.col("node").alias("n"), F.col("label").alias("end"))
            labels = written(labels.join(follow, F.col("label") == F.col("n"), "left").select("node", F.coalesce("end", "label").alias("label")), "labels")
        a, b = (step.select(F.col("node").alias(c), F.col("label").alias(f"{c}_end")) for c in ("a", "b"))
        ends = left.join(a, "a").join(b, "b").where("a_end <> b_end")
        left = written(ends.select(F.greatest("a_end", "b_end").alias("a"), F.least("a_end", "b_end").alias("b")).distinct(), "edges")
    return labels.select("node", F.col("label").alias("component"))
