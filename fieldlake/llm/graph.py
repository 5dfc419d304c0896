"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.llm.common import Scratch


def components(
    edges: DataFrame, scratch: Scratch, label: str = "components", most: int | None = None
) -> DataFrame:
    """(node, component) of a stored edge table (a, b); the component is its smallest node.

    Every round sends each node to the smallest of itself and its neighbours, moves the edges
    along and drops those inside a node. A star or a clique is gone after one round; a path
    shrinks by a constant factor. After `most` rounds what is found is returned, which may be parts
    of components. Minima combine before their shuffle, so a hub costs no more
    than its edges. Nodes without an edge are not listed.
    """
    edges = edges.select("a", "b").where(F.col("a") != F.col("b"))
    found, step = None, 0
    while (most is None or step < most) and not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_m"))
        least = scratch.put(least.select("node", F.least("node", "_m").alias("to")), f"{label}-to-{step}")
        moved = edges.join(least.select(F.col("node").alias("a"), F.col("to").alias("_a")), "a")
        moved = moved.join(least.select(F.col("node").alias("b"), F.col("to").alias("_b")), "b")
        moved = moved.where(F.col("_a") != F.col("_b")).select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        edges = scratch.put(moved.distinct(), f"{label}-edges-{step + 1}")
        if found is None:
            found = least.select("node", F.col("to").alias("component"))
        else:
            next_to = least.select(F.col("node").alias("component"), "to")
            found = found.join(next_to, "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")
            )
        step += 1
    if found is None:
        found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    # A node that was the target of a round may itself have moved in a later one only.
    least_of = found.groupBy("component").agg(F.min("node").alias("_least"))
    return scratch.put(
        found.join(least_of, "component").select(
            "node", F.least("_least", "component").alias("component")
        ),
        label,
    )
