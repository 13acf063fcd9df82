"""Connected components of an edge table, by randomised contraction.

Each round, every node takes the neighbour (or itself) with the smallest random
number as its label, and edges between labels remain. A constant share of the
nodes vanishes per round, whatever the shape, so rounds grow with the
logarithm of the longest chain. Rounds are written tables: none depends on a long
lineage, and nothing but a row count reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlight.llm.storage import Workspace


def connected_components(edges: DataFrame, work: Workspace, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its smallest node.

    Direction, repeats and loops do not matter; a null end is no edge. A node
    that has only a loop, or no edge, is not listed.
    """
    both = edges.select("a", "b").where("a <> b")
    both = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
    current = work.write(both.distinct(), f"{name}-edges-0")
    labels: list[DataFrame] = []
    while not current.isEmpty():
        seed = len(labels)
        own = F.xxhash64(F.lit(seed), "a")
        nearest = current.groupBy("a").agg(
            F.min(F.xxhash64(F.lit(seed), "b")).alias("h"), F.min_by("b", F.xxhash64(F.lit(seed), "b")).alias("b")
        )
        label = work.write(
            nearest.select(F.col("a").alias("node"), F.when(F.col("h") < own, F.col("b")).otherwise(F.col("a")).alias("label")),
            f"{name}-labels-{seed}",
        )
        labels.append(label)
        left = label.select(F.col("node").alias("a"), F.col("label").alias("x"))
        right = label.select(F.col("node").alias("b"), F.col("label").alias("y"))
        moved = current.join(left, "a").join(right, "b").where("x <> y")
        current = work.write(moved.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), f"{name}-edges-{seed + 1}")
    if not labels:
        return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    final = labels[-1]
    for k in range(len(labels) - 2, -1, -1):
        later = final.select(F.col("node").alias("label"), F.col("label").alias("last"))
        final = labels[k].join(later, "label", "left").select("node", F.coalesce("last", "label").alias("label"))
        final = work.write(final, f"{name}-last-{k}")
    smallest = final.groupBy("label").agg(F.min("node").alias("component"))
    return work.write(final.join(smallest, "label").select("node", "component"), name)
