"""Connected components by alternating large-star and small-star steps on an edge table.

Each step is a map-side combined ``min`` per node and a join back on the node, so no node's
neighbourhood is ever gathered in one task; a node with very many neighbours is split by AQE's
skew join. The edge table is written to the shared checkpoint folder after each round, which cuts
the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.session import materialize


def large_star(edges: DataFrame) -> DataFrame:
    """Connect every strictly larger neighbour of a node to the smallest of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """Connect the smaller neighbours of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame):
    r = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit((1 << 31) - 1)))).first()
    return tuple(r)


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of the undirected edges ``(u, v)``; component = least node.

    Self-loops, repeated edges and NULL ends are ignored; no edges give no rows.
    """
    current = materialize(edges.select("u", "v").where("u <> v").distinct(), "edges")
    state = _state(current)
    while state[0]:
        current = materialize(small_star(large_star(current)), "edges")
        before, state = state, _state(current)
        if state == before:
            break
    roots = current.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
