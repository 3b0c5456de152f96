"""Connected components of an edge table, by alternating star contractions.

Each round replaces every edge by edges to a smaller node of the same component: first from the
larger neighbours of a node to its least neighbour, then from its smaller ones. The number of rounds
is logarithmic in practice and no round holds a component in one task: the least neighbour is a
partially aggregated minimum and the join that hands it back can be split for a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from farebox.llm.tables import stage


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _hand_back(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with m, the least of u and its neighbours."""
    return edges.join(_least_neighbour(edges), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    handed = _hand_back(both).where("v > u")
    return handed.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    handed = _hand_back(edges)
    moved = handed.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(handed.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node that has an edge; the component is its least node.

    Edges may repeat, run either way, join a node to itself (ignored) or have a null end (ignored).
    Nodes without an edge to another node are not returned: each is its own component. An empty
    table gives an empty result.
    """
    directed = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    current = stage(directed.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "cc")
    before = _state(current)
    while before[0]:
        current = stage(_small_star(_large_star(current)), "cc")
        after = _state(current)
        if after == before:
            break
        before = after
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.union(current.select("v", "v").distinct())
