"""Connected components by alternating large-star and small-star (D3).

Kiveris et al., "Connected Components in MapReduce and Beyond", 2014. Edges
are ``(child, parent)`` rows with child > parent; at the end every child points
at the smallest id of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.operators.groups import join_groups
from sievemark.storage import discard, materialize_with


def _written(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """The edges as a table, with their count and an order-free checksum."""
    digest = F.xxhash64("child", "parent").cast("decimal(38,0)")
    table, seen = materialize_with(edges, name, n=F.count(F.lit(1)), digest=F.sum(digest))
    return table, (seen["n"], seen["digest"])


def _nearest(rows: DataFrame, total: int, limit: int | None) -> DataFrame:
    """Add ``low``: the smallest of node and its neighbours, to every row (node, other)."""
    groups = rows.groupBy("node").agg(F.min("other").alias("low"), F.count(F.lit(1)).alias("n_rows"))
    groups = groups.withColumn("low", F.least("node", "low"))
    return join_groups(rows, groups, ["node"], total, limit)


def _large_star(edges: DataFrame, total: int, limit: int | None) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's minimum."""
    both = edges.select(F.col("child").alias("node"), F.col("parent").alias("other")).union(
        edges.select(F.col("parent").alias("node"), F.col("child").alias("other"))
    )
    linked = _nearest(both, 2 * total, limit).where(F.col("other") > F.col("node"))
    return linked.select(F.col("other").alias("child"), F.col("low").alias("parent")).distinct()


def _small_star(edges: DataFrame, total: int, limit: int | None) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.col("child").alias("node"), F.col("parent").alias("other"))
    linked = _nearest(down, total, limit)
    ends = linked.select(F.explode(F.array("node", "other")).alias("child"), F.col("low").alias("parent"))
    return ends.where(F.col("child") > F.col("parent")).distinct()


def connected_components(edges: DataFrame, limit: int | None = None) -> DataFrame:
    """``(id, component)`` for every node that is not its component's minimum.

    Rounds run until the edge set stops changing; each writes its edges, so a
    lost executor costs one round and the plan never grows.
    """
    current, state = _written(edges.where(F.col("child") > F.col("parent")), "edges")
    while state[0]:
        stars, (n_stars, _) = _written(_large_star(current, state[0], limit), "large-star")
        shrunk, now = _written(_small_star(stars, n_stars, limit), "small-star")
        discard(stars)
        discard(current)
        current, state, before = shrunk, now, state
        if now == before:
            break
    return current.select(F.col("child").alias("id"), F.col("parent").alias("component"))
