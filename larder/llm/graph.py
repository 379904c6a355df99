"""Connected components by joins and sums only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.shared import Stored


def components(edges: DataFrame, stored: Stored) -> DataFrame:
    """The component of every vertex of ``edges`` (columns ``a`` and ``b``, of one ordered type).

    Returns ``id`` and ``component``, the smallest vertex reachable. Alternating large-star and
    small-star rounds: each vertex hangs its neighbours, then itself, on the smallest neighbour.
    The minimum of a vertex is a sum-like aggregate that combines before the shuffle. It is stored
    before it reaches the vertex's edges, by a join that adaptive execution can then split, so a
    vertex with a third of all edges is never gathered in one task. Each round's edges are a stored
    table, and the tables before are removed. Loops, repeated edges and edges with a null end have no effect;
    without edges the result is empty.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    current = stored.write(edges.distinct())
    before = _state(current)
    while before[0]:
        both = _both_ways(current)
        least = stored.write(both.groupBy("u").agg(F.min("v").alias("least")))
        large = stored.write(_large_star(both, least))
        least_below = stored.write(large.groupBy("hi").agg(F.min("lo").alias("least")))
        following = stored.write(_small_star(large, least_below))
        after = _state(following)
        for table in (current, least, large, least_below):
            stored.drop(table)
        current = following
        if after == before:
            break
        before = after
    rooted = current.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return rooted.unionByName(current.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    row = edges.agg(
        F.count("*"),
        F.coalesce(F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)")), F.lit(0)),
    ).first()
    return tuple(row)


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )


def _large_star(both: DataFrame, smallest: DataFrame) -> DataFrame:
    """Larger neighbours of every vertex, hung on the smallest of it and its neighbours."""
    return (
        both.where("v > u")
        .join(smallest, "u")
        .select(F.col("v").alias("hi"), F.least("least", "u").alias("lo"))
        .distinct()
    )


def _small_star(edges: DataFrame, smallest: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours, hung on the smallest of them."""
    moved = (
        edges.join(smallest, "hi")
        .where("lo <> least")
        .select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    )
    return moved.unionByName(smallest.select("hi", F.col("least").alias("lo"))).distinct()
