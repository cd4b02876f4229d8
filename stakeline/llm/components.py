"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stakeline.sources.sinks import stage_table


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def _stored(least: DataFrame) -> DataFrame:
    """A node's least neighbour, written: read back it is a join side of its own, so Spark can split
    the edges of a node that has very many; beside the sums it could not."""
    return stage_table(least, "least")


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least")))
    tied = both.where("b > a").join(least, "a")
    return tied.select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the smallest of them."""
    least = _stored(edges.groupBy("a").agg(F.min("b").alias("least")))
    tied = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return tied.unionByName(least.select("a", F.col("least").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """One row (node, component) per node of ``edges`` (a, b); a component's name is its least node.

    Star contraction in turns until nothing changes: every round is a few joins and sums over the
    edges left, written to the shared folder, so neither lineage nor any group of one task grows.
    Nodes without an edge to another one do not occur.
    """
    current = stage_table(_oriented(edges), "edges")
    before = None
    while True:
        state = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
        grown = _oriented(_large_star(current))
        current = stage_table(_oriented(_small_star(grown)), "edges")
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = stars.select(F.col("component").alias("node"), "component").distinct()
    return stars.unionByName(centres)
