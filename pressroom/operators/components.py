"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.session import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row (id, component) for every id that has an edge; the component is the smallest id reachable.

    Each round hangs every node on its smallest neighbour, shortens the chains twice and draws the remaining edges between
    what the nodes now hang on. A round at least halves the nodes left, a star or clique takes one. Rows of a hub are only
    aggregated and joined, so a node with a third of all edges is no single task. Rounds end in written tables.
    """
    left = materialize(
        edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    )
    result = None
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hung = materialize(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("component")))
        for _ in range(2):
            upper = hung.select(F.col("id").alias("component"), F.col("component").alias("root"))
            hung = hung.join(upper, "component").select("id", F.col("root").alias("component"))
        hung = materialize(hung)
        ends = hung.select(F.col("id").alias("b"), F.col("component").alias("cb"))
        starts = hung.select(F.col("id").alias("a"), F.col("component").alias("ca"))
        left = materialize(
            left.join(starts, "a").join(ends, "b").where("ca != cb")
            .select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct()
        )
        if result is None:
            result = hung
        else:
            later = hung.select(F.col("id").alias("component"), F.col("component").alias("root"))
            result = materialize(
                result.join(later, "component", "left").select("id", F.coalesce("root", "component").alias("component"))
            )
    return result if result is not None else left.select(F.col("a").alias("id"), F.col("b").alias("component"))
