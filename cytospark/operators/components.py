"""Connected components of an edge list, by alternating star contractions in Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize


def _mins(edges: DataFrame) -> DataFrame:
    """The smallest neighbour (or the node itself) of each node; written out, so that Spark may split its join with hot nodes."""
    return materialize(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "mins")


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for each node of the edges (u, v) that isn't the smallest of its component.

    Large-star and small-star steps in turn (Kiveris et al., 2014) until nothing changes: each step hangs a node's
    neighbours below the smallest of them. What a step makes is linear in the edges; no group is collected. Edges
    from a node to itself, repeated edges and either direction are fine; null ends are dropped.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u > v").distinct()
    edges, before = materialize(edges, "edges"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select("u", F.col("v").alias("root"))
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_mins(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "edges")
        small = large.join(_mins(large), "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        edges = materialize(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u > v").distinct(), "edges")
