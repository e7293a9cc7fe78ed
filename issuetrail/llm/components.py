"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuetrail.llm.common import checkpointed


def _state(edges: DataFrame) -> tuple:
    """Counts and a sum over hashes: equal for equal sets of edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """edges (u, v) of integer nodes -> (u, v): each linked node with the smallest node it reaches, itself left out.

    Loops, repeated and empty inputs are allowed; nulls are not. Each round hangs nodes on the smallest neighbour seen, with two
    aggregations that combine before the shuffle, and is checkpointed; rounds end when nothing changes.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = checkpointed(edges)
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(hung.union(small.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    return edges
