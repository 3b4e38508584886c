"""Connected components of a graph given by its edges, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b); component: smallest node.

    Alternates two steps until the edges stay the same, which takes about log2 of the longest path
    in rounds: first every node hands its larger neighbours to its smallest neighbour, then every
    node and its smaller neighbours are tied to the smallest of them. Both are a partially
    aggregated minimum by node and a join with it, which Spark splits where a node has very many
    neighbours. Every round's edges are stored, so that a lost executor costs one round.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"),
                                               F.least("a", "b").alias("lo")).distinct(), "edges")
    seen = _mark(now)
    for _ in range(most_rounds):
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (both.filter("v > u").join(least, "u")
                 .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        tied = large.join(least, "hi")
        now = stored(tied.select("hi", F.col("m").alias("lo")).union(
            tied.select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
            .filter("hi <> lo").distinct(), "edges")
        before, seen = seen, _mark(now)
        if seen == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("component"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Equal marks: equal edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.col("lo").cast("decimal(38,0)")),
                           F.bit_xor(F.xxhash64("hi", "lo"))).first())
