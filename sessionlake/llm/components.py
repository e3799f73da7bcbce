"""Connected components by alternating stars: every step is two joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.steps import step


def _stars(edges: DataFrame) -> DataFrame:
    """One round: nodes hang on the least neighbour, first the larger ones, then the rest."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    lower = large.groupBy("u").agg(F.min("v").alias("m"))
    # a node's edge to its least neighbour, and its other neighbours' edges to the same
    moved = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(lower.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("decimal(20,0)")), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) but the roots: the least node it is connected with.

    Edges from a node to itself and repeated edges change nothing. Rounds go on
    until one changes nothing; their number grows with the logarithm of the
    longest path. A node with very many edges is one row a task before the
    shuffle in the aggregates, and is split by adaptive execution in the joins.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    edges = step(edges, "edges")
    before, now = None, _state(edges)
    while now[0] and now != before:
        edges = step(_stars(edges), "edges")
        before, now = now, _state(edges)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
