"""Connected components of a large graph, by alternating star contraction in DataFrames.

Each round makes every node's larger neighbours point to its smallest neighbour (large star) and then
its smaller neighbours and itself point to the smallest (small star). Components end as stars around
their smallest node, after a number of rounds that grows with the logarithm of the graph's size. Rounds are
written tables: no lineage grows and a lost executor repeats one round at most. Minima are
pre-aggregated before the shuffle; the join back to a node of very many edges is one that adaptive
execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One half round over directed edges (a, b), both ways present or a > b for the small star."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        out = edges.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b")
    return out.filter("a != b").distinct()


def component_labels(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label) of every node in ``edges`` (columns a, b; any order, repeats and loops allowed): the
    label is the smallest node of its component. Nodes without an edge to another are not listed."""
    now = written(
        edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        now = written(_star(_star(now, True).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), False), "edges")
        # Stars only: a fixed point of both halves. Sums of hashes tell whether a round changed anything.
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20, 0)"))).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components: no fixed point after {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
