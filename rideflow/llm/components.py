"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow.llm.common import sized, written


def _mark(edges: DataFrame) -> tuple[int, int]:
    """Number and combined hash of distinct edges; equal marks are equal edges."""
    found = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x")).first()
    return found["n"], found["x"]


def _with_least(edges: DataFrame, node: str, other: str, rows: int) -> DataFrame:
    """The edges with ``least``, the smallest ``other`` of their ``node``.

    The minima are written first, so that the join back shuffles both sides and a node with very
    many links can be split.
    """
    least = written(sized(edges.groupBy(node).agg(F.min(other).alias("least")), rows), "least")
    return sized(edges.join(least, node), rows)


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``: the smallest node that it reaches.

    Links that are null on a side are left out; loops and repeated links change nothing. Each round
    joins every node's larger neighbours, then its smaller ones, to the smallest; the rounds end
    when the links no longer change, which takes about the logarithm of the longest path. The
    number of links is known in every round, and so are the tasks that they need.
    """
    known = links.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    pairs = written(known.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "links")
    loops, edges = pairs.where("hi = lo").select(F.col("hi").alias("node")), pairs.where("hi > lo")
    mark = _mark(edges)
    while mark[0]:
        rows = 2 * mark[0]
        both = edges.union(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("node", "other")
        stars = _with_least(both, "node", "other", rows).where("other > node")
        stars = stars.select(F.col("other").alias("hi"), F.least("node", "least").alias("lo")).distinct()
        large = written(sized(stars, rows), "large")
        found = _with_least(large, "hi", "lo", rows)
        small = found.select("hi", F.col("least").alias("lo")).union(found.where("lo > least").select(F.col("lo").alias("hi"), "least"))
        edges = written(sized(small.distinct(), rows), "small")
        if (after := _mark(edges)) == mark:
            break
        mark = after
    roots = edges.select(F.col("lo").alias("node")).union(loops).distinct()
    alone = roots.join(edges.select(F.col("hi").alias("node")), "node", "left_anti")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(alone.select("node", F.col("node").alias("component")))
