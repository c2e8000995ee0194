"""Connected components of a link table by alternating large-star and
small-star steps, each a partial-aggregated minimum and one join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node with a link; the component is the
    smallest node that links reach.

    Every step writes its (shrinking) edge table, so the plan stays short and
    a lost executor repeats one step.  The number of steps grows with the
    logarithm of the longest chain, and neither nodes nor edges are collected.
    """
    edges = written(_ordered(links.select(F.col(a).alias("u"), F.col(b).alias("v"))), "cc-edges")
    state = None
    while True:
        edges = written(_small_star(_large_star(edges)), "cc-edges")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    # a star: every other node hangs on its component's smallest
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges (u, v) with u > v."""
    return edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node hang on the least of it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("v")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return edges.join(least, "v").select("u", F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and itself, hang on the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _ordered(rest.unionByName(least.select("u", F.col("m").alias("v"))))
