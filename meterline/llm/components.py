"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from meterline.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """`node` and `component`, the least node that links reach, for all nodes of `links` (a, b).

    Large and small stars in turn: every node's larger neighbours are hung on its least
    neighbour, then its smaller ones. Each round writes the links left to the shared folder,
    so a lost executor costs one round. A node's least neighbour is found by an aggregate,
    which tasks combine first; a node with very many links comes back to them by a join
    that Spark can split. It ends when a round leaves all links as they are.
    """
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    first = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    held, before = _written(first)
    while True:
        held, after = _written(_small_star(_large_star(held)))
        if after == before:
            break
        before = after
    stars = held.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    roots = stars.select(F.col("component").alias("node"), "component").distinct()
    return stars.unionByName(roots)


def _large_star(links: DataFrame) -> DataFrame:
    """A node's larger neighbours go to the least of it and its neighbours; `a` is above `b` throughout."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("_least"))
    larger = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    return larger.filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the least of these."""
    least = links.groupBy("a").agg(F.min("b").alias("_least"))
    smaller = links.join(least, "a").select(F.col("b").alias("a"), F.col("_least").alias("b")).filter("a <> b")
    return smaller.unionByName(least.select("a", F.col("_least").alias("b"))).distinct()


def _written(links: DataFrame) -> tuple[DataFrame, dict]:
    """The links from the shared folder, and how many and which they are, seen as they were written."""
    seen = Observation()
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("total")
    held = stored(links.observe(seen, F.count(F.lit(1)).alias("links"), total), "links")
    return held, seen.get
