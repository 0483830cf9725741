"""Connected components by alternating large-star and small-star steps on a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm.common import kept


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the smallest of the node and its neighbours."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, is linked with the smallest of them. Links run from larger to smaller."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    others = links.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component: for every node of `links` (a, b) the smallest node it can reach.

    Links with a null end and links of a node with itself are left out; direction and repeats do not matter. Each
    step sends a node at most its own links, minima are taken before the shuffle, and every round is written to the
    shared folder.
    """
    ends = links.where("a is not null and b is not null and a <> b")
    links = kept(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        links = kept(_small_star(_large_star(links)), "links")
        row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
