"""Connected components of a table of links, by rounds of large and small stars.

Every round points each node at the least node it knows of; what a round leaves is written to the shared folder. Links of a node are
only ever reduced to their least end by partial aggregates, so a node with very many links is no single task's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.operators.staging import stage


def _large_star(links: DataFrame) -> DataFrame:
    """Of each node, the greater neighbours now point to the least one."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Of each node, its lesser neighbours and itself point to the least of these."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a")
    others = moved.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.union(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``class``) for each end of a link (columns ``a``, ``b``); the class is its component's least node.

    Links from a node to itself and repeated links change nothing. Rounds end when one leaves the links as they were; their number grows
    with the logarithm of the longest path.
    """
    own = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")
    links = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = links.agg(F.count("*").alias("n"), own).first()
    while seen["n"]:
        links = stage(_small_star(_large_star(links)), "links")
        now = links.agg(F.count("*").alias("n"), own).first()
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("class")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("class")).union(roots)
