"""Connected components of links that are too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexmart.session import materialize


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node onto the least of them and the node itself: all larger ones, or the smaller ones and the node."""
    if large:
        both = links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
    else:
        both = links.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
    least = both.groupBy("x").agg(F.min("y").alias("low"))
    joined = both.join(least, "x").select("x", "y", F.least("x", "low").alias("low"))
    if large:
        out = joined.where(F.col("y") > F.col("x")).select(F.col("y").alias("x"), F.col("low").alias("y"))
    else:
        out = joined.select(F.col("y").alias("x"), F.col("low").alias("y")).unionByName(least.select("x", F.col("low").alias("y")))
    return out.where(F.col("x") != F.col("y")).distinct()


def connect(links: DataFrame) -> DataFrame:
    """``node, root``: for every node of ``links`` (x, y) that is not the least of its component, the least one.

    Alternating large and small stars; the number of rounds grows with the logarithm of the longest path. Each round is
    written to the shared folder. A node with very many links only aggregates, and its join is one that Spark can split.
    """
    links = materialize(links.where(F.col("x") != F.col("y")).select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), "links")
    print_of = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(20,0)"))).first())
    before, now = None, print_of(links)
    while now != before:
        links = materialize(_stars(_stars(links, True), False), "stars")
        before, now = now, print_of(links)
    return links.select(F.col("x").alias("node"), F.col("y").alias("root"))
