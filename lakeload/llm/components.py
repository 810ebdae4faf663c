"""Connected components by alternating large-star and small-star steps, in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import stored


def _stars(edges: DataFrame) -> DataFrame:
    """One round over edges (a, b) with a > b: point nodes at the smallest node of their neighbourhood."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = (large.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
             .unionAll(least.select("a", F.col("m").alias("b"))))
    return small.distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (longs ``a``, ``b``) that is not its component's smallest.

    Rounds end when nothing changes, after a number of them that grows with the logarithm of the longest
    chain; each round is written to the shared folder. Loops and nulls are ignored, repeated edges count once.
    """
    now = stored(edges.where(F.col("a") != F.col("b"))
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        sign = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
        if sign == seen or sign["n"] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen, now = sign, stored(_stars(now), "edges")
