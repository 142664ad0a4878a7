"""Connected components of an edge table by alternating star joins; every step is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """edges with a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter(F.col("b") != F.col("m"))
    moved = moved.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (long). Returns a row (a, b) for each node a whose component has a smaller node; b is the least.

    Rounds go on until nothing changes (their number grows with the logarithm of the longest path). Self-loops
    and repeated edges are ignored; no edges give no rows.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    now, state = written(now), None
    while True:
        print_ = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(print_) == state or not print_[0]:
            return now
        state = tuple(print_)
        now = written(_small_star(_large_star(now)))
