"""Embedding table instead of a cache: misses, look-up, retention, averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def misses(texts: DataFrame, table: DataFrame, key: str = "text_norm") -> DataFrame:
    """Distinct texts the embedding table lacks: each is embedded once."""
    return texts.select(key).distinct().join(table.select(key), key, "left_anti")


def with_vectors(texts: DataFrame, table: DataFrame, key: str = "text_norm", vector: str = "embedding") -> DataFrame:
    """Every text with its vector from the table, null where the table lacks it: each text is embedded once, and joined back."""
    one = table.groupBy(key).agg(F.first(vector).alias(vector))
    return texts.drop(vector).join(one, key, "left")


def retention(
    table: DataFrame, now: Column, ttl_hours: int, max_entries: int, key: str = "text_norm"
) -> DataFrame:
    """Entries within their age; of a full table the oldest tenth of the capacity is dropped.

    The cut is one threshold row found by a top-k, so the table itself is not sorted.
    """
    alive = table.filter(F.col("embedded_at") >= now - F.expr(f"interval {ttl_hours} hours"))
    keep = max_entries - max_entries // 10
    total = alive.agg(F.count("*").alias("n")).scalar()
    edge = (
        alive.select(F.struct("embedded_at", key).alias("e"))
        .orderBy(F.desc("e")).limit(keep)
        .agg(F.min("e").alias("e"))
        .scalar()
    )
    return alive.filter((total < max_entries) | (F.struct("embedded_at", key) >= edge))


def mean_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Mean vector per key: averages of the places, so partial sums leave each task."""
    places = vectors.select(key, F.posexplode(vector).alias("i", "v"))
    means = places.groupBy(key, "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    # One entry per dimension.
    return means.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda x: x["m"]).alias("mean_vector")
    )
