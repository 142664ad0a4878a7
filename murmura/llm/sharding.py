"""Rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair gets a uniform number from MD5; the shard with the least -ln(u) / weight wins.
The choice depends on the key and the weights alone: a new shard takes rows only into itself, and a
removed one gives away only its own.

Defined cases: a null key is the key "null"; null texts have no bytes; repeated rows go to one shard and
get slots of their own; shards of weight 0 get nothing; an empty table gives an empty table; other columns
of the input are not carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import numbered


def _scores(key: Column, weights: Sequence[float]) -> list[Column]:
    scores = []
    for shard, weight in enumerate(weights):
        if weight < 0:
            raise ValueError("weights must not be negative")
        if weight:
            digits = F.substring(F.md5(F.concat(key, F.lit(f"/{shard}"))), 1, 13)
            u = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))
            scores.append(F.struct((-F.log(u) / F.lit(float(weight))).alias("score"), F.lit(shard).alias("shard")))
    if not scores:
        raise ValueError("one shard at least needs a weight")
    return scores


def key_text(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.lit("null"))


def shard_of(key: str, weights: Sequence[float]) -> Column:
    """The shard of each row; equal scores go to the smaller shard."""
    return F.array_min(F.array(*_scores(key_text(key), weights)))["shard"]


def assign(rows: DataFrame, key: str, weights: Sequence[float], grown: Sequence[float] | None = None) -> DataFrame:
    """rows plus shard, its slot (gapless from 0 in each shard, by the key's MD5) and grown_shard (or null)."""
    out = rows.withColumn("shard", shard_of(key, weights)).withColumn(
        "grown_shard", shard_of(key, grown) if grown else F.lit(None).cast("int")
    )
    digest = F.md5(key_text(key))
    rest = [F.col(c) for c in rows.columns]
    return numbered(out, ["shard"], [digest, *rest], F.substring(digest, 1, 3), "slot")


def write_shards(rows: DataFrame, key: str, weights: Sequence[float], path: str, files_per_shard: int = 16) -> None:
    """One folder per shard; each shard is dealt over several files by the key, so none is one task's work."""
    part = F.pmod(F.xxhash64(F.col(key)), F.lit(files_per_shard))
    (
        rows.withColumn("shard", shard_of(key, weights))
        .repartition(len(weights) * files_per_shard, "shard", part)
        .write.partitionBy("shard")
        .parquet(path)
    )
