"""Rows told apart by a bitmap of the hashes of some keys, which is broadcast whatever their number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the bitmaps that `among` broadcasts: at most 2^19 rows of 64 bits.
BITS = 1 << 25


def _marked(rows: DataFrame, keys: DataFrame, key: str, bits: int) -> DataFrame:
    slot = F.pmod(F.xxhash64(key), F.lit(bits).cast("long"))
    # bits / 64 rows at most, whatever the number of keys.
    bitmap = (
        keys.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("__word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("__set"))
    )
    marked = rows.withColumn("__slot", slot).join(F.broadcast(bitmap), F.shiftright("__slot", 6) == F.col("__word"), "left")
    hit = F.expr("bit_get(__set, cast(__slot & 63 as int)) = 1")
    return marked.withColumn("__hit", F.coalesce(hit, F.lit(False))).drop("__slot", "__word", "__set")


def among(rows: DataFrame, keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """Rows whose `key` may be one of `keys`, by a bitmap of fixed size; none that is gets lost."""
    return _marked(rows, keys, key, bits).filter("__hit").drop("__hit")


def beside(rows: DataFrame, keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """The other rows: their `key` is none of `keys` for certain."""
    return _marked(rows, keys, key, bits).filter("not __hit").drop("__hit")
