"""Upserts, deletes and differences of keyed snapshots.

No whole-store outer join: each plan joins the store with the (usually small) changes, so the
optimiser can broadcast the changes when their size allows and shuffle both sides when not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEPT_ON_UPDATE = ("creation_date", "created_by_execution", "is_active")


def upsert_keep_creation(
    target: DataFrame, source: DataFrame, key: str = "id", kept=KEPT_ON_UPDATE, version: str | None = "version"
) -> DataFrame:
    """Update matched rows but for the key and `kept`; insert the rest. `version` grows by one on update.

    The source has one row per key.
    """
    cols = target.columns
    kept = set(kept)
    changes = source.select(
        F.col(key), *[F.col(c).alias(f"_new_{c}") for c in cols if c != key], F.lit(True).alias("_hit")
    )
    joined = target.join(changes, key, "left")

    def updated(c: str):
        if c == key or c in kept:
            return F.col(c)
        new = F.col(c) + 1 if c == version else F.col(f"_new_{c}")
        return F.when(F.col("_hit"), new).otherwise(F.col(c)).alias(c)

    known = target.select(key).join(source.select(key), key, "left_semi")
    inserts = source.join(known, key, "left_anti").select(*cols)
    return joined.select(*[updated(c) for c in cols]).unionByName(inserts)


def upsert_replace(target: DataFrame, source: DataFrame, key: str = "id") -> DataFrame:
    """Matched rows replaced as a whole, new ones inserted."""
    return target.join(source.select(key), key, "left_anti").select(*target.columns).unionByName(
        source.select(*target.columns)
    )


def delete_by_keys(target: DataFrame, keys: DataFrame, key: str = "id") -> DataFrame:
    return target.join(keys.select(key), key, "left_anti").select(*target.columns)


def snapshot_diff(before: DataFrame, after: DataFrame, key: str = "id") -> DataFrame:
    """Row-level changes between two snapshots: key and insert / update / delete."""
    cols = [c for c in before.columns if c != key]

    def digest(df: DataFrame, name: str) -> DataFrame:
        # Hash once per row so the join ships a key and 32 characters, not the rows.
        text = F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})
        return df.select(key, F.md5(text).alias(name))

    both = digest(before, "_b").join(digest(after, "_a"), key, "full")
    change = (
        F.when(F.col("_b").isNull(), "insert").when(F.col("_a").isNull(), "delete").when(F.col("_a") != F.col("_b"), "update")
    )
    return both.select(key, change.alias("change")).filter(F.col("change").isNotNull())
