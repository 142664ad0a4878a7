"""Exact duplicates by a 128-bit content hash, with the bytes compared inside every group.

The first pass writes a small row per document: id, MD5 of the text, a row tag. Hashes that occur more than once
are counted from these rows, so no text is shuffled for a document without a partner. The second pass compares
bytes: the texts whose hash is in a bitmap of the repeated hashes are grouped by hash and text, which collapses
copies before the shuffle, so a third of all rows being one text costs a row per task. (The bitmap has a fixed
number of bits, which bounds the broadcast; where more hashes repeat than it can tell apart, more texts take part
in the comparison, and the result is the same.) Hashes that hold several texts are collisions; their rows are
grouped by hash and text instead of by hash.

Built-in functions only; group sizes and the row that stays are joined to the small rows, one row a hash on the
right, so adaptive execution can split a hot group.

Defined cases: null texts count as empty; texts are compared byte by byte, unchanged; of rows that repeat an id
and a text exactly one stays (which one is open, as nothing tells them apart but columns that take no part); null
ids give way to all others, and `keep_id` is null where all ids are; an empty table gives an empty table; other
columns of the input are not carried, but for expressions named in `carry`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import BITS, among, written


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _best(keep: str, doc: str, tag: str) -> Column:
    """The row that stays, as (null, id, tag): ids that are null lose."""
    if keep == "largest":
        return F.max(F.struct(F.col(doc).isNotNull().alias("known"), F.col(doc).alias("id"), F.col(tag).alias("tag")))
    if keep == "smallest":
        return F.min(F.struct(F.col(doc).isNull().alias("known"), F.col(doc).alias("id"), F.col(tag).alias("tag")))
    raise ValueError(f"keep is 'smallest' or 'largest', not {keep!r}")


def groups(
    docs: DataFrame,
    keep: str = "smallest",
    carry: Mapping[str, Column] | None = None,
    hash_of: Callable[[Column], Column] = content_hash,
    bits: int = BITS,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and the carried expressions, a row for each row of docs.

    `keep` names the id that stays, smallest or largest; `hash_of` is replaced in tests, to make collisions.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    extra = {f"__carry{i}": c for i, c in enumerate((carry or {}).values())}
    doc = F.col("doc_id").cast("long").alias("__doc")
    rows = docs.select(doc, hash_of(text).alias("__hash"), *[c.alias(n) for n, c in extra.items()])
    # Written, so that the tags don't change.
    keyed = written(rows.withColumn("__tag", F.monotonically_increasing_id()))
    counted = keyed.groupBy("__hash").agg(F.count(F.lit(1)).alias("__n"), _best(keep, "__doc", "__tag").alias("__best"))
    repeated = written(counted.filter("__n > 1"))

    texts = docs.select(text.alias("__text"), hash_of(text).alias("__hash"))
    alike = among(texts, repeated, "__hash", bits).groupBy("__hash", "__text").agg(F.count(F.lit(1)).alias("__n"))
    collided = written(alike.groupBy("__hash").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("__hash"))
    if collided.isEmpty():
        return _named(keyed.join(repeated, "__hash", "left"), carry)

    apart = docs.select(doc, text.alias("__text"), hash_of(text).alias("__hash"), *[c.alias(n) for n, c in extra.items()])
    apart = among(apart, collided, "__hash", bits).join(collided, "__hash", "left_semi")
    apart = written(apart.withColumn("__tag", F.monotonically_increasing_id()))
    by_text = apart.groupBy("__hash", "__text").agg(F.count(F.lit(1)).alias("__n"), _best(keep, "__doc", "__tag").alias("__best"))
    pure = keyed.join(collided, "__hash", "left_anti").join(repeated, "__hash", "left")
    return _named(pure, carry).unionByName(_named(apart.join(by_text, ["__hash", "__text"]), carry))


def _named(joined: DataFrame, carry: Mapping[str, Column] | None) -> DataFrame:
    own = F.col("__n").isNull()
    return joined.select(
        F.col("__doc").alias("doc_id"),
        F.when(own, F.col("__doc")).otherwise(F.col("__best.id")).alias("keep_id"),
        F.coalesce("__n", F.lit(1).cast("long")).alias("group_size"),
        (own | (F.col("__tag") == F.col("__best.tag"))).alias("kept"),
        *[F.col(f"__carry{i}").alias(n) for i, n in enumerate(carry or {})],
    )
