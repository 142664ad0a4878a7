"""Match pains to canonicals in three nested contexts.

Tier 1 "trio": same category, family and product; tier 2 "pair": same category and family; tier 3
"semantic": same category. The first tier with an accepted canonical wins, there the best adjusted
similarity, ties by (creation_date, id). A pair that misses a narrow tier is tried in the wider ones.

Everything is computed per distinct (context, text), so copies of a pain cost one row until the last
join, and the best canonical is reduced per context before contexts meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura import constants as K
from murmura.functions import similarity as S
from murmura.functions.text import normalize_text
from murmura.operators.bitmap import among
from murmura.operators.textjoin import similar_pairs
from murmura.session import release, settled

CONTEXT = ("categoria", "familia", "produto")
NORM = "text_norm"
KEY = [*CONTEXT, NORM]
OUTCOME = {"canonical_id": "string", "canonical_text": "string", "similarity_score": "double", "context_level": "string"}


def with_context(df: DataFrame, text: str) -> DataFrame:
    """Context columns without NULLs, and the normalised text."""
    known = {c: F.coalesce(F.col(c), F.lit(K.UNKNOWN)) for c in CONTEXT}
    # The list of one is worked out once; tests for NULL on a plain column would normalise the text again below it.
    return df.withColumns({**known, NORM: F.explode(F.array(normalize_text(F.col(text))))})


def score_floor(thresholds: dict, tiers=(1, 2, 3), popular_tiers: bool = False, by_method: float = 1.0) -> float:
    """Least raw score any requested tier can accept, whatever the canonical's factors (confidence <= 1)."""
    best_factor = (1.10 if popular_tiers else 1.05) * by_method
    return min(thresholds[name] / (factor * best_factor) for no, name, factor in K.TIERS if no in tiers)


def canonical_contexts(canonicals: DataFrame, popular_tiers: bool = False) -> DataFrame:
    """Canonicals with equal context, text and factor reduced to the first created."""
    ranked = with_context(canonicals, "canonical_text").withColumn(
        "factor", S.canonical_factor(F.col("confidence_score"), F.col("usage_count"), popular_tiers)
    )
    first = F.min(F.struct("creation_date", "id", "canonical_text")).alias("first")
    grouped = ranked.filter(F.col(NORM).isNotNull()).groupBy(*KEY, "factor").agg(first)
    return _shared(grouped.filter(F.col("first").isNotNull()), *KEY, "factor")


def _shared(grouped: DataFrame, *keys: str) -> DataFrame:
    """Keeps a grouped table one shuffle for all its users, where column pruning would give each its own input.

    The exchange itself goes, as the rows lie so already; what stays is that all of `keys` are wanted. Tests for
    NULL on texts and aggregates stand before it, so that no user adds one of its own.
    """
    return grouped.repartition(*keys)


def _block(tiers) -> Column:
    """Text pairs need only meet inside the widest context asked for."""
    keys = CONTEXT[: 4 - max(tiers)]
    return F.concat_ws("\u001f", *keys)


def _tier_keys(no: int) -> tuple[Column, Column]:
    family = F.col("familia") if no <= 2 else F.lit("")
    product = F.col("produto") if no == 1 else F.lit("")
    return family.alias("kf"), product.alias("kp")


def best_in_context(pairs: DataFrame, contexts: DataFrame, thresholds: dict, tiers) -> DataFrame:
    """Per block, pain text and context key: the best canonical each tier accepts."""
    scored = pairs.join(
        contexts.withColumn("block", _block(tiers)).withColumnRenamed(NORM, "c_text"), ["block", "c_text"]
    )
    offers = []
    for no, name, tier_factor in K.TIERS:
        if no not in tiers:
            continue
        adjusted = S.boosted(F.col("score"), F.col("factor"), tier_factor)
        ok = adjusted >= thresholds[name]
        if no <= 2:
            ok = ok & (F.col("familia") != K.UNKNOWN)
        offers.append(F.when(ok, F.struct(F.lit(no).alias("tier"), *_tier_keys(no), adjusted.alias("adjusted"))))
    offered = scored.select(
        "block", "p_text", "first", F.explode(F.array_compact(F.array(*offers))).alias("o")
    )
    return (
        offered.groupBy("block", "p_text", F.col("o.tier").alias("tier"), F.col("o.kf").alias("kf"), F.col("o.kp").alias("kp"))
        .agg(F.min(F.struct((-F.col("o.adjusted")).alias("rank"), F.col("first").alias("first"))).alias("best"))
        .withColumnRenamed("p_text", NORM)
    )


def resolve_contexts(contexts: DataFrame, best: DataFrame, tiers) -> DataFrame:
    """Per distinct pain context: the narrowest tier that has a best canonical."""
    asks = F.array_compact(
        F.array(
            *[
                F.when(
                    F.lit(no == 3) | (F.col("familia") != K.UNKNOWN),
                    F.struct(F.lit(no).alias("tier"), *_tier_keys(no)),
                )
                for no in tiers
            ]
        )
    )
    asked = contexts.withColumn("block", _block(tiers)).select("block", *KEY, F.explode(asks).alias("a"))
    asked = asked.select("block", *KEY, "a.tier", "a.kf", "a.kp")
    found = asked.join(best, ["block", NORM, "tier", "kf", "kp"])
    chosen = found.groupBy(*KEY).agg(F.min(F.struct("tier", "best")).alias("m"))
    level = F.element_at(
        F.array(*[F.lit(name) for _, name, _ in K.TIERS]), F.col("m.tier")
    )
    return chosen.select(
        *KEY,
        F.col("m.best.first.id").alias("canonical_id"),
        F.col("m.best.first.canonical_text").alias("canonical_text"),
        (-F.col("m.best.rank")).alias("similarity_score"),
        level.alias("context_level"),
    )


def match(
    pains: DataFrame,
    canonicals: DataFrame,
    thresholds: dict | None = None,
    tiers: tuple[int, ...] = (1, 2, 3),
    text: str = "dor_especifica",
    sequence: str = "ratio",
    autojunk: bool = False,
    popular_tiers: bool = False,
) -> DataFrame:
    """All pains with canonical_id, canonical_text, similarity_score, context_level; NULL where none matched.

    Confidences are held to 0..1. `sequence`: see `textjoin.similar_pairs`.
    """
    thresholds = thresholds or K.INITIAL_THRESHOLDS
    p = with_context(pains, text)
    # Read by the count of frequent words, the join and the choice of the best.
    stored = settled(canonical_contexts(canonicals, popular_tiers))
    if stored.isEmpty():
        # Nothing can match, so no text is keyed.
        return p.select(*p.columns, *[F.lit(None).cast(kind).alias(name) for name, kind in OUTCOME.items()]).drop(NORM)
    contexts = settled(p.filter(F.col(NORM).isNotNull()).select(*KEY).distinct())
    pairs = settled(
        similar_pairs(
            contexts.withColumn("block", _block(tiers)),
            stored.withColumn("block", _block(tiers)),
            "block", NORM, NORM,
            score_floor(thresholds, tiers, popular_tiers), sequence, autojunk,
        )
    )
    # Of both sides only the texts that a pair has are dealt again.
    offered = among(stored, pairs.select(F.col("c_text").alias(NORM)), NORM)
    best = settled(best_in_context(pairs, offered, thresholds, tiers))
    release(p.sparkSession)
    # One row per key on the right: copies of a hot text on the left are split by the skew join.
    return p.join(resolve_contexts(among(contexts, best, NORM), best, tiers), KEY, "left").drop(NORM)


def match_trio(pains: DataFrame, canonicals: DataFrame, **options) -> DataFrame:
    return match(pains, canonicals, tiers=(1,), **options)


def match_pair(pains: DataFrame, canonicals: DataFrame, **options) -> DataFrame:
    return match(pains, canonicals, tiers=(2,), **options)


def match_semantic(pains: DataFrame, canonicals: DataFrame, **options) -> DataFrame:
    return match(pains, canonicals, tiers=(3,), **options)


def match_cascade(pains: DataFrame, canonicals: DataFrame, **options) -> DataFrame:
    return match(pains, canonicals, tiers=(1, 2, 3), **options)


def match_identical(pains: DataFrame, canonicals: DataFrame, text: str = "dor_especifica") -> DataFrame:
    """Pains whose normalised text equals a canonical's in the same category: score 1, no text comparison."""
    first = (
        with_context(canonicals, "canonical_text")
        .groupBy("categoria", NORM)
        .agg(F.min(F.struct("creation_date", "id")).alias("first"))
    )
    joined = with_context(pains, text).join(first, ["categoria", NORM])
    return joined.select(
        *pains.columns,
        F.col("first.id").alias("canonical_id"),
        F.lit(1.0).alias("similarity_score"),
        F.lit("identical").alias("method"),
    )
