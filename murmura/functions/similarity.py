"""Text and vector similarity as column expressions.

Texts are expected normalised (`text.normalize_text`).
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from murmura import constants as K
from murmura.functions import batch
from murmura.functions.text import tokens, word_set


def jaccard_of_sets(a: Column, b: Column) -> Column:
    """Jaccard of two duplicate-free word arrays: 1 if both are empty, 0 if one is."""
    common = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        common / (F.size(a) + F.size(b) - common)
    )


def jaccard(a: Column, b: Column) -> Column:
    return jaccard_of_sets(word_set(a), word_set(b))


def containment(a: Column, b: Column) -> Column:
    """1 if the shorter text lies inside the longer one; at equal length `a` inside `b`."""
    inside = F.when(F.length(a) > F.length(b), F.contains(a, b)).otherwise(F.contains(b, a))
    return inside.cast("double")


def word_order(a: Column, b: Column) -> Column:
    """Mean agreement of the relative last positions of the common words; 0 without any."""
    wa, wb = tokens(a), tokens(b)
    common = F.array_intersect(wa, wb)

    def last(words: Column, w: Column) -> Column:
        return (F.size(words) - F.array_position(F.reverse(words), w)) / F.size(words)

    total = F.aggregate(common, F.lit(0.0), lambda acc, w: acc + (1 - F.abs(last(wa, w) - last(wb, w))))
    return F.when(F.size(common) > 0, total / F.size(common)).otherwise(F.lit(0.0))


def edit_score(a: Column, b: Column) -> Column:
    """1 - edit distance over the longer length; 1 for two empty texts."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longest)


def sequence_ratio(autojunk: bool = False):
    """Exact character sequence ratio. The one Python scorer: run it on pruned pairs only.

    `autojunk=True` keeps the library's popular-character heuristic, which can collapse
    scores once the second text has 200 characters or more.
    """

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None if x is None or y is None else SequenceMatcher(None, x, y).ratio() if autojunk else batch.sequence_ratio(x, y)
                for x, y in zip(a, b)
            ],
            dtype="float64",
        )

    return ratio


def clamp01(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def weighted(sequence: Column, jac: Column, cont: Column, order: Column) -> Column:
    w = K.TEXT_WEIGHTS
    return clamp01(
        sequence * w["sequence"] + jac * w["jaccard"] + cont * w["containment"] + order * w["order"]
    )


def textual(a: Column, b: Column, sequence=edit_score) -> Column:
    """Weighted textual score; `sequence` is `edit_score` or `sequence_ratio()`."""
    return weighted(sequence(a, b), jaccard(a, b), containment(a, b), word_order(a, b))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v
    )


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))


def cosine_mapped(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """Cosine mapped to 0..1 as (cos + 1) / 2, so unrelated vectors score 0.5; a zero vector scores 0."""
    na = norm(a) if norm_a is None else norm_a
    nb = norm(b) if norm_b is None else norm_b
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(clamp01((dot(a, b) / (na * nb) + 1) / 2))


def banded(score: Column, second: Column, lo: float = 0.6, hi: float = 0.8) -> Column:
    """In the ambiguous band 0.7 of the score plus 0.3 of a second one. `second` may be NULL outside it."""
    return F.when(score.between(lo, hi), score * 0.7 + F.coalesce(second, score) * 0.3).otherwise(score)


def band_method(score: Column, lo: float = 0.6, hi: float = 0.8) -> Column:
    return F.when(score.between(lo, hi), F.lit("embedding_plus_llm")).otherwise(F.lit("embeddings_only"))


def canonical_factor(confidence: Column, usage: Column, popular_tiers: bool = False) -> Column:
    """Factor of a canonical: its confidence (held to 0..1), and 1.05 if used more than 5 times.

    `popular_tiers=True` also gives 1.10 to canonicals used more than 20 times.
    """
    by_conf = 0.8 + 0.2 * F.least(F.greatest(F.coalesce(confidence, F.lit(1.0)), F.lit(0.0)), F.lit(1.0))
    used = F.coalesce(usage, F.lit(0))
    by_use = F.when(used > 5, F.lit(1.05)).otherwise(F.lit(1.0))
    if popular_tiers:
        by_use = F.when(used > 20, F.lit(1.10)).otherwise(by_use)
    return by_conf * by_use


def method_factor(method: Column) -> Column:
    out = F.lit(1.0)
    for name, factor in K.METHOD_FACTORS.items():
        out = F.when(method == name, F.lit(factor)).otherwise(out)
    return out


def boosted(score: Column, factor: Column, tier_factor, by_method=1.0) -> Column:
    """Similarity after all factors, capped at 1."""
    return F.least(score * factor * tier_factor * by_method, F.lit(1.0))
