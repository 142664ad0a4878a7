"""Ranked report of the canonical pains named in a result table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura import constants as K
from murmura.functions.text import preview
from murmura.schemas import PAIN_LIST

GROUP = ("familia", "produto", "categoria", "dor_normalizada", "context_level")


def exploded_pains(results: DataFrame) -> DataFrame:
    """One row per pain of known family in the successful results."""
    ok = results.filter((F.col("status") == "success") & F.col("dores_json").isNotNull())
    rows = ok.select("feedback_id", "feedback", F.explode(F.from_json("dores_json", PAIN_LIST)).alias("d"))
    return rows.select(
        "feedback_id", "feedback", "d.familia", "d.produto", "d.categoria",
        F.col("d.dor_especifica").alias("dor_normalizada"), "d.context_level", "d.canonical_id",
        "d.normalization_action", "d.similarity_score", "d.confidence",
    ).filter(F.col("familia") != K.UNKNOWN)


def _mean(value, default: float):
    """Mean rounded to 3 places. Averaged as decimals: the result does not depend on task order."""
    exact = F.coalesce(value, F.lit(default)).cast("decimal(18,8)")
    return F.round(F.avg(exact), 3).cast("double")


def pain_report(results: DataFrame, top: int = 20) -> DataFrame:
    """The `top` groups by pains, with mean similarity and confidence and distinct canonicals.

    `qtde_feedbacks` counts pain rows, `feedbacks_distintos` feedbacks. The feedbacks behind a
    group are rows of `report_examples`, not one list per group.
    """
    groups = exploded_pains(results).groupBy(*GROUP).agg(
        F.count("feedback_id").alias("qtde_feedbacks"),
        _mean(F.col("similarity_score"), 0.0).alias("similarity_media"),
        _mean(F.col("confidence"), 1.0).alias("confidence_media"),
        F.count_distinct("canonical_id").alias("canonical_ids_count"),
        F.count_distinct("feedback_id").alias("feedbacks_distintos"),
    )
    order = ["familia", "produto", "categoria", "dor_normalizada", "context_level"]
    return groups.orderBy(F.desc("qtde_feedbacks"), *order).limit(top)


def report_examples(results: DataFrame, top: int = 20) -> DataFrame:
    """Every feedback behind the groups of the report: preview, action and similarity, one row each."""
    groups = pain_report(results, top).select(*GROUP)
    # `top` rows, bounded by the limit of the report. Contexts may be NULL, hence the null-safe match.
    on = [F.col(f"p.{c}").eqNullSafe(F.col(f"g.{c}")) for c in GROUP]
    return exploded_pains(results).alias("p").join(F.broadcast(groups.alias("g")), on).select(
        *[f"p.{c}" for c in GROUP],
        "p.feedback_id",
        preview(F.col("p.feedback")).alias("feedback_preview"),
        "p.normalization_action",
        F.round(F.coalesce("p.similarity_score", F.lit(0.0)), 3).alias("similarity"),
    )
