"""Session statistics and adaptive thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura import constants as K
from murmura.schemas import THRESHOLDS


def session_stats(normalized: DataFrame, *keys: str) -> DataFrame:
    """Counts per tier, merge and precision rates, mean quality (missing counts as 1).

    Rejected pains are not part of a session.
    """
    kept = normalized.filter(F.col("canonical_id").isNotNull())
    level = F.col("context_level")
    quality = F.col("overall_quality") if "overall_quality" in normalized.columns else F.lit(None).cast("double")
    stats = kept.groupBy(*keys).agg(
        F.count("*").alias("total_processed"),
        F.count_if(level == "new").alias("new_created"),
        F.count_if(level == "trio").alias("trio_matches"),
        F.count_if(level == "pair").alias("pair_matches"),
        F.count_if(level == "semantic").alias("semantic_matches"),
        F.avg(F.coalesce(quality, F.lit(1.0))).alias("avg_quality"),
    )
    return stats.withColumns(
        {
            "merge_rate": F.try_divide(F.col("trio_matches") + F.col("pair_matches"), "total_processed"),
            "precision_rate": F.try_divide("trio_matches", "total_processed"),
        }
    )


def initial_thresholds(spark: SparkSession) -> DataFrame:
    t = K.INITIAL_THRESHOLDS
    return spark.createDataFrame([(t["trio"], t["pair"], t["semantic"], t["consolidation"])], THRESHOLDS)


def adapt_thresholds(state: DataFrame, stats: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Next thresholds from the one-row state and the statistics of a session.

    Several sessions give one row each, named by `keep` columns.

    Few merges relax the wide tiers, many tighten the narrow ones; quality moves the consolidation
    interval. Nothing changes on an empty session.
    """
    # One row of thresholds, read as a value beside every session; nothing is joined.
    row = state.agg(F.first(F.struct(*THRESHOLDS.fieldNames()))).scalar()
    both = stats.withColumn("_state", row).select("*", "_state.*")
    some = F.coalesce(F.col("total_processed"), F.lit(0)) > 0
    few, many = some & (F.col("merge_rate") < 0.3), some & (F.col("merge_rate") > 0.8)
    good, poor = some & (F.col("avg_quality") > 0.9), some & (F.col("avg_quality") < 0.7)
    return both.select(
        *keep,
        F.when(many, F.least(F.lit(0.85), F.col("trio") + 0.01)).otherwise(F.col("trio")).alias("trio"),
        F.when(few, F.greatest(F.lit(0.60), F.col("pair") - 0.02))
        .when(many, F.least(F.lit(0.80), F.col("pair") + 0.01)).otherwise(F.col("pair")).alias("pair"),
        F.when(few, F.greatest(F.lit(0.55), F.col("semantic") - 0.02)).otherwise(F.col("semantic")).alias("semantic"),
        F.when(good, F.least(F.lit(5), F.col("consolidation") + 1))
        .when(poor, F.greatest(F.lit(2), F.col("consolidation") - 1)).otherwise(F.col("consolidation"))
        .cast("int").alias("consolidation"),
    )


def thresholds_dict(state: DataFrame) -> dict:
    """The one-row state as arguments of the match plan."""
    return state.select(*THRESHOLDS.fieldNames()).first().asDict()
