"""Store, run and session metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmura import constants as K


def store_distribution(store: DataFrame) -> DataFrame:
    """Rows, mean confidence and mean usage per category and family."""
    return store.groupBy(
        F.coalesce("categoria", F.lit("UNKNOWN")).alias("categoria"),
        F.coalesce("familia", F.lit("UNKNOWN")).alias("familia"),
    ).agg(
        F.count("*").alias("n"),
        F.avg(F.coalesce("confidence_score", F.lit(1.0))).alias("avg_confidence"),
        F.avg(F.coalesce("usage_count", F.lit(0))).alias("avg_usage"),
    )


def context_distribution(store: DataFrame) -> DataFrame:
    """Used canonicals per category/family."""
    used = store.filter(F.coalesce("usage_count", F.lit(0)) > 0)
    context = F.concat_ws("/", F.coalesce("categoria", F.lit("UNKNOWN")), F.coalesce("familia", F.lit("UNKNOWN")))
    return used.groupBy(context.alias("context")).agg(F.count("*").alias("n"))


def store_contexts(store: DataFrame) -> DataFrame:
    """Store totals: rows, contexts in use, mean quality of the rows that have one, mean confidence."""
    context = F.concat_ws("/", F.coalesce("categoria", F.lit("UNKNOWN")), F.coalesce("familia", F.lit("UNKNOWN")))
    used = F.coalesce("usage_count", F.lit(0)) > 0
    quality = F.when(F.col("quality_metrics").isNotNull(), F.coalesce("quality_metrics.overall_quality", F.lit(1.0)))
    return store.agg(
        F.count("*").alias("total_canonical_pains"),
        F.count_distinct(F.when(used, context)).alias("total_contexts"),
        F.coalesce(F.avg(quality), F.lit(0.0)).alias("avg_pain_quality"),
        F.coalesce(F.avg(F.coalesce("confidence_score", F.lit(1.0))), F.lit(0.0)).alias("avg_confidence"),
    )


def store_size(store: DataFrame) -> DataFrame:
    """Approximate size in MB, from the JSON text of the rows."""
    text = F.to_json(F.struct("*"))
    return store.agg(F.count("*").alias("n"), (F.sum(F.length(text)) / (1024 * 1024)).alias("size_mb"))


def run_totals(results: DataFrame) -> DataFrame:
    """Totals and means over the successful rows; zeros for an empty run."""
    a, b = F.col("total_dores_extraidas"), F.col("total_dores_normalizadas")
    return results.filter(F.col("status") == "success").agg(
        F.coalesce(F.sum(a), F.lit(0)).alias("total_extraidas"),
        F.coalesce(F.sum(b), F.lit(0)).alias("total_normalizadas"),
        F.coalesce(F.avg(a), F.lit(0.0)).alias("media_extraidas"),
        F.coalesce(F.avg(b), F.lit(0.0)).alias("media_normalizadas"),
    )


def run_quality(results: DataFrame, *keys: str) -> DataFrame:
    """Rows, successes and the success percentage; 0 for an empty run."""
    ok = F.count_if(F.col("status") == "success")
    return results.groupBy(*keys).agg(
        F.count("*").alias("total"),
        ok.alias("sucessos"),
        F.coalesce(F.try_divide(ok * 100.0, F.count("*")), F.lit(0.0)).alias("taxa_sucesso"),
    )


def feedback_confidence(feedback: DataFrame, pains: DataFrame) -> DataFrame:
    """Mean confidence of the pains of each feedback, 0 without any."""
    per = pains.groupBy("feedback_id").agg(F.avg(F.coalesce("confidence", F.lit(1.0))).alias("_c"))
    return feedback.select("feedback_id").join(per, "feedback_id", "left").select(
        "feedback_id", F.coalesce("_c", F.lit(0.0)).alias("avg_confidence")
    )


def action_counts(normalized: DataFrame) -> DataFrame:
    """Pains per normalisation action, with the counter each action belongs to."""
    action = F.col("normalization_action")
    counter = (
        F.when(action == "created_new", "global_pains_created")
        .when(action == "merged_with_trio", "global_duplicates_prevented")
        .when(action.startswith("merged_with_"), "cross_execution_matches")
        .when(action == "invalid", "invalid_pains_filtered")
        .otherwise("rejected")
    )
    return normalized.groupBy("normalization_action", counter.alias("counter")).agg(F.count("*").alias("n"))


def ops_rates(log: DataFrame, *keys: str) -> DataFrame:
    """Rates over an operations log (op, ok): cache hits, saves without error, saves by fallback."""
    hit, miss = F.count_if(F.col("op") == "cache_hit"), F.count_if(F.col("op") == "embedding_call")
    saves, errors = F.count_if(F.col("op") == "save"), F.count_if((F.col("op") == "save") & ~F.col("ok"))
    fallbacks = F.count_if(F.col("op") == "fallback")

    def rate(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    least_one = F.greatest(saves, F.lit(1))
    return log.groupBy(*keys).agg(
        (hit + miss).alias("total_similarity_calculations"),
        rate(hit, hit + miss).alias("cache_hit_rate"),
        rate(saves - errors, least_one).alias("success_rate"),
        rate(fallbacks, least_one).alias("fallback_rate"),
    )


def quality_trend(runs: DataFrame, metric: str = "metric", run: str = "run", value: str = "value") -> DataFrame:
    """Running mean of each metric over its runs. `runs` has one row per metric and run."""
    w = Window.partitionBy(metric).orderBy(run).rowsBetween(Window.unboundedPreceding, 0)
    return runs.withColumn("trend", F.avg(value).over(w))


def model_usage(scored: DataFrame, *keys: str) -> DataFrame:
    """Tokens and failures per stage from the usage columns of `model.score`."""
    return scored.groupBy(*keys).agg(
        F.count("*").alias("calls"),
        F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("prompt_tokens"),
        F.coalesce(F.sum("completion_tokens"), F.lit(0)).alias("completion_tokens"),
        F.coalesce(F.sum(F.col("prompt_tokens") + F.col("completion_tokens")), F.lit(0)).alias("total_tokens"),
        F.count_if(F.col("error").isNotNull()).alias("errors"),
    )
