"""Batches of rows: index by global order, statistics per batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


FAN, LEVELS = 4096, 3


def _starts(sizes: DataFrame, levels: int) -> DataFrame:
    """(_b, _before): the rows before each span, from (_b, _n)."""
    group = F.floor(F.col("_b") / FAN).cast("long") if levels else F.lit(0).cast("long")
    grouped = sizes.withColumn("_g", group)
    inside = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counted = grouped.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    if not levels:
        return counted.select("_b", F.col("_in").alias("_before"))
    above = _starts(grouped.groupBy(F.col("_g").alias("_b")).agg(F.sum("_n").alias("_n")), levels - 1)
    above = above.select(F.col("_b").alias("_g"), F.col("_before").alias("_outer"))
    return counted.join(above, "_g").select("_b", (F.col("_outer") + F.col("_in")).alias("_before"))


def batch_assign(df: DataFrame, order: str, bucket: Column, size: int = 25) -> DataFrame:
    """Adds `batch_index`: rows in `order`, `size` to a batch, as slices of one sorted list.

    The global row number is built from spans: `bucket`, a whole number, must grow with `order`. Rows are
    numbered inside their spans; spans are summed inside groups of them, groups inside groups of groups,
    so that no task sees more than FAN sums at any size up to FAN ** 4 spans.
    """
    cut = df.withColumn("_b", bucket.cast("long"))
    starts = _starts(cut.groupBy("_b").agg(F.count("*").alias("_n")), LEVELS)
    no = F.row_number().over(Window.partitionBy("_b").orderBy(order))
    return (
        cut.withColumn("_no", no)
        .join(starts, "_b")
        .withColumn("batch_index", F.floor((F.col("_before") + F.col("_no") - 1) / size))
        .drop("_b", "_no", "_before")
    )


def batch_stats(rows: DataFrame, started: str | None = None, ended: str | None = None) -> DataFrame:
    """Rows, successes and errors per batch; with both times also seconds and rows per second."""
    ok = F.col("status") == "success"
    aggs = [F.count("*").alias("n"), F.count_if(ok).alias("sucessos"), F.count_if(~ok).alias("erros")]
    if started and ended:
        span = (F.max(ended).cast("double") - F.min(started).cast("double"))
        aggs += [span.alias("duration_s"), F.coalesce(F.try_divide(F.count("*"), span), F.lit(0.0)).alias("throughput")]
    return rows.groupBy("batch_index").agg(*aggs)
