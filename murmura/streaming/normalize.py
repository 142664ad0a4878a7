"""Normalise a stream of pains: the store and the thresholds are carried from batch to batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from murmura import constants as K
from murmura.operators.learn import adapt_thresholds, session_stats, thresholds_dict
from murmura.plans.normalize import normalize_batch
from murmura.schemas import CANONICAL, THRESHOLDS
from murmura.session import settled
from murmura.sources.store import SnapshotStore


class StreamState:
    """Folders of a stream: the canonical store, and per store version its thresholds and normalised pains."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self.store = SnapshotStore(spark, f"{self.root}/store", CANONICAL)
        self.spark = spark

    def thresholds_before(self, version: int) -> dict:
        """Thresholds that the store's versions before this one led to; a replay reads the same ones again."""
        if self.store.version() == 0:
            return dict(K.INITIAL_THRESHOLDS)
        rows = self.spark.read.parquet(f"{self.root}/thresholds").filter(F.col("version") < version)
        last = rows.orderBy(F.desc("version")).limit(1)
        return dict(K.INITIAL_THRESHOLDS) if last.isEmpty() else thresholds_dict(last)

    def normalized(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/normalized")

    def apply(
        self, pains: DataFrame, batch_id: int, day: Column, order: str = "pain_id", source: str = "", **options
    ) -> None:
        """One micro-batch. A replay of a batch of the same source that was committed changes nothing."""
        if self.store.applied(batch_id, source):
            return
        # Named by the version it leads to: batch numbers start anew with each source.
        version = self.store.version() + 1
        limits = self.thresholds_before(version)
        batch = normalize_batch(
            pains, self.store.read(), f"batch_{version - 1}", day, order, thresholds=limits, **options
        )
        normalized = settled(batch.normalized)
        # Each version has its folders and overwrites them, so a batch that failed half way can run again.
        normalized.write.mode("overwrite").parquet(f"{self.root}/normalized/version={version}")
        state = self.spark.createDataFrame([tuple(limits[c] for c in THRESHOLDS.fieldNames())], THRESHOLDS)
        adapted = adapt_thresholds(state, session_stats(normalized))
        adapted.write.mode("overwrite").parquet(f"{self.root}/thresholds/version={version}")
        # The store commit comes last: it marks the batch as applied.
        self.store.commit_changes(batch.updated.unionByName(batch.created), batch_id, source)


def stream_id(spark: SparkSession) -> str:
    """Inside a micro-batch: the id of the stream, which a restart keeps and a new offsets folder renews."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


def start(
    pains: DataFrame, root: str, day: Column, order: str = "pain_id", available_now: bool = True, **options
) -> StreamingQuery:
    """Run the stream of pains into the folders under `root`; offsets are checkpointed there too."""
    state = StreamState(pains.sparkSession, root)
    writer = pains.writeStream.foreachBatch(
        lambda df, batch_id: state.apply(df, batch_id, day, order, stream_id(df.sparkSession), **options)
    ).option("checkpointLocation", f"{state.root}/offsets")
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
