"""Session helpers. A cluster passes its own session; only tests and the bench build one."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(app: str = "murmura", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench; AQE on, UTC, no UI."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("MURMURA_DRIVER_MEMORY", "12g"))
        .config("spark.murmura.spread", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by the cluster; only a local master gets a temporary one."""
    if spark.sparkContext.getCheckpointDir() is not None:
        return
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="murmura-ckpt-")
    spark.sparkContext.setCheckpointDir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: an iterative plan restarts from files, not from lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settled(df: DataFrame) -> DataFrame:
    """The rows as a compressed table in the checkpoint folder; what led to them goes, its shuffle files too.

    A table takes about a third of a checkpoint's disk. A checkpoint is made of rows that a table can't hold.
    """
    spark, kinds = df.sparkSession, df.schema.simpleString()
    names = {c.lower() for c in df.columns}
    if len(names) < len(df.columns) or any(kind in kinds for kind in ("void", "interval", "struct<>")):
        return cut_lineage(df)
    ensure_checkpoint_dir(spark)
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    path = f"{folder.rstrip('/')}/rows-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that nothing refers to any more; it does so when garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
