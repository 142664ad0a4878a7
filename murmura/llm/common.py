"""What several operators share: tables in the shared folder, gapless numbers, Arrow helpers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from murmura.operators.bitmap import BITS, among, beside  # noqa: F401
from murmura.session import CHECKPOINT_CONF, ensure_checkpoint_dir

#: Lower-cases A to Z only, as all operators on words do.
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors reach (named by the cluster; a local master gets one)."""
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if not folder:
        ensure_checkpoint_dir(spark)
        folder = spark.sparkContext.getCheckpointDir()
    return f"{folder.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, *partitions: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage, survives lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, groups: Sequence[str], order: Sequence[Column], bucket: Column, name: str) -> DataFrame:
    """Number the rows of each group gaplessly from 0, by `order`.

    `bucket` must follow `order` (its buckets are ranges of it). Rows are numbered inside (group, bucket)
    and moved up by the rows of earlier buckets, so a group that holds most rows is many tasks' work.
    `df` is read twice.
    """
    rows = df.withColumn("__bucket", bucket)
    by = [*groups, "__bucket"]
    before = Window.partitionBy(*groups).orderBy("__bucket")
    base = (
        rows.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(*by, (F.sum("__n").over(before) - F.col("__n")).alias("__base"))
    )
    inside = Window.partitionBy(*by).orderBy(*order)
    return (
        rows.join(base, by)
        .withColumn(name, (F.col("__base") + F.row_number().over(inside) - 1).cast("long"))
        .drop("__bucket", "__base")
    )


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, list] | None], schema: T.StructType, small: int = 512
) -> DataFrame:
    """Arrow batch to columns; batches are cut to `small` rows, so that long texts don't add up in memory."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, small):
                out = fn(batch.slice(at, small))
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow
                    )

    return df.mapInArrow(run, schema)


def with_defaults(df: DataFrame, **kinds: str) -> DataFrame:
    """Only the named columns, cast; other columns of the input are left behind, so names can't clash."""
    return df.select(*[F.col(c).cast(k).alias(c) for c, k in kinds.items()])
