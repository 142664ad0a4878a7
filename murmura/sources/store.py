"""Canonical store: scans, and a snapshot store on parquet.

Spark's parquet tables take no MERGE, so an upsert writes the contexts it touches anew, then a manifest that
names the version of every context, and last the pointer row that commits both. A reader never sees a
half-written version and no folder being read is overwritten; a lost executor only repeats its write task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmura.operators.schema_ops import align, backfill
from murmura.schemas import CANONICAL

PARTITIONS = ("categoria", "familia")


def active(df: DataFrame) -> DataFrame:
    """Active rows; a missing flag counts as active."""
    return df.filter(F.coalesce(F.col("is_active"), F.lit(True)))


def by_execution(df: DataFrame, execution_id: str) -> DataFrame:
    """Active rows created or last updated by one execution."""
    touched = (F.col("created_by_execution") == execution_id) | (F.col("last_execution_updated") == execution_id)
    return active(df).filter(touched)


def write_partitioned(df: DataFrame, path: str, partitions=PARTITIONS) -> None:
    """Write partitioned by context. REBALANCE sizes the files: small ones merge, a hot context is split."""
    df.hint("rebalance", *partitions).write.mode("overwrite").partitionBy(*partitions).parquet(path)


def compact(spark: SparkSession, path: str, target: str, partitions=PARTITIONS) -> None:
    """Rewrite the files of a folder into well-sized ones."""
    write_partitioned(spark.read.parquet(path), target, partitions)


class SnapshotStore:
    """Versioned store under one folder.

    `rows/v=N/` holds the contexts (categoria, familia) that version N wrote, `_manifest/n=N` the version that
    each context has in N, `_changes/n=N` the rows that led to it, `_pointer` the committed versions with the
    batch and the source (say, a stream's id) that each came from.
    """

    POINTER = "version int, batch_id long, source string"

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType = CANONICAL, partitions=PARTITIONS):
        self.spark, self.root, self.schema, self.partitions = spark, root.rstrip("/"), schema, partitions

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _commits(self) -> DataFrame | None:
        fs, p = self._fs(f"{self.root}/_pointer")
        if not fs.exists(p):
            return None
        return self.spark.read.schema(self.POINTER).json(f"{self.root}/_pointer")

    def version(self) -> int:
        """Last committed version, 0 for a new store."""
        commits = self._commits()
        return 0 if commits is None else (commits.agg(F.max("version")).first()[0] or 0)

    def applied(self, batch_id: int, source: str = "") -> bool:
        """True if a commit carries this batch of this source, so a replayed batch can be skipped."""
        commits = self._commits()
        same = (F.col("batch_id") == batch_id) & (F.coalesce("source", F.lit("")) == source)
        return commits is not None and not commits.filter(same).isEmpty()

    def manifest(self, version: int) -> DataFrame:
        """The version `v` that holds each context."""
        parts = [f for f in self.schema.fields if f.name in self.partitions]
        schema = T.StructType([T.StructField("v", T.IntegerType()), *parts])
        return self.spark.read.schema(schema).parquet(f"{self.root}/_manifest/n={version}")

    def _contexts(self, df: DataFrame) -> DataFrame:
        # A folder cannot tell an empty text from a missing one.
        return df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in self.partitions]).distinct()

    def _in(self, df: DataFrame, keys: DataFrame, names, how: str) -> DataFrame:
        right = keys.select(*[F.col(c).alias(f"_{c}") for c in names])
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names]
        return df.join(right, reduce(and_, same), how)

    def _rows(self, version: int) -> DataFrame:
        manifest = self.manifest(version)
        live = sorted(r.v for r in manifest.select("v").distinct().collect())  # a number for each version kept
        if not live:
            return self.spark.createDataFrame([], self.schema)
        schema = T.StructType([*self.schema.fields, T.StructField("v", T.IntegerType())])
        folders = [f"{self.root}/rows/v={v}" for v in live]
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/rows").parquet(*folders)
        return align(self._in(rows, manifest, ("v", *self.partitions), "left_semi"), self.schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the last version, or of an earlier one that is kept."""
        version = self.version() if version is None else version
        return self._rows(version) if version else self.spark.createDataFrame([], self.schema)

    def commit(self, df: DataFrame, batch_id: int = -1, source: str = "") -> int:
        """Write all rows as the next version."""
        version = self.version() + 1
        folder = f"{self.root}/rows/v={version}"
        write_partitioned(backfill(align(df, self.schema)), folder, self.partitions)
        written = self.spark.read.schema(self.schema).parquet(folder)
        self._commit(self._contexts(written).withColumn("v", F.lit(version)), version, batch_id, source)
        return version

    def commit_changes(self, changes: DataFrame, batch_id: int = -1, source: str = "") -> int:
        """The next version: changed rows replace those of the same id, new ones are added.

        Only contexts with a change are read and written; the others stay in the folder of their version. The
        context of an id must not change.
        """
        now = self.version()
        version = now + 1
        log = f"{self.root}/_changes/n={version}"
        backfill(align(changes, self.schema)).write.mode("overwrite").parquet(log)
        changed = self.spark.read.schema(self.schema).parquet(log)
        touched = self._contexts(changed)
        rows, manifest = changed, touched.withColumn("v", F.lit(version))
        if now:
            old = self._in(self._rows(now), touched, self.partitions, "left_semi")
            rows = old.join(changed.select("id"), "id", "left_anti").unionByName(changed)
            manifest = self._in(self.manifest(now), touched, self.partitions, "left_anti").unionByName(manifest)
        write_partitioned(rows, f"{self.root}/rows/v={version}", self.partitions)
        self._commit(manifest, version, batch_id, source)
        return version

    def _commit(self, manifest: DataFrame, version: int, batch_id: int, source: str) -> None:
        manifest.select("v", *self.partitions).write.mode("overwrite").parquet(f"{self.root}/_manifest/n={version}")
        row = self.spark.createDataFrame([(version, batch_id, source)], self.POINTER)
        row.coalesce(1).write.mode("append").json(f"{self.root}/_pointer")

    def expire(self, keep: int) -> list[int]:
        """Delete what only versions before the last `keep` need. Returns the versions whose rows went."""
        if keep < 1:
            raise ValueError("the last version cannot expire")
        last = self.version()
        kept = range(max(1, last - keep + 1), last + 1)
        needed = {r.v for n in kept for r in self.manifest(n).select("v").distinct().collect()}
        gone = [v for v in self._numbers("rows", "v=") if v <= last and v not in needed]
        for folder, mark, numbers in (("rows", "v=", gone), *((f, "n=", self._numbers(f, "n=")) for f in ("_manifest", "_changes"))):
            for n in numbers:
                if folder == "rows" or n < kept.start:
                    fs, p = self._fs(f"{self.root}/{folder}/{mark}{n}")
                    fs.delete(p, True)
        return gone

    def _numbers(self, folder: str, mark: str) -> list[int]:
        fs, p = self._fs(f"{self.root}/{folder}")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n.removeprefix(mark)) for n in names if n.startswith(mark))
