"""Intermediate tables in the cluster's shared checkpoint folder.

A ``Scratch`` writes a frame as parquet, which cuts its lineage and outlives a
lost executor, and reads it back with column pruning. ``finish`` writes the
result and removes every other table of the run, so only the result's own
small table stays behind."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir, ship_package

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    def __init__(self, spark: SparkSession, batch_rows: int | None = None):
        """``batch_rows``: rows of an Arrow batch in the steps written here, for
        operators whose rows are large."""
        ship_package(spark)
        self.settings = {_CLEANUP: "true"} | ({_BATCH: str(batch_rows)} if batch_rows else {})
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
        self.paths: list[str] = []
        self.count = 0

    def write(self, df: DataFrame) -> DataFrame:
        # A step's shuffle files go with the step, so that a long operator does
        # not hold the files of all its steps at once; those of other actions go
        # when the driver's JVM collects its garbage.
        self.spark._jvm.System.gc()
        path = f"{self.root}/{self.count}"
        self.count += 1
        conf = self.spark.conf
        before = {k: conf.get(k, None) for k in self.settings}
        for k, v in self.settings.items():
            conf.set(k, v)
        try:
            df.write.parquet(path)
        finally:
            for k, v in before.items():
                conf.unset(k) if v is None else conf.set(k, v)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, keep: str | None = None) -> None:
        for path in self.paths:
            if path != keep:
                p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        self.paths = [keep] if keep else []

    def finish(self, df: DataFrame) -> DataFrame:
        out = self.write(df)
        self.drop(keep=self.paths[-1])
        return out


def checked_broadcast(df: DataFrame, max_rows: int = 100_000, max_bytes: int | None = None) -> DataFrame:
    """Hint a broadcast only after the row count is known to be at most
    ``max_rows`` and, where given, the bytes of its columns at most
    ``max_bytes``; a larger side keeps the planner's shuffle join."""
    from pyspark.sql import functions as F
    if max_bytes is None:
        return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
    size = sum((F.coalesce(F.octet_length(f.name), F.lit(0)) if f.dataType.typeName() in ("string", "binary") else F.lit(8)
                for f in df.schema), F.lit(0))
    have = df.agg(F.count("*").alias("n"), F.sum(size.cast("long")).alias("bytes")).first()
    return F.broadcast(df) if have["n"] <= max_rows and (have["bytes"] or 0) <= max_bytes else df
