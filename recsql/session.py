"""Session construction and lineage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "recsql", cpus: str | int | None = None,
              shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the cluster's builder."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "*")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RECSQL_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``recsql`` importable in the Python workers of this SparkContext
    (once per application): the package is zipped and added with
    ``addPyFile``, which Spark distributes to every executor."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="recsql-pyfiles-"), "recsql.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only a local master may
    fall back to a fresh scratch folder (tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for iterative jobs")
    path = tempfile.mkdtemp(prefix="recsql-ckpt-")
    sc.setCheckpointDir(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a table of this run from the shared folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """What is planned and run inside leaves no shuffle files: they go with each
    execution, not when the driver happens to collect its garbage."""
    conf = spark.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint) and freezes
    non-deterministic columns (partition ids, generated ids). An eager checkpoint
    evaluates the plan once; nothing is held in memory on the way."""
    ensure_checkpoint_dir(df.sparkSession)
    own = df.select("*")  # a plan of its own, whose shuffles nothing else reads
    out = own.checkpoint(eager=True)
    _remove_shuffles(own)
    return out


def _remove_shuffles(df: DataFrame) -> None:
    """Remove the shuffle files of a plan that ran; a checkpoint, unlike a written
    table, does not heed the setting of ``shuffles_removed``."""
    plan = df._jdf.queryExecution().executedPlan()
    cleaner = df.sparkSession.sparkContext._jsc.sc().cleaner()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" and cleaner.isDefined():
        for shuffle in list(plan.context().shuffleIds()):
            cleaner.get().doCleanupShuffle(shuffle, True)


def stored(df: DataFrame) -> DataFrame:
    """Cut lineage by a table in the shared checkpoint folder: for large plain tables
    that many plans read. Columns are compressed and read one by one, and nothing
    is held in memory on the way; a checkpoint writes whole rows, uncompressed."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Steps:
    """The states of an iteration, as tables in the shared checkpoint folder.

    Only the last ``keep`` states stay, and a step's shuffle files go with the
    step, so that disk does not grow with the number of steps."""

    def __init__(self, spark: SparkSession, keep: int = 1):
        self.spark, self.keep, self.count = spark, keep, 0
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/steps-{uuid.uuid4().hex}"

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.count}"
        with shuffles_removed(self.spark):
            df.write.parquet(path)
        if self.count >= self.keep:
            delete_path(self.spark, f"{self.root}/{self.count - self.keep}")
        self.count += 1
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        delete_path(self.spark, self.root)
