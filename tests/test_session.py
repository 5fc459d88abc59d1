"""Tables written on the way: evaluated once, without shuffle files left behind."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from recsql.session import materialize, stored


def _shuffle_files(spark) -> set:
    root = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in root.localDirsString() for f in glob.glob(os.path.join(d, "*", "shuffle_*.data"))}


@pytest.mark.parametrize("write", [materialize, stored])
def test_no_shuffle_files_stay(spark, write):
    ran = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            ran.add(len(b))
            yield b
    df = spark.range(4000, numPartitions=4).withColumn("g", F.col("id") % 50).mapInPandas(count, "id long, g long")
    df = df.groupBy("g").agg(F.sum("id").alias("s")).join(df.groupBy("g").agg(F.count(F.lit(1)).alias("n")).hint("merge"), "g")
    before = _shuffle_files(spark)
    out = write(df)
    assert not _shuffle_files(spark) - before
    assert ran.value <= 8000  # the two branches, once each
    assert sorted((r.g, r.n) for r in out.collect()) == [(g, 80) for g in range(50)]
    assert ran.value <= 8000
