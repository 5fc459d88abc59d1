"""Ratings and split of a context are tables that scans can prune."""

import datetime

from recsql.plans.context import Context
from recsql.session import stored


def test_stored_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, "a", None), (None, None, 2.5), (1, "a", None)], "k long, s string, v double")
    out = stored(df)
    assert out.schema == df.schema and out.inputFiles()
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))


def test_context_reads_its_ratings_and_split_from_tables(spark, tmp_path):
    day = datetime.date(1995, 1, 1)
    spark.createDataFrame([(o, 1 + o % 5, day + datetime.timedelta(days=o)) for o in range(40)],
                          "o_orderkey long, o_custkey long, o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(o, 1 + (o * 7 + n) % 9, n, float(1 + o % 50)) for o in range(40) for n in range(2)],
                          "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    c = Context(spark, str(tmp_path))
    assert c.ratings.inputFiles() and c.split.inputFiles()
    assert c.ratings.count() == c.train.count() + c.test.count() + c.cold.count() > 0
