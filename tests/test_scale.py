"""What lists, plans and iterations must not do as tables grow."""

from pyspark.sql import functions as F

from recsql.operators import catalog
from recsql.session import stored


def test_explain_does_not_broadcast_the_lists(spark):
    """Lists of many users that recommend the same items are a small file, but not a small table."""
    users = spark.range(200_000).select(F.col("id").alias("user_id"), F.explode(F.sequence(F.lit(1), F.lit(10))).alias("rank"))
    recs = stored(users.withColumn("item_id", F.col("rank").cast("long")))
    items = spark.range(400_000).select(F.col("id").alias("item_id"), F.concat(F.lit("A|B "), "id").alias("genres"))
    train = spark.range(2_000_000).select(F.col("id").alias("user_id"), (F.col("id") % 10).alias("item_id"))
    plan = catalog.explain(recs, train, items)._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in plan


def test_explain_keeps_its_rows(spark):
    recs = spark.createDataFrame([(1, 1, 10), (1, 2, 20), (2, 1, 10), (3, 1, None)], "user_id long, rank int, item_id long")
    train = spark.createDataFrame([(1, 30), (1, 40), (2, 20), (2, 20), (None, 30)], "user_id long, item_id long")
    items = spark.createDataFrame([(10, "A|B"), (20, "B"), (20, "C"), (30, "B"), (40, "A"), (None, "A")], "item_id long, genres string")
    got = sorted((r.user_id, r["rank"], r.reason) for r in catalog.explain(recs, train, items).collect())
    assert got == [(1, 1, "your favourite genre: A"), (1, 2, "your favourite genre: B"), (2, 1, "your favourite genre: B"),
                   (3, 1, catalog.GENERIC_REASON)]
