import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]").appName("recsql-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="recsql-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def g1(spark):
    """Golden fixture G1 (FIXTURES.md section 3)."""
    ratings = spark.createDataFrame(
        [(1, 10, 5, 100), (1, 20, 3, 200), (1, 30, 4, 300), (2, 10, 4, 110), (2, 20, 2, 210),
         (2, 40, 5, 310), (3, 20, 4, 120), (3, 30, 5, 220), (3, 40, 1, 320), (4, 10, 2, 130)],
        "user_id long, item_id long, rating int, timestamp long")
    items = spark.createDataFrame(
        [(10, "Ten (1990)", "Action|Comedy"), (20, "Twenty (1991)", "Drama"), (30, "Thirty (1992)", "Sci-Fi|Action"),
         (40, "Forty (1993)", "Comedy|Romance"), (50, "Fifty (1994)", "")],
        "item_id long, title string, genres string")
    return ratings, items
