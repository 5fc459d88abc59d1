"""The pyspark.ml variant: what its iterations leave on disk."""

import time

import numpy as np

from recsql.models import als

from .test_session import _shuffle_files


def test_ml_als_removes_the_shuffles_of_its_iterations(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(int(u), int(i), int(r)) for u, i, r in zip(
        rng.integers(0, 60, 900), rng.integers(0, 40, 900), rng.integers(1, 6, 900), strict=True)], "user_id long, item_id long, rating int")
    before = _shuffle_files(spark)
    als.fit_ml(df, n_factors=3, n_epochs=9)  # nine iterations of two shuffles, each of ten tasks
    for _ in range(40):  # they go in the background
        if len(_shuffle_files(spark) - before) < 120:
            break
        time.sleep(0.25)
    assert len(_shuffle_files(spark) - before) < 120
