"""Time split: boundaries found by counting against a sort of every user."""

import numpy as np
import pytest

from recsql.operators import splits


def _rows(seed):
    rng = np.random.default_rng(seed)
    out = []
    for user, n, span in ((1, 400, 10**9), (2, 300, 3), (3, 90, 1), (4, 12, 50), (5, 1, 9), (6, 41, 10**6)):
        items = rng.permutation(5000)[:n]  # one rating for each item, many equal timestamps
        out += [(user, int(i), int(rng.integers(1, 6)), int(t)) for i, t in zip(items, rng.integers(0, span, n), strict=True)]
    return out


def _brute(rows, ratio):
    test = set()
    for user in {r[0] for r in rows}:
        own = sorted((r[3] if r[3] is not None else -1, r[1]) for r in rows if r[0] == user)
        test |= {(user, i) for _, i in own[len(own) - max(1, int(len(own) * ratio)):]}
    return test


@pytest.mark.parametrize("heavy,buckets", [(100_000, 1024), (40, 8), (5, 1024)])
def test_split_equals_sorting_every_user(spark, monkeypatch, heavy, buckets):
    monkeypatch.setattr(splits, "HEAVY_USER", heavy)
    monkeypatch.setattr(splits, "BUCKETS", buckets)
    rows = _rows(heavy)
    if heavy == 5:
        rows += [(7, i, 3, None) for i in range(20)] + [(7, 100 + i, 3, 5) for i in range(2)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating int, timestamp long").repartition(3)
    got = splits.split_by_time(df, 0.2).collect()
    assert sorted((r.user_id, r.item_id) for r in got) == sorted((r[0], r[1]) for r in rows)
    assert {(r.user_id, r.item_id) for r in got if r.fold == "test"} == _brute(rows, 0.2)


def test_no_global_sort_and_empty_table(spark):
    df = spark.createDataFrame(_rows(1), "user_id long, item_id long, rating int, timestamp long")
    plan = splits.split_by_time(df)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan.lower()
    assert splits.split_by_time(df.limit(0)).count() == 0
