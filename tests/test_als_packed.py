"""ALS over packed blocks: the rows it reads and the factors it solves."""

import numpy as np
import pytest

from recsql.models import als
from recsql.plans.blocked import spread_keys


def _dense(rows, users, items, q0, k, reg, epochs):
    mu = np.mean([r for _, _, r in rows])
    q = {i: (v, 0.0) for i, v in q0.items()}
    p = {}

    def solve(ids, pos, other, fixed):
        out = {}
        for x in ids:
            mine = [row for row in rows if row[pos] == x]
            V = np.array([fixed[row[other]][0] for row in mine])
            t = np.array([row[2] - mu - fixed[row[other]][1] for row in mine])
            v = np.linalg.solve(V.T @ V + reg * np.eye(k), V.T @ t)
            out[x] = (v, float(np.mean(t - V @ v)))
        return out
    for _ in range(epochs):
        p = solve(users, 0, 1, q)
        q = solve(items, 1, 0, p)
    return p, q


@pytest.mark.parametrize("hot_rows", [65_536, 12])
def test_fit_equals_dense_half_steps(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(als, "HOT_ROWS", hot_rows)
    monkeypatch.setattr(als, "LEAST_RATINGS", 40)  # several blocks
    rng = np.random.default_rng(8)
    rows = [(int(u), int(i) + 1000, int(r)) for u, i, r in
            zip(rng.integers(0, 25, 300), rng.integers(0, 18, 300) ** 2 // 17, rng.integers(1, 6, 300), strict=True)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating int")
    k, reg = 3, 0.1
    q0 = {r.item_id: np.array(r.vec) for r in als.init_vectors(df, "item_id", k, 42, 2).collect()}
    p, q = _dense(rows, {r[0] for r in rows}, {r[1] for r in rows}, q0, k, reg, 2)
    m = als.fit(df, n_factors=k, reg=reg, n_epochs=2)
    for table, key, want in ((m.users, "user_id", p), (m.items, "item_id", q)):
        got = {r[key]: (np.array(r.vec), r.bias) for r in table.collect()}
        assert got.keys() == want.keys()
        for x in got:
            np.testing.assert_allclose(got[x][0], want[x][0], atol=1e-8)
            assert got[x][1] == pytest.approx(want[x][1], abs=1e-8)


def test_ratings_and_factors_travel_as_one_row_a_block(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(int(u), int(i), 3) for u, i in rng.integers(0, 50, (600, 2))], "user_id long, item_id long, rating int")
    side = als.packed_side(df, "user_id", "item_id", 2, spread_keys(spark, 2), None)
    assert side.count() <= 2 * (2 + 2)  # per block: its ratings, the ids they need, and those by block of the other side
    assert sum(len(r.r) // 8 for r in side.filter("to = -1").collect()) == 600
