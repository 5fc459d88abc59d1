"""Blocked scoring: packed rows, tiles, and sparse products by dense pieces."""

import numpy as np
import pytest

from recsql.plans import blocked


def _vecs(spark, key, ids, rows):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, rows, strict=True)],
                                 f"{key} long, vec array<double>")


def test_a_block_travels_as_few_rows(spark):
    rng = np.random.default_rng(3)
    uv, iv = _vecs(spark, "user_id", range(60), rng.normal(size=(60, 3))), _vecs(spark, "item_id", range(80), rng.normal(size=(80, 3)))
    seen = spark.createDataFrame([(u, i) for u in range(60) for i in range(0, 80, 7)], "user_id long, item_id long")
    parts = blocked._grouped(uv, iv, seen, 2, 3, 30, 30)
    assert parts.count() <= 3 * 2 * 3  # users, items and seen cells of every pair, one row each
    got = parts.filter("kind = 'I'").selectExpr("_ub", "explode(ids) AS id").groupBy("id").count().collect()
    assert len(got) == 80 and {r["count"] for r in got} == {2}


def test_ids_beyond_doubles_and_lists_across_tiles(spark, monkeypatch):
    monkeypatch.setattr(blocked, "USER_TILE", 4)
    monkeypatch.setattr(blocked, "ITEM_TILE", 5)
    rng = np.random.default_rng(4)
    top = 1 << 60
    uids, iids = [top + j for j in range(9)], [top + 2 * j + 1 for j in range(23)]
    U, I = rng.integers(-2, 3, (9, 3)), rng.integers(-2, 3, (23, 3))  # many ties
    seen = [(uids[j % 9], iids[(5 * j) % 23]) for j in range(40)]
    got = blocked.blocked_topk(_vecs(spark, "user_id", uids, U), _vecs(spark, "item_id", iids, I),
                               spark.createDataFrame(seen, "user_id long, item_id long"), 4).collect()
    want = []
    for u, x in zip(uids, U, strict=True):
        free = sorted((-float(x @ y), i) for i, y in zip(iids, I, strict=True) if (u, i) not in set(seen))
        want += [(u, r + 1, i, -s) for r, (s, i) in enumerate(free[:4])]
    assert sorted((r.user_id, r.rank, r.item_id, r.score) for r in got) == sorted(want)


@pytest.mark.parametrize("worth", [0, 1e9])
def test_sparse_products_either_way(monkeypatch, worth):
    monkeypatch.setattr(blocked, "DENSE_WORTH", worth)
    monkeypatch.setattr(blocked, "DENSE_TERMS", 3)
    rng = np.random.default_rng(6)
    X, Y = rng.random((7, 20)) * (rng.random((7, 20)) < 0.4), rng.random((9, 20)) * (rng.random((9, 20)) < 0.4)
    X[2] = 0.0

    def rows(M):
        r, c = np.nonzero(M)
        return blocked.SparseRows(np.zeros((len(M), 0)), r, c, M[r, c])
    np.testing.assert_allclose(blocked.sparse_dot(rows(X), rows(Y)), X @ Y.T, atol=1e-12)
