"""Screening of score tiles against plain sorts."""

import numpy as np

from recsql.plans import blocked


def test_screening_leaves_few_cells_of_a_first_tile():
    S = np.random.default_rng(1).normal(size=(200, 2100))
    S[3, 5], S[4], S[5, :] = np.nan, -np.inf, 1.0
    S[6, 100:] = -np.inf
    r, c = blocked._reaching(S, np.full(200, -np.inf), 10)
    for x in range(200):
        mine = set(c[r == x])
        if x not in (4, 5):
            best = np.lexsort((np.arange(2100), np.where(np.isnan(S[x]), np.inf, -np.round(S[x], 9))))[:10]
            assert set(best) <= mine | set(np.flatnonzero(~np.isfinite(S[x])))
    many = np.isin(r, [4, 5, 6])
    assert np.count_nonzero(~many) < 3 * 10 * 200  # of 420,000 cells


def test_tiles_equal_a_plain_sort():
    rng = np.random.default_rng(2)
    for k, n_items in ((3, 700), (10, 300), (70, 300), (5, 90)):
        S = np.round(rng.normal(size=(40, n_items)), 1) + rng.normal(0, 1e-11, (40, n_items))  # many ties once rounded
        S[7], S[8, ::2], S[9, 3] = 0.25, -np.inf, np.nan
        rows, cols, val = blocked.tiled_topk(40, n_items, k, lambda u, i, S=S: S[u, i].copy(), None, np.full(40, -np.inf), 16, 256)
        for x in range(40):
            ok = np.flatnonzero(np.isfinite(S[x]))
            exp = ok[np.lexsort((ok, -np.round(S[x, ok], 9)))][:k]
            assert list(cols[rows == x]) == list(exp)


def test_sparse_products_write_a_tile_of_items_once(monkeypatch):
    rng = np.random.default_rng(3)

    def tile(n, terms):
        held = [np.sort(rng.choice(terms, 6, replace=False)) for _ in range(n)]
        return blocked.sparse_rows()([np.concatenate([t.astype(float), rng.random(6)]) for t in held] + [np.zeros(0)])

    def plain(rows):
        out = np.zeros((len(rows.dense), 40))
        out[rows.row, rows.idx] = rows.val
        return out
    written = []
    monkeypatch.setattr(blocked, "_dense", lambda rows, terms, f=blocked._dense: written.append(rows) or f(rows, terms))
    users, items = [tile(30, 40) for _ in range(4)], [tile(50, 40) for _ in range(3)]
    for U in users:
        for I in items:
            np.testing.assert_allclose(blocked.sparse_dot(U, I), plain(U) @ plain(I).T, atol=1e-12)
    assert sum(x is items[0] for x in written) == 1 and len(written) < 2 * 4 * 3
    np.testing.assert_allclose(blocked.sparse_dot(tile(3, 20), tile(4, 20)).shape, (4, 5))
    none = blocked.sparse_rows()([np.zeros(0)] * 2)
    assert not blocked.sparse_dot(users[0], none).any() and not blocked.sparse_dot(none, items[0]).any()
