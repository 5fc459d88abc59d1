"""Neighbour lists and neighbourhood scores against plain loops."""

import numpy as np
import pytest

from recsql.plans import neighbors


@pytest.fixture(params=["one block", "many blocks"])
def sizes(request, monkeypatch):
    if request.param == "many blocks":
        for name, value in dict(LISTS_ITEM_BLOCK=3, LISTS_LEAST=2, LISTS_PAIRS=20, USER_CHUNK=4, PAIRS_AT_ONCE=7,
                                PENDING_PAIRS=15, TOPK_LEFT=9, TOPK_RIGHT=11).items():
            monkeypatch.setattr(neighbors, name, value)


def _ratings():
    rng = np.random.default_rng(3)
    rows = [(u, i, int(rng.integers(1, 6))) for u in range(14) for i in range(100, 113) if rng.random() < 0.35]
    return rows + [(99, i, 3) for i in range(100, 113)] + [(50, 400, 2)]  # a full row; an item without neighbours


@pytest.mark.parametrize("longest", [0, 3])
def test_cosine_lists(spark, sizes, longest):
    rows = _ratings()
    df = spark.createDataFrame([*rows, (None, 100, 5), (7, None, 5)], "user_id long, item_id long, rating int")
    got = neighbors.cosine_lists(df, 14, 1e-9, longest).collect()  # nothing cuts the lists after the tasks
    cells = {(u, i): r for u, i, r in rows}
    items = sorted({i for _, i, _ in rows})
    q = {i: sum(r * r for _, j, r in [*rows, (None, 100, 5)] if i == j) for i in items}
    exp = {}
    for i in items:
        sims = [(sum(r * cells.get((u, j), 0) for (u, x), r in cells.items() if x == i)
                 / ((q[i] ** 0.5 + 1e-9) * (q[j] ** 0.5 + 1e-9)), j) for j in items if j != i]
        sims = sorted(((-round(s, 9), j, s) for s, j in sims if s > 0))
        exp |= {(i, j): s for _, j, s in (sims[:longest] if longest else sims)}
    assert {(r.item_id, r.neighbor_id): r.sim for r in got} == pytest.approx(exp) and len(got) == len(exp)


def test_neighbor_topk(spark, sizes):
    left = [(u, i, float(r)) for u, i, r in _ratings()]
    right = [(m, c, ((m * 7 + c * 3) % 5 + 1) / 4) for m in range(100, 113) for c in range(100, 120) if (m + c) % 3]  # many ties
    got = neighbors.neighbor_topk(spark.createDataFrame([*left, (None, 100, 1.0), (5, None, 1.0)], "row long, mid long, lv double"),
                                  spark.createDataFrame(right, "mid long, col long, rv double"), 4, 16, len(left), len(right))
    sums, seen = {}, {(r, m) for r, m, _ in left}
    for r, m, v in left:
        for x, c, w in right:
            if x == m and (r, c) not in seen:
                sums.setdefault(r, {}).setdefault(c, 0.0)
                sums[r][c] += v * w
    exp = [(r, n + 1, c, round(-s, 9)) for r, by in sums.items()
           for n, (s, c) in enumerate(sorted((-round(s, 9), c) for c, s in by.items())[:4])]
    assert sorted((x.user_id, x.rank, x.item_id, round(x.score, 9)) for x in got.collect()) == sorted(exp)


def test_ranks_come_with_the_lists(spark, sizes):
    df = spark.createDataFrame(_ratings(), "user_id long, item_id long, rating int")
    rows = neighbors.cosine_lists(df, 14, 1e-9, 4, ranked=True).collect()
    by = {}
    for r in rows:
        by.setdefault(r.item_id, []).append((-round(r.sim, 9), r.neighbor_id, r.nrank))
    assert by and all([n for *_, n in sorted(x)] == list(range(1, len(x) + 1)) for x in by.values())


def test_first_of_long_rows():
    rng = np.random.default_rng(4)
    row = np.sort(rng.integers(0, 9, 5000))
    value = rng.integers(0, 40, 5000) / 8 + rng.normal(0, 1e-11, 5000)  # many ties once rounded
    value[rng.integers(0, 5000, 20)] = np.nan
    keep, rank = neighbors._first(row, value, 7)
    exp = []
    for r in range(9):
        at = np.flatnonzero(row == r)
        key = np.where(np.isnan(value[at]), -np.inf, -np.round(value[at], 9))
        exp += list(zip(at[np.argsort(key, kind="stable")][:7], range(7)))
    assert list(zip(keep, rank)) == exp


def test_neighbor_sums(spark, sizes, monkeypatch):
    if neighbors.TOPK_LEFT < 100:
        monkeypatch.setattr(neighbors, "SUMS_LISTS", 6)
        monkeypatch.setattr(neighbors, "SUMS_CELLS", 16)
    rated = [*_ratings(), (3, 111, None)] if (3, 111) not in {(u, i) for u, i, _ in _ratings()} else _ratings()
    lists = [(c, m, ((m * 7 + c * 3) % 5 + 1) / 4) for m in range(100, 113) for c in range(100, 120) if (m + c) % 3]
    pairs = [(u, i) for u in (*range(14), 99, 777) for i in (101, 104, 108, 119, 500)]
    got = neighbors.neighbor_sums(spark.createDataFrame([*pairs, (None, 101), (3, None)], "user_id long, item_id long"),
                                  spark.createDataFrame([*rated, (None, 100, 5)], "user_id long, item_id long, rating int"),
                                  spark.createDataFrame([*lists, (None, 100, 1.0)], "item_id long, neighbor_id long, sim double"))
    exp = {}
    for u, i in pairs:
        met = [(s, r) for x, j, s in lists if x == i for v, k, r in rated if v == u and k == j]
        if met:
            known = [s * r for s, r in met if r is not None]
            exp[u, i] = (sum(known) if known else None, sum(s for s, _ in met))
    found = {(r.user_id, r.item_id): (r._num, r._den) for r in got.collect()}
    assert found.keys() == exp.keys() and len(found) == got.count()
    for x, (num, den) in exp.items():
        assert found[x][0] == (None if num is None else pytest.approx(num)) and found[x][1] == pytest.approx(den)
