"""Training of MF over packed blocks: the same steps as rating by rating, few rows."""

import numpy as np

from recsql.models import mf


def test_packed_training_equals_steps_by_hand(spark, monkeypatch):
    monkeypatch.setattr(mf, "CHUNK", 7)
    rng = np.random.default_rng(1)
    rows = [(int(u), int(i) + 100, float(r)) for u, i, r in
            zip(rng.integers(0, 30, 200), rng.integers(0, 20, 200), rng.integers(1, 6, 200), strict=True)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    k, nb, batch, lr, reg, seed = 3, 2, 16, 0.05, 0.02, 42
    blocks = {(c, x[c]): x["b"] for c in ("user_id", "item_id") for x in df.select(c, mf._block(c, nb).alias("b")).distinct().collect()}
    side = {}
    for c, s in (("user_id", 1), ("item_id", 2)):
        side |= {(c, r[c]): np.append(r.vec, 0.0) for r in mf.init_vectors(df, c, k, seed, s).collect()}
    mu = np.mean([r for _, _, r in rows])
    for turn in range(2 * nb):
        s = turn % nb
        for g in range(nb):
            here = sorted(x for x in rows if blocks["user_id", x[0]] == g and blocks["item_id", x[1]] == (g + s) % nb)
            order = np.random.default_rng([seed, turn, g]).permutation(len(here))
            for lo in range(0, len(here), batch):
                step = {}
                for j in order[lo:lo + batch]:
                    u, i = ("user_id", here[j][0]), ("item_id", here[j][1])
                    a, b = side[u], side[i]
                    e = here[j][2] - mu - a[k] - b[k] - a[:k] @ b[:k]
                    step[u] = step.get(u, 0) + lr * (e * np.append(b[:k], 1.0) - reg * a)
                    step[i] = step.get(i, 0) + lr * (e * np.append(a[:k], 1.0) - reg * b)
                for x, d in step.items():
                    side[x] = side[x] + d
    m = mf.fit(df, n_factors=k, n_epochs=2, lr=lr, reg=reg, seed=seed, batch_size=batch, n_strata=nb)
    got = {(c, r[c]): np.append(r.vec, r.bias) for t, c in ((m.users, "user_id"), (m.items, "item_id")) for r in t.collect()}
    assert got.keys() == side.keys()
    for x in got:
        np.testing.assert_allclose(got[x], side[x], atol=1e-10)


def test_a_state_is_a_few_rows(spark):
    df = spark.createDataFrame([("U", j % 2, j, [0.5, float(j)], 0.25) for j in range(300)],
                               "kind string, b int, id long, vec array<double>, bias double").coalesce(1)
    state = mf._encode(df)
    assert state.count() == 2
    assert sorted((r.id, r.vec, r.bias) for r in mf._decode(state, 2).collect()) == [(j, [0.5, float(j)], 0.25) for j in range(300)]
