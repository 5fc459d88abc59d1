"""The full-batch step of matrix factorisation and the states of an iteration."""

import os

import numpy as np
import pytest

from recsql.models import mf
from recsql.session import Steps


def test_full_batch_step_equals_numpy_and_gathers_no_block(spark):
    rng = np.random.default_rng(4)
    users, items = ({i: (rng.normal(size=3), float(rng.normal())) for i in range(n)} for n in (9, 7))
    rows = [(u, i, float(rng.integers(1, 6))) for u in range(8) for i in range(7) if rng.random() < 0.5]  # user 8 has none
    state = spark.createDataFrame([("U", u, v.tolist(), b) for u, (v, b) in users.items()]
                                  + [("I", i, v.tolist(), b) for i, (v, b) in items.items()] + [("U", None, [1.0, 2.0, 3.0], 0.5)],
                                  "kind string, id long, vec array<double>, bias double")
    mu, lr, reg = 3.0, 0.05, 0.02
    out = mf._full_batch(state, spark.createDataFrame(rows, "uid long, iid long, r double"), mu, lr, reg, 3)
    assert "CoGroups" not in out._jdf.queryExecution().executedPlan().toString()
    exp = {("U", u): np.append(v, b) for u, (v, b) in users.items()} | {("I", i): np.append(v, b) for i, (v, b) in items.items()}
    for u, i, r in rows:
        (p, bu), (q, bi) = users[u], items[i]
        e = r - mu - bu - bi - p @ q
        exp["U", u] = exp["U", u] + lr * (np.append(e * q, e) - reg * np.append(p, bu))
        exp["I", i] = exp["I", i] + lr * (np.append(e * p, e) - reg * np.append(q, bi))
    exp["U", None] = np.array([1.0, 2.0, 3.0, 0.5])
    got = {(r.kind, r.id): [*r.vec, r.bias] for r in out.collect()}
    assert set(got) == set(exp)
    for key, x in exp.items():
        assert got[key] == pytest.approx(list(x), abs=1e-12)


def test_steps_keep_the_last_states_only(spark):
    steps = Steps(spark, keep=2)
    states = [steps.write(spark.range(n + 1)) for n in range(4)]
    root = steps.root.removeprefix("file:")
    assert sorted(os.listdir(root)) == ["2", "3"] and [s.count() for s in states[2:]] == [3, 4]
    steps.drop()
    assert not os.path.exists(root)
