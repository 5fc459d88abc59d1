"""Invariants: partition independence, exclusions, block plans equal brute
force, planted-signal recovery for the factor models, persistence, plans."""

import math
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from recsql.models import als, content, mf, popularity
from recsql.models.factors import train_rmse
from recsql.operators import splits
from recsql.plans import blocked
from recsql.plans.ranking import global_positions, rank_in_group
from recsql.sources import tables as T
from recsql.sources.store import load_model, save_model

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def small(spark):
    r = T.ratings(spark, SF_SMALL).cache()
    return r, T.items(spark, SF_SMALL).cache()


def _rows(df):
    return sorted(tuple(x) for x in df.collect())


def test_dedup_matches_count(small):
    r, _ = small
    assert r.count() == 5382  # FIXTURES: sf0.001 -> 5,382 deduplicated ratings


def test_split_disjoint_and_complete(small):
    r, _ = small
    s = splits.split_cold_users(r)
    assert s.count() == r.count()
    tr, te, co = (splits.fold(s, f) for f in ("train", "test", "cold"))
    assert tr.join(co, "user_id", "left_semi").count() == 0
    assert tr.join(te, ["user_id", "item_id"], "left_semi").count() == 0
    last_train = tr.groupBy("user_id").agg(F.max(F.struct("timestamp", "item_id")).alias("a"))
    first_test = te.groupBy("user_id").agg(F.min(F.struct("timestamp", "item_id")).alias("b"))
    assert last_train.join(first_test, "user_id").filter(F.col("a") >= F.col("b")).count() == 0


def test_rank_in_group_partition_independent(small):
    r, _ = small
    order = [F.col("timestamp").asc(), F.col("item_id").asc()]
    a = rank_in_group(r.repartition(1), ["user_id"], order).select("user_id", "item_id", "rn", "n")
    b = rank_in_group(r.repartition(7), ["user_id"], order).select("user_id", "item_id", "rn", "n")
    assert _rows(a) == _rows(b)
    pos = global_positions(r.select("item_id").distinct(), [F.col("item_id").asc()])
    p = pos.orderBy("pos").collect()
    assert [x.pos for x in p] == list(range(1, len(p) + 1))
    assert [x.item_id for x in p] == sorted(x.item_id for x in p)


def test_popularity_recs_invariants(small):
    r, items = small
    tr = splits.fold(splits.split_by_time(r), "train")
    users = r.select("user_id").distinct()
    recs1 = popularity.recommend(popularity.fit(tr.repartition(1)), users, 10)
    recs7 = popularity.recommend(popularity.fit(tr.repartition(7)), users, 10)
    assert _rows(recs1) == _rows(recs7)
    assert recs1.join(tr, ["user_id", "item_id"], "left_semi").count() == 0
    ranks = recs1.groupBy("user_id").agg(F.collect_list("rank").alias("r")).collect()
    assert all(sorted(x.r) == list(range(1, len(x.r) + 1)) for x in ranks)


def test_blocked_topk_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(0)
    U = {int(u): rng.normal(size=4).round(3) for u in range(23)}
    I = {int(i): rng.normal(size=4).round(3) for i in range(100, 141)}
    seen = [(u, i) for u in U for i in I if (u * 7 + i) % 5 == 0]
    uv = spark.createDataFrame([(u, v.tolist()) for u, v in U.items()], "user_id long, vec array<double>")
    iv = spark.createDataFrame([(i, v.tolist()) for i, v in I.items()], "item_id long, vec array<double>")
    sv = spark.createDataFrame(seen, "user_id long, item_id long")
    got = blocked.blocked_topk(uv, iv, sv, 5, user_block=4, item_block=6).toPandas()
    s = set(seen)
    for u, p in U.items():
        sc = sorted(((-round(float(p @ q), 9), i) for i, q in I.items() if (u, i) not in s))[:5]
        exp = [i for _, i in sc]
        assert list(got[got.user_id == u].sort_values("rank").item_id) == exp


def test_blocked_gram_equals_naive(spark, monkeypatch):
    monkeypatch.setattr(blocked, "GRAM_ITEM_BLOCK", 3)
    monkeypatch.setattr(blocked, "GRAM_USERS_PER_CHUNK", 4)
    rng = np.random.default_rng(1)
    rows = [(u, i, int(rng.integers(1, 6))) for u in range(15) for i in range(12) if rng.random() < 0.4]
    rows.append((99, 0, 5))  # one very active user spanning every item block
    rows += [(99, i, 3) for i in range(1, 12)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating int")
    got = {(x.i, x.j): x.dot for x in blocked.blocked_gram(df, 16, 12, len(rows)).collect()}
    pdf = pd.DataFrame(rows, columns=["u", "i", "r"])
    m = pdf.pivot_table(index="u", columns="i", values="r", fill_value=0).to_numpy(float)
    g = m.T @ m
    ids = sorted(pdf.i.unique())
    exp = {(ids[a], ids[b]): g[a, b] for a in range(len(ids)) for b in range(len(ids)) if a != b and g[a, b] != 0}
    assert got == pytest.approx(exp)


def _planted(spark):
    rows = []
    for u in range(200):
        for i in range(100):
            if (u * 7919 + i * 104729 + u * i * 31) % 100 < 30:
                x = 3 + 0.5 * math.sin(u) + 0.5 * math.cos(i) + sum(
                    math.sin(u * (k + 1) * 0.37) * math.cos(i * (k + 1) * 0.53) for k in range(3))
                rows.append((u, i, int(min(5, max(1, math.floor(x + 0.5)))), (u * 31 + i * 17) % 1000))
    r = spark.createDataFrame(rows, "user_id long, item_id long, rating int, timestamp long")
    s = splits.split_by_time(r)
    return splits.fold(s, "train"), splits.fold(s, "test")


def _rmse(df):
    e = F.col("rating").cast("double") - F.col("prediction")
    return df.agg(F.sqrt(F.avg(e * e))).first()[0]


def test_planted_signal_als(spark):
    tr, te = _planted(spark)
    assert (tr.count(), te.count()) == (4744, 1156)
    mu = tr.agg(F.avg("rating")).first()[0]
    base = te.agg(F.sqrt(F.avg((F.col("rating") - F.lit(mu)) ** 2))).first()[0]
    assert base == pytest.approx(1.012, abs=2e-3)
    m = als.fit(tr, None, n_factors=5, reg=0.1, n_epochs=6)
    assert _rmse(als.predict(m, te)) < 0.6


def test_planted_signal_mf(spark):
    tr, te = _planted(spark)
    mu = tr.agg(F.avg("rating")).first()[0]
    base = te.agg(F.sqrt(F.avg((F.col("rating") - F.lit(mu)) ** 2))).first()[0]
    m1 = mf.fit(tr, None, n_factors=10, n_epochs=2, lr=0.05, n_strata=3)
    m2 = mf.fit(tr, None, n_factors=10, n_epochs=8, lr=0.05, n_strata=3)
    assert train_rmse(m2, tr) < train_rmse(m1, tr)
    assert _rmse(mf.predict(m2, te)) < base


def test_store_round_trip(spark, g1):
    r, items = g1
    pairs = r.select("user_id", "item_id", "rating")
    for mod, cls in ((popularity, popularity.PopularityModel), (content, content.ContentModel)):
        m = mod.fit(r, items)
        path = tempfile.mkdtemp(prefix="recsql-model-")
        save_model(m, path)
        m2 = load_model(spark, path, cls)
        a = {(x.user_id, x.item_id): x.prediction for x in mod.predict(m, pairs).collect()}
        b = {(x.user_id, x.item_id): x.prediction for x in mod.predict(m2, pairs).collect()}
        assert a == pytest.approx(b, abs=1e-5)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, small):
    r, items = small
    from recsql.plans.registry import spark_queries
    q = spark_queries()
    raw = T.ratings_raw(spark, SF_SMALL)
    p = _plan(raw)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double>" in p
    for name in ("m2_itemcf_neighbors", "m4_itemcf_recommend", "m1_popularity_recommend", "m10_content_recommend"):
        plan = _plan(q[name](spark, SF_SMALL))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_tiled_spmm_equals_naive(spark, monkeypatch):
    monkeypatch.setattr(blocked, "SPMM_ROWS_PER_CHUNK", 3)
    monkeypatch.setattr(blocked, "SPMM_COLS_PER_BLOCK", 4)
    monkeypatch.setattr(blocked, "GRAM_PAIRS_PER_SLICE", 7)  # force several slices per tile
    rng = np.random.default_rng(2)
    left = [(r, m, float(rng.integers(1, 6))) for r in range(11) for m in range(9) if rng.random() < 0.35]
    left += [(r, 0, 2.0) for r in range(11) if (r, 0) not in {(a, b) for a, b, _ in left}]  # a hot mid
    right = [(m, c, round(float(rng.random()), 3)) for m in range(9) for c in range(100, 113) if rng.random() < 0.3]
    right += [(0, c, 0.5) for c in range(100, 113) if (0, c) not in {(a, b) for a, b, _ in right}]
    L = spark.createDataFrame(left, "row long, mid long, lv double")
    R = spark.createDataFrame(right, "mid long, col long, rv double")
    got = {(x.row, x.col): x.value for x in blocked.tiled_spmm(L, R, 11, 13).collect()}
    exp = {}
    for r, m, v in left:
        for m2, c, w in right:
            if m == m2:
                exp[(r, c)] = exp.get((r, c), 0.0) + v * w
    assert got == pytest.approx(exp)


def test_hybrid_equals_brute_force(spark, small):
    """Two-pass blocked hybrid ranking == per-user min-max fusion over all candidates."""
    from recsql.models import hybrid
    r, items = small
    s = splits.split_cold_users(r)
    tr, cold = splits.fold(s, "train"), splits.fold(s, "cold")
    m = hybrid.fit(tr, items, alpha=0.6, cf_params=dict(n_factors=4, n_epochs=2))
    warm_u = tr.select("user_id").orderBy("user_id").first()[0]
    cold_u = cold.select("user_id").orderBy("user_id").first()[0]
    users = spark.createDataFrame([(warm_u,), (cold_u,)], "user_id long")
    recs = hybrid.recommend(m, users, 10).toPandas()
    cands = m.cf.items.select("item_id").unionByName(m.content.catalogue.select("item_id")).distinct()
    for u in (warm_u, cold_u):
        pairs = cands.withColumn("user_id", F.lit(u).cast("long"))
        a = mf.predict(m.cf, pairs).toPandas().set_index("item_id").prediction
        b = content.predict(m.content, pairs).toPandas().set_index("item_id").prediction

        def mm(x):
            lo, hi = x.min(), x.max()
            return x * 0 if hi - lo < 1e-9 else (x - lo) / (hi - lo)
        f = 0.6 * mm(a) + 0.4 * mm(b)
        seen = {x.item_id for x in tr.filter(F.col("user_id") == u).collect()}
        f = f[~f.index.isin(seen)]
        exp = pd.DataFrame({"item_id": f.index, "s": f.values.round(9)}).sort_values(
            ["s", "item_id"], ascending=[False, True]).item_id[:10].tolist()
        assert recs[recs.user_id == u].sort_values("rank").item_id.tolist() == exp


def test_store_round_trip_composite(spark, g1):
    from recsql.models import coldstart, hybrid, itemcf
    from recsql.models.factors import FactorModel
    r, items = g1
    pairs = r.select("user_id", "item_id", "rating")
    cases = [
        (mf, FactorModel, mf.fit(r, items, n_factors=3, n_epochs=2)),
        (als, FactorModel, als.fit(r, items, n_factors=3, n_epochs=2)),
        (itemcf, itemcf.ItemCFModel, itemcf.fit(r, items, topk_neighbors=0)),
        (coldstart, coldstart.ColdStartModel, coldstart.fit(r, items)),
        (hybrid, hybrid.HybridModel, hybrid.fit(r, items, cf_params=dict(n_factors=3, n_epochs=1))),
    ]
    for mod, cls, m in cases:
        path = tempfile.mkdtemp(prefix="recsql-model-")
        save_model(m, path)
        m2 = load_model(spark, path, cls)
        a = {(x.user_id, x.item_id): x.prediction for x in mod.predict(m, pairs).collect()}
        b = {(x.user_id, x.item_id): x.prediction for x in mod.predict(m2, pairs).collect()}
        assert a == pytest.approx(b, abs=1e-5), cls.__name__


def test_content_signatures_equal_item_scoring(spark, small, monkeypatch):
    """Signature collapse == item-level block scoring, for a user subset, with many blocks."""
    monkeypatch.setattr(blocked, "USER_BLOCK", 16)
    monkeypatch.setattr(blocked, "ITEM_BLOCK", 8)
    r, items = small
    tr = splits.fold(splits.split_by_time(r), "train")
    m = content.fit(tr, items)
    users = tr.select("user_id").distinct().filter(F.col("user_id") % 3 == 0)
    sig = content.recommend(m, users, 10)
    ref = blocked.blocked_topk(content.user_vectors(m, users), content.item_vectors(m), m.seen, 10,
                               score_fn=blocked.sparse_dot, pack=blocked.sparse_rows(),
                               n_items=m.n_items, user_block=16, item_block=64)
    key = lambda df: sorted((x.user_id, x.rank, x.item_id) for x in df.collect())
    assert key(sig) == key(ref)


def test_content_ranks_over_200_000_terms(spark):
    """No bound on the vocabulary: equal to cosines from plain dictionaries."""
    n_items, n_terms = 1100, 200
    terms = {i: [f"t{i}x{j}" for j in range(n_terms)] + [f"s{i % 7}", f"s{i % 11}"] for i in range(n_items)}
    items = spark.createDataFrame([(i, f"Title {i} (1990)", "|".join(t)) for i, t in terms.items()],
                                  "item_id long, title string, genres string")
    liked = {u: [(37 * u + 101 * j) % n_items for j in range(4)] for u in range(12)}
    train = spark.createDataFrame([(u, i, 5, 100 + j) for u, x in liked.items() for j, i in enumerate(x)],
                                  "user_id long, item_id long, rating int, timestamp long")
    m = content.fit(train, items)
    assert m.dim > 200_000
    weights: dict = {}
    for r in m.item_vecs.collect():
        weights.setdefault(r.item_id, {})[r.term] = r.weight
    got: dict = {}
    for r in content.recommend(m, train.select("user_id").distinct(), 10).collect():
        got.setdefault(r.user_id, []).append((r.rank, r.item_id))
    for u, x in liked.items():
        profile: dict = {}
        for i in x:
            for t, w in weights[i].items():
                profile[t] = profile.get(t, 0.0) + w / len(x)
        norm = sum(v * v for v in profile.values()) ** 0.5 + content.EPS
        score = {i: round(sum(w * profile[t] / norm for t, w in weights[i].items() if t in profile), 9)
                 for i in terms if i not in x}
        assert [i for _, i in sorted(got[u])] == sorted(score, key=lambda i: (-score[i], i))[:10]


def test_als_half_step_exact(spark):
    """One ALS half-step (heavy ids pre-aggregated map side, light ids shipped
    raw) equals solving (Q^T Q + reg I) p = Q^T t per user with NumPy."""
    k, reg, mu = 3, 0.1, 3.0
    rng = np.random.default_rng(5)
    items = {i: rng.normal(size=k) for i in range(20)}
    ib = {i: float(rng.normal()) for i in items}
    rows = [(0, i, int(rng.integers(1, 6))) for i in range(20)]            # heavy user: 20 >= k rows
    rows += [(u, int(i), int(rng.integers(1, 6))) for u in range(1, 8) for i in rng.choice(20, 2, replace=False)]
    r = spark.createDataFrame(rows, "user_id long, item_id long, rating int")
    fixed = spark.createDataFrame([(i, v.tolist(), ib[i]) for i, v in items.items()], "id long, vec array<double>, bias double")
    out = als._decode(als.half_step(r, als._encode(fixed), "user_id", "item_id", mu, k, reg), k).collect()
    got = {x.id: (np.array(x.vec), x.bias) for x in out}
    for u in {a for a, _, _ in rows}:
        its = [(i, rt) for a, i, rt in rows if a == u]
        Q = np.array([items[i] for i, _ in its])
        t = np.array([rt - mu - ib[i] for i, rt in its])
        p = np.linalg.solve(Q.T @ Q + reg * np.eye(k), Q.T @ t)
        assert got[u][0] == pytest.approx(p, abs=1e-9)
        assert got[u][1] == pytest.approx(float(np.mean(t - Q @ p)), abs=1e-9)


def test_multik_curves_of_all_seven_models(spark):
    from recsql.plans.registry import spark_queries
    rows = spark_queries()["e11_multik_models"](spark, SF_SMALL).collect()
    names = {"popularity", "itemcf", "svd", "als", "content", "hybrid", "coldstart"}
    assert {(r.model, r.k) for r in rows} == {(m, k) for m in names for k in (5, 10, 15, 20)} and len(rows) == 28
    by = {(r.model, r.k): r for r in rows}
    assert all(0 <= by[m, 5].recall <= by[m, 20].recall <= 1 for m in names)
    assert all(by[m, 5].hitrate <= by[m, 20].hitrate for m in names)
