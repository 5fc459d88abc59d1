"""Repeated rows, settings that must not change results, plans before a write."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from recsql.functions.stats import t_crit_975
from recsql.models import content, hybrid, itemcf, mf, popularity
from recsql.operators import evaluate, experiments, features, significance, strata
from recsql.plans.context import context
from recsql.plans.ranking import exclude_seen

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def ctx(spark):
    return context(spark, SF_SMALL)


def test_repeated_ratings_keep_the_last(spark):
    rows = [(1, 1, 5, 10), (1, 1, 2, 20), (1, 2, 4, 10), (2, 1, 3, 10), (2, 2, 3, 10), (2, 2, 3, 10)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating int, timestamp long")
    assert {(r.user_id, r.item_id): r.rating for r in popularity.last_ratings(df).collect()} == {
        (1, 1): 2, (1, 2): 4, (2, 1): 3, (2, 2): 3}
    m = itemcf.fit(df)
    assert all(0 < r.sim <= 1 + 1e-9 for r in m.neighbors.collect())


def test_content_with_repeats_loses_no_item(spark, g1):
    ratings, items = g1
    once = content.fit(ratings, items)
    twice = content.fit(ratings.unionByName(ratings), items.unionByName(items))
    users = ratings.select("user_id").distinct()
    a, b = ({(r.user_id, r.rank): r.item_id for r in content.recommend(m, users, 5).collect()} for m in (once, twice))
    assert a == b and once.n_items == twice.n_items


def test_hybrid_predicts_each_row_once(spark, ctx):
    m = ctx.model("hybrid", alpha=0.6, cf_params=dict(n_factors=2, n_epochs=2, n_strata=2, batch_size=None, init="md5"))
    pair = ctx.test.select("user_id", "item_id").limit(1)
    assert hybrid.predict(m, pair.unionByName(pair)).count() == 2


def test_mf_does_not_depend_on_the_session(spark, ctx):
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("2", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            m = mf.fit(ctx.train.repartition(int(n)), n_factors=3, n_epochs=2)
            found.append({r.user_id: (*r.vec, r.bias) for r in m.users.collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0].keys() == found[1].keys()
    assert all(np.allclose(found[0][u], found[1][u], atol=1e-12) for u in found[0])
    with pytest.raises(ValueError):
        mf.fit(ctx.train, n_strata=1)


def test_lists_too_short_for_the_cut_off_are_refused(ctx):
    with pytest.raises(ValueError):
        evaluate.evaluate(popularity, ctx.model("popularity"), ctx.train, ctx.test, ctx.items, 30, recs=ctx.recs("popularity"))


def test_histogram_lists_every_bin(spark):
    df = spark.createDataFrame([(5, 1.0), (5, 4.9), (3, 3.0)], "rating int, prediction double")
    rows = strata.error_histogram(df).orderBy("bin").collect()
    assert [r.bin for r in rows] == list(range(1, 51)) and sum(r["count"] for r in rows) == 3
    assert rows[0].lo == 0 and rows[-1].hi == 4


def test_critical_value(spark):
    rows = spark.range(0, 40).withColumn("c", t_crit_975(F.col("id"))).collect()
    crit = {r.id: r.c for r in rows}
    assert crit[1] == 0 and crit[2] == 100 and crit[31] == 1.96 and crit[30] == pytest.approx(2.0452, abs=2e-2)
    assert all(crit[n] >= crit[n + 1] for n in range(3, 30))


def test_bootstrap_does_not_depend_on_partitioning(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(500)], "user_id long, value double")
    a, b = (significance.bootstrap_ci(df.repartition(n), n_bootstrap=800).first() for n in (1, 5))
    assert tuple(a) == tuple(b) and a.ci_lower < a["mean"] < a.ci_upper
    assert a.ci_upper - a.ci_lower == pytest.approx(2 * 1.96 * a["std"] / 500 ** 0.5, rel=0.15)


def test_splits_of_a_config(ctx):
    runs = {r: experiments.run_experiment(ctx, {"model": {"name": "popularity"}, "split": {"test_ratio": r, "cold_user_ratio": 0.1}, "note": "n"})
            for r in (0.2, 0.4)}
    values = {r: {x.metric: x.value for x in df.collect()} for r, df in runs.items()}
    assert {"cold_serve_rate", "train_s", "rmse"} <= values[0.2].keys()
    assert values[0.2]["rmse"] != values[0.4]["rmse"] and {x.note for x in runs[0.2].collect()} == {"n"}
    plain = {x.metric for x in experiments.run_experiment(ctx, {"model": {"name": "popularity"}, "split": {}}).collect()}
    assert "cold_serve_rate" not in plain


def test_grid_order(ctx):
    cfg = {"model": {"name": "itemcf"}}
    ranked = experiments.run_grid(ctx, cfg, {"topk_neighbors": [40, 10]}, "no such metric").collect()
    assert [r.topk_neighbors for r in ranked] == [40, 10]
    ranked = experiments.run_grid(ctx, cfg, {"topk_neighbors": [10_000, 20_000, 10]}, "rmse").collect()
    ties = [r.topk_neighbors for r in ranked if r.topk_neighbors > 10]
    assert ties == [10_000, 20_000] and [r.rmse for r in ranked] == sorted(r.rmse for r in ranked)


def test_feature_tables(ctx):
    out = features.all_features(ctx.ratings, ctx.items, ctx.users)
    assert set(out) == {"genre_matrix", "item_stats", "user_stats", "user_features"}
    vocabulary = [r.genre for r in features.genre_vocabulary(ctx.items).orderBy("genre_idx").collect()]
    wide = features.genre_matrix_wide(ctx.items, vocabulary)
    assert wide.columns == ["item_id", *vocabulary] and wide.count() == ctx.items.count()
    assert sum(sum(r[1:]) for r in wide.collect()) == out["genre_matrix"].count()
    assert "user_features" not in features.all_features(ctx.ratings, ctx.items, None)


def test_chart_data(ctx):
    long = experiments.run_pipeline(ctx, ["popularity", "coldstart"])
    rows = experiments.chart_data(long, ["cold_serve_rate", "cold_ndcg@10"]).collect()
    assert {r.model for r in rows} == {"popularity", "coldstart"} and len(rows) == 4


def test_plans_before_a_write(ctx):
    """The dataflows themselves, not the tables they were written to."""
    users = ctx.ratings.select("user_id").distinct()
    m = ctx.model("itemcf", topk_neighbors=50)
    flows = {"similarities": itemcf.similarities(ctx.train, 150, 200, 5000), "scores": itemcf.scores(m, users),
             "unseen": exclude_seen(itemcf.scores(m, users), m.train.select("user_id", "item_id")),
             "popularity": popularity.recommend(ctx.model("popularity"), users, 10),
             "content": content.rank_catalogue(ctx.model("content"), content.user_vectors(ctx.model("content"), users),
                                               ctx.model("content").seen, 10)}
    for name, df in flows.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in plan, name  # a dataflow, not a scan of its result
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_als_with_a_hot_id(spark, monkeypatch):
    """One item holds a third of the rows and is dealt over slots; partials of
    one id are added up on the way. Equal to NumPy's solution."""
    from recsql.models import als
    monkeypatch.setattr(als, "HOT_ROWS", 50)
    monkeypatch.setattr(als, "RUNNING_ROWS", 8)
    k, reg, mu = 3, 0.1, 3.0
    rng = np.random.default_rng(9)
    users = {u: rng.normal(size=k) for u in range(400)}
    rows = [(u, 0, int(rng.integers(1, 6))) for u in users]
    rows += [(u, int(i), int(rng.integers(1, 6))) for u in users for i in rng.choice(np.arange(1, 40), 2, replace=False)]
    r = spark.createDataFrame(rows, "user_id long, item_id long, rating int").repartition(5)
    fixed = spark.createDataFrame([(u, v.tolist(), 0.25) for u, v in users.items()], "id long, vec array<double>, bias double")
    hot = als.hot_ids(r, "item_id")
    assert {x.id for x in hot.collect()} >= {0} and als.hot_ids(r, "user_id") is None
    out = als._decode(als.half_step(r, als._encode(fixed), "item_id", "user_id", mu, k, reg, hot), k).collect()
    assert len(out) == len({i for _, i, _ in rows})
    for x in out:
        mine = [(u, rt) for u, i, rt in rows if i == x.id]
        q = np.array([users[u] for u, _ in mine])
        t = np.array([rt - mu - 0.25 for _, rt in mine])
        p = np.linalg.solve(q.T @ q + reg * np.eye(k), q.T @ t)
        assert x.vec == pytest.approx(p, abs=1e-9) and x.bias == pytest.approx(float(np.mean(t - q @ p)), abs=1e-9)
