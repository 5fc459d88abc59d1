"""The reference's end-to-end test list, re-run on the driver tables (sf0.001)
with its fast settings (MF 10/2, ALS 10/3, hybrid MF 10/2; cold split .2/.1
seed 11; questionnaire [Action, Comedy], k=8)."""

import pytest
from pyspark.sql import functions as F

from recsql.models import REGISTRY, coldstart, get_model
from recsql.operators import splits
from recsql.operators.evaluate import evaluate, evaluate_cold
from recsql.sources import tables as T

from .conftest import SF_SMALL

FAST = {"svd": dict(n_factors=10, n_epochs=2), "als": dict(n_factors=10, n_epochs=3),
        "hybrid": dict(cf_params=dict(n_factors=10, n_epochs=2))}


@pytest.fixture(scope="module")
def ds(spark):
    return T.dataset(spark, SF_SMALL)


@pytest.fixture(scope="module")
def split(ds):
    return splits.split_cold_users(ds.ratings, 0.2, 0.1, 11).cache()


@pytest.fixture(scope="module")
def fitted(split, ds):
    train = splits.fold(split, "train")
    return {name: mod.fit(train, ds.items, **FAST.get(name, {})) for name, mod in REGISTRY.items()}


def test_load_contract(ds):
    assert ds.ratings.count() > 0 and ds.items.count() > 0 and ds.users.count() > 0
    assert "imdb_genres" in ds.items.columns and "runtime" in ds.items.columns


def test_split_covers_all(ds):
    s = splits.split_by_time(ds.ratings)
    assert s.count() == ds.ratings.count()
    assert s.filter(F.col("fold") == "test").count() > 0


def test_all_models_recommend(split, fitted):
    users = splits.fold(split, "test").select("user_id").distinct().limit(5)
    for name, m in fitted.items():
        recs = REGISTRY[name].recommend(m, users, 10)
        assert recs.columns == ["user_id", "rank", "item_id", "score"], name
        assert recs.groupBy("user_id").count().filter("count > 10").count() == 0, name


def test_evaluator_keys(split, fitted, ds):
    train, test = splits.fold(split, "train"), splits.fold(split, "test")
    got = {r.metric for r in evaluate(REGISTRY["popularity"], fitted["popularity"], train, test, ds.items).collect()}
    assert {"rmse", "mae", "precision@10", "recall@10", "hitrate@10", "ndcg@10", "map@10", "coverage",
            "diversity", "novelty", "eval_users", "eval_empty_rec", "eval_user_coverage",
            "eval_rel_size_mean"} <= got


def test_cold_split_and_serve_rates(split, fitted):
    train, cold = splits.fold(split, "train"), splits.fold(split, "cold")
    assert cold.count() > 0 and train.join(cold, "user_id", "left_semi").count() == 0
    rate = {}
    for name in ("coldstart", "svd", "popularity", "hybrid", "content", "itemcf"):
        m = {r.metric: r.value for r in evaluate_cold(REGISTRY[name], fitted[name], cold).collect()}
        rate[name] = m["cold_serve_rate"]
    assert rate["coldstart"] > rate["svd"]
    assert rate["popularity"] == rate["hybrid"] == rate["coldstart"] == 1.0
    assert rate["svd"] == rate["content"] == rate["itemcf"] == 0.0


def test_questionnaire(spark, fitted):
    prefs = spark.createDataFrame([(1, "Action"), (1, "Comedy")], "profile_id long, genre string")
    recs = coldstart.recommend_for_preferences(fitted["coldstart"], prefs, k=8)
    assert 0 < recs.count() <= 8  # unknown genres -> popularity fallback, still <= k


def test_hybrid(split, fitted):
    users = splits.fold(split, "test").select("user_id").distinct().limit(3)
    recs = REGISTRY["hybrid"].recommend(fitted["hybrid"], users, 5)
    assert recs.groupBy("user_id").count().filter("count = 5").count() == users.count()


def test_als_rmse(split, fitted):
    test = splits.fold(split, "test")
    p = REGISTRY["als"].predict(fitted["als"], test)
    rmse = p.agg(F.sqrt(F.avg((F.col("rating") - F.col("prediction")) ** 2))).first()[0]
    assert rmse < 2.0


def test_unknown_model_rejected():
    with pytest.raises(ValueError):
        get_model("nope")
