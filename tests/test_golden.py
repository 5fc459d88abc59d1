"""Hand-computed golden values (FIXTURES.md G1/G2)."""

import pytest
from pyspark.sql import functions as F

from recsql.models import content, itemcf, popularity
from recsql.operators import enrich, features, metrics, significance
from recsql.functions.text import norm_title


def _d(df, key, col):
    return {r[key]: r[col] for r in df.collect()}


def test_global_mean_and_item_stats(g1):
    r, _ = g1
    assert popularity.global_mean(r).first()["mu"] == pytest.approx(3.5)
    st = features.item_stats(r)
    got = {x.item_id: (x.item_rating_count, x.item_rating_mean, x.item_rating_std) for x in st.collect()}
    exp = {10: (3, 3.666667, 1.527525), 20: (3, 3.0, 1.0), 30: (2, 4.5, 0.707107), 40: (2, 3.0, 2.828427)}
    for k, v in exp.items():
        assert got[k] == pytest.approx(v, abs=1e-6)


def test_popularity_scores(g1):
    r, items = g1
    m = popularity.fit(r, items)
    got = _d(m.scores, "item_id", "score")
    exp = {10: 3.5625, 20: 3.3125, 30: 3.785714, 40: 3.357143}
    assert {k: round(v, 6) for k, v in got.items()} == pytest.approx(exp)
    recs = popularity.recommend(m, r.select("user_id").distinct(), 10)
    u4 = [x.item_id for x in recs.filter("user_id = 4").orderBy("rank").collect()]
    assert u4 == [30, 40, 20]  # item 10 seen; then by score


def test_itemcf_cosine_predict_recommend(g1):
    r, items = g1
    m = itemcf.fit(r, items, topk_neighbors=0)  # no truncation
    sims = {(x.item_id, x.neighbor_id): x.sim for x in m.neighbors.collect()}
    exp = {(10, 20): .636682, (10, 30): .465620, (10, 40): .584705, (20, 30): .928024, (20, 40): .509850, (30, 40): .153141}
    for (a, b), v in exp.items():
        assert sims[(a, b)] == pytest.approx(v, abs=1e-6)
        assert sims[(b, a)] == pytest.approx(v, abs=1e-6)
    pairs = r.sparkSession.createDataFrame([(1, 40, 0)], "user_id long, item_id long, rating int")
    assert itemcf.predict(m, pairs).first()["prediction"] == pytest.approx(4.059995, abs=1e-6)
    recs = itemcf.recommend(m, r.select("user_id").distinct(), 10)
    row = recs.filter("user_id = 1 AND item_id = 40").first()
    assert row["score"] == pytest.approx(5.065640, abs=1e-6) and row["rank"] == 1


def test_tfidf_and_profiles(g1):
    r, items = g1
    m = content.fit(r, items)
    idf = _d(m.idf, "term", "idf")
    for t in ("action", "comedy"):
        assert idf[t] == pytest.approx(1.693147, abs=1e-6)
    for t in ("drama", "fi", "romance", "sci"):
        assert idf[t] == pytest.approx(2.098612, abs=1e-6)
    v30 = {x.term: x.weight for x in m.item_vecs.filter("item_id = 30").collect()}
    assert v30 == pytest.approx({"action": .495524, "fi": .614189, "sci": .614189}, abs=1e-6)
    v40 = {x.term: x.weight for x in m.item_vecs.filter("item_id = 40").collect()}
    assert v40 == pytest.approx({"comedy": .627914, "romance": .778283}, abs=1e-6)
    pairs = items.select("item_id").crossJoin(r.select("user_id").distinct().filter("user_id in (1, 4)"))
    cos = {(x.user_id, x.item_id): x.cos for x in content.cosine(m, pairs).collect()}
    exp1 = {10: .863063, 20: 0, 30: .775482, 40: .299304, 50: 0}
    exp4 = {10: 1, 20: 0, 30: .350388, 40: .444002, 50: 0}
    for i, v in exp1.items():
        assert cos[(1, i)] == pytest.approx(v, abs=1e-6)
    for i, v in exp4.items():
        assert cos[(4, i)] == pytest.approx(v, abs=1e-6)


def test_preferences(g1):
    r, items = g1
    m = content.fit(r, items)
    prefs = r.sparkSession.createDataFrame([(7, "Action"), (7, "Sci-Fi")], "profile_id long, genre string")
    recs = content.recommend_for_preferences(m, prefs, k=5)
    got = {x.item_id: x.score for x in recs.collect()}
    assert got[10] == pytest.approx(.350388, abs=1e-6) and got[30] == pytest.approx(1.0, abs=1e-6)
    assert [x.item_id for x in recs.orderBy("rank").collect()][:2] == [30, 10]


def test_ranking_metrics(spark):
    recs = spark.createDataFrame([(1, i + 1, it) for i, it in enumerate([10, 20, 30, 40, 50])],
                                 "user_id long, rank int, item_id long")
    rel = spark.createDataFrame([(1, 20), (1, 50), (1, 99)], "user_id long, item_id long")
    row = metrics.ranking_per_user(recs, rel, 5).first()
    assert row.precision == pytest.approx(.4)
    assert row.recall == pytest.approx(.666667, abs=1e-6)
    assert row.hitrate == 1.0
    assert row.ndcg == pytest.approx(.477624, abs=1e-6)
    assert row.map == pytest.approx(.3)


def test_significance(spark):
    a = spark.createDataFrame(list(enumerate([.9, .8, 1.1, 1.0, .7])), "user_id long, value double")
    b = spark.createDataFrame(list(enumerate([1.0, 1.0, 1.0, 1.1, .9])), "user_id long, value double")
    t = significance.paired_ttest(a, b).first()
    assert t.t_statistic == pytest.approx(-1.8257, abs=1e-4)
    assert t.p_value == pytest.approx(.150417, abs=1e-6)
    assert t.mean_diff == pytest.approx(-0.1)
    assert (t.ci_lower, t.ci_upper) == pytest.approx((-.270009, .070009), abs=1e-5)
    d = significance.cohens_d(a, b).first()
    assert d.cohens_d == pytest.approx(.8165, abs=1e-4) and d.magnitude == "large"
    bs = significance.bootstrap_ci(a, n_bootstrap=500).first()
    assert bs.ci_lower <= bs.mean <= bs.ci_upper


def test_enrichment_fusion(spark):
    """The reference's only golden test."""
    items = spark.createDataFrame([(1, "A (1999)", "Action|Comedy"), (2, "B (2001)", "Drama"), (3, "C (2010)", "")],
                                  "item_id long, title string, genres string")
    cache = spark.createDataFrame([(1, "t1", "Action,Thriller", "120", "A"), (2, "t2", "Romance", "95", "B")],
                                  "item_id long, tconst string, imdb_genres string, runtime string, orig_title string")
    out = {x.item_id: x for x in enrich.enrich_items(items, cache).collect()}
    assert out[1].genres == "Action|Comedy|Thriller" and out[1].runtime == 120
    assert out[2].genres == "Drama|Romance" and out[2].runtime == 95
    assert out[3].imdb_genres == "" and out[3].runtime is None and out[3].genres == ""
    assert enrich.enrichment_coverage(cache).first().imdb_matched_items == 2
    assert [x.genres for x in items.orderBy("item_id").collect()] == ["Action|Comedy", "Drama", ""]
    none = enrich.enrich_items(items, None).orderBy("item_id").collect()
    assert [x.genres for x in none] == ["Action|Comedy", "Drama", ""] and none[0].imdb_genres == ""


def test_norm_title(spark):
    df = spark.createDataFrame([("Shawshank Redemption, The (1994)",), ("Amelie (Fabuleux destin, Le) (2001)",)], "t string")
    got = [x[0] for x in df.select(norm_title(F.col("t"))).collect()]
    assert got[0] == "the shawshank redemption"
