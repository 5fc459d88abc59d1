"""Registered queries: error analysis, strata, multi-K curves, significance."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..models import content, popularity
from ..operators import metrics as M
from ..operators import significance as SG
from ..operators import strata as ST
from . import oracle_base as B
from .queries_models import K, POP_PREDS, POP_RECS
from .registry import _round_doubles, query

BASE = B.with_(B.SPLIT, B.ITEMS, B.POP, POP_RECS, POP_PREDS)


def _pop(c):
    return c.model("popularity")


def _pop_preds(c):
    return popularity.predict(_pop(c), c.test.select("user_id", "item_id", "rating"))


def _pop_recs(c, users, k=K):
    return c.recs("popularity").filter(F.col("rank") <= k).join(users, "user_id", "left_semi")


def _rel_users(c):
    return M.relevant_items(c.test).select("user_id").distinct()


@query("a14_per_user_rmse_popularity", BASE + """
SELECT user_id, round(sqrt(avg((rating - prediction) * (rating - prediction))), 6) AS rmse FROM pop_preds_ GROUP BY 1""")
def a14_per_user_rmse_popularity(c):
    return _round_doubles(ST.per_user_rmse(_pop_preds(c)))


PUR = """,
nr_ AS (SELECT user_id, count(DISTINCT item_id) AS n_rel FROM test WHERE rating >= 4 GROUP BY 1),
ht_ AS (SELECT p.user_id, count(*) AS hits FROM pop_recs p JOIN (SELECT DISTINCT user_id, item_id FROM test WHERE rating >= 4) r
        ON p.user_id = r.user_id AND p.item_id = r.item_id GROUP BY 1),
pur_ AS (SELECT nr_.user_id, coalesce(hits, 0) / n_rel AS recall FROM nr_ LEFT JOIN ht_ ON nr_.user_id = ht_.user_id)"""


@query("a15_per_user_recall_popularity", BASE + PUR + "\nSELECT user_id, round(recall, 6) AS recall FROM pur_")
def a15_per_user_recall_popularity(c):
    return _round_doubles(ST.per_user_recall(_pop_recs(c, _rel_users(c)), c.test, K))


def _buckets(src: str, key: str, name: str) -> str:
    return f""",
{name}_c AS (SELECT {key}, count(*) AS n_ratings FROM {src} GROUP BY 1),
{name}_e AS (SELECT list_sort(list_distinct(quantile_cont(CAST(n_ratings AS DOUBLE), [0, 0.25, 0.5, 0.75, 1]))) AS e FROM {name}_c),
{name} AS (SELECT c.*, 1 + len(list_filter(e[2:], lambda x: x < n_ratings)) AS bucket FROM {name}_c c CROSS JOIN {name}_e)"""


@query("e8_user_activity_popularity", BASE + PUR + _buckets("train", "user_id", "actb_") + """,
err_ AS (SELECT bucket, round(sqrt(avg((rating - prediction) * (rating - prediction))), 4) AS rmse,
                round(avg(abs(rating - prediction)), 4) AS mae FROM pop_preds_ p JOIN actb_ a ON p.user_id = a.user_id GROUP BY 1),
rec_ AS (SELECT bucket, round(avg(recall), 4) AS r, count(*) AS eu FROM pur_ p JOIN actb_ a ON p.user_id = a.user_id GROUP BY 1),
base_ AS (SELECT bucket, count(*) AS n_users, round(avg(n_ratings), 1) AS mean_train_ratings FROM actb_ GROUP BY 1)
SELECT 'Q' || CAST(b.bucket AS VARCHAR) AS bucket, n_users, mean_train_ratings, rmse, mae, coalesce(r, 0) AS "recall@10",
       coalesce(eu, 0) AS eval_users
FROM base_ b LEFT JOIN err_ e ON b.bucket = e.bucket LEFT JOIN rec_ r ON b.bucket = r.bucket""")
def e8_user_activity_popularity(c):
    recs = _pop_recs(c, _rel_users(c))
    return _round_doubles(ST.by_user_activity(_pop_preds(c), recs, c.train, c.test, K))


@query("e9_item_popularity_popularity", BASE + _buckets("train", "item_id", "ipb_") + """,
trecs_ AS (SELECT * FROM pop_recs WHERE user_id IN (SELECT user_id FROM test)),
relb_ AS (SELECT DISTINCT t.user_id, t.item_id, b.bucket FROM test t JOIN ipb_ b ON t.item_id = b.item_id
          WHERE t.rating >= 4 AND t.user_id IN (SELECT user_id FROM trecs_)),
hit_ AS (SELECT DISTINCT r.bucket, r.user_id FROM relb_ r JOIN trecs_ p ON p.user_id = r.user_id AND p.item_id = r.item_id),
eu_ AS (SELECT bucket, count(DISTINCT user_id) AS eval_users FROM relb_ GROUP BY 1),
h_ AS (SELECT bucket, count(*) AS h FROM hit_ GROUP BY 1),
base_ AS (SELECT bucket, count(*) AS n_items, round(avg(n_ratings), 1) AS mean_ratings FROM ipb_ GROUP BY 1)
SELECT 'Q' || CAST(b.bucket AS VARCHAR) AS bucket, n_items, mean_ratings,
       CASE WHEN eval_users > 0 THEN round(coalesce(h, 0) / eval_users, 4) ELSE 0 END AS hit_rate,
       coalesce(eval_users, 0) AS eval_users
FROM base_ b LEFT JOIN eu_ e ON b.bucket = e.bucket LEFT JOIN h_ h ON b.bucket = h.bucket""")
def e9_item_popularity_popularity(c):
    recs = _pop_recs(c, c.test.select("user_id").distinct())
    return _round_doubles(ST.by_item_popularity(recs, c.train, c.test, K))


@query("a19_error_summary_popularity", BASE + """,
e_ AS (SELECT CAST(rating AS DOUBLE) AS t, prediction AS p, rating - prediction AS e FROM pop_preds_)
SELECT round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae, round(avg(e), 4) AS mean_error,
       round(avg(CASE WHEN p > t THEN 1.0 ELSE 0.0 END), 4) AS over_est_rate,
       round(avg(CASE WHEN p < t THEN 1.0 ELSE 0.0 END), 4) AS under_est_rate,
       round(avg(CASE WHEN abs(e) < 0.5 THEN 1.0 ELSE 0.0 END), 4) AS exact_rate FROM e_""")
def a19_error_summary_popularity(c):
    return _round_doubles(ST.error_summary(_pop_preds(c)))


@query("a20_error_by_rating_popularity", BASE + """
SELECT CAST(rating AS BIGINT) AS rating, count(*) AS count, round(avg(rating - prediction), 4) AS mean_error,
       round(avg(abs(rating - prediction)), 4) AS mae FROM pop_preds_ GROUP BY rating""")
def a20_error_by_rating_popularity(c):
    return _round_doubles(ST.error_by_rating(_pop_preds(c)))


@query("a21_error_histogram_popularity", BASE + """,
e_ AS (SELECT rating - prediction AS e FROM pop_preds_),
b_ AS (SELECT CASE WHEN max(e) > min(e) THEN min(e) ELSE min(e) - 0.5 END AS blo,
              CASE WHEN max(e) > min(e) THEN max(e) ELSE max(e) + 0.5 END AS bhi FROM e_),
h_ AS (SELECT CAST(LEAST(50, FLOOR((e - blo) * 50 / (bhi - blo)) + 1) AS BIGINT) AS bin, count(*) AS count
       FROM e_ CROSS JOIN b_ GROUP BY 1)
SELECT n_.bin, round(blo + (n_.bin - 1) * ((bhi - blo) / 50), 6) AS lo, round(blo + n_.bin * ((bhi - blo) / 50), 6) AS hi,
       coalesce(h_.count, 0) AS count
FROM (SELECT unnest(range(1, 51)) AS bin) n_ CROSS JOIN b_ LEFT JOIN h_ ON h_.bin = n_.bin""")
def a21_error_histogram_popularity(c):
    return _round_doubles(ST.error_histogram(_pop_preds(c)))


POP_RECS20 = POP_RECS.replace("all_users_", "all_users20_").replace("pop_recs", "pop_recs20").replace("pop_cand_", "pop_cand20_").replace("rank <= 10", "rank <= 20")


@query("e10_multik_popularity", BASE + POP_RECS20 + "".join(
        B.ranking_ctes("pop_recs20", "test", k, f"k{k}_") for k in (5, 10, 15, 20)) + "\n" + "\nUNION ALL\n".join(
        f"SELECT CAST({k} AS BIGINT) AS k, round(avg(recall), 5) AS recall, round(avg(ndcg), 5) AS ndcg, "
        f"round(avg(hitrate), 5) AS hitrate FROM k{k}_pm_" for k in (5, 10, 15, 20)))
def e10_multik_popularity(c):
    recs = _pop_recs(c, _rel_users(c), 20)
    return _round_doubles(M.multik(recs, M.relevant_items(c.test), (5, 10, 15, 20)))


def _vals(c):
    a = ST.per_user_rmse(_pop_preds(c)).withColumnRenamed("rmse", "value")
    cp = content.predict(c.model("content"), c.test.select("user_id", "item_id", "rating"))
    b = ST.per_user_rmse(cp).withColumnRenamed("rmse", "value")
    return a, b


VALS = B.CONTENT + B.CONTENT_PREDS + """,
va_ AS (SELECT user_id, sqrt(avg((rating - prediction) * (rating - prediction))) AS v FROM pop_preds_ GROUP BY 1),
vb_ AS (SELECT user_id, sqrt(avg((rating - prediction) * (rating - prediction))) AS v FROM content_preds_ GROUP BY 1),
pr_ AS (SELECT a.user_id, a.v AS a, b.v AS b FROM va_ a JOIN vb_ b ON a.user_id = b.user_id)"""


@query("e12_ttest_stats_popularity_vs_content", BASE + VALS + """,
s_ AS (SELECT count(*) AS n, avg(a - b) AS m, stddev_samp(a - b) AS sd FROM pr_)
SELECT n AS n_pairs, round(m, 6) AS mean_diff, round(sd, 6) AS std_diff, round(sd / sqrt(n), 6) AS se,
       round(CASE WHEN sd / sqrt(n) > 1e-9 THEN m / (sd / sqrt(n)) ELSE 0 END, 6) AS t_statistic, n - 1 AS dof FROM s_""")
def e12_ttest_stats_popularity_vs_content(c):
    return _round_doubles(SG.ttest_stats(*_vals(c)))


@query("e12_paired_ttest_popularity_vs_content")
def e12_paired_ttest_popularity_vs_content(c):
    return _round_doubles(SG.paired_ttest(*_vals(c)))


@query("e14_cohens_d_popularity_vs_content", BASE + VALS + """,
s_ AS (SELECT count(*) AS n, avg(a) AS ma, avg(b) AS mb, var_samp(a) AS va, var_samp(b) AS vb FROM pr_),
d_ AS (SELECT *, sqrt(((n - 1) * va + (n - 1) * vb) / (2 * n - 2)) AS sp FROM s_),
e_ AS (SELECT *, CASE WHEN sp > 1e-9 THEN abs(ma - mb) / sp ELSE 0 END AS d FROM d_)
SELECT n AS n_pairs, round(d, 4) AS cohens_d,
       CASE WHEN d < 0.2 THEN 'negligible' WHEN d < 0.5 THEN 'small' WHEN d < 0.8 THEN 'medium' ELSE 'large' END AS magnitude,
       round(ma - mb, 6) AS mean_diff FROM e_""")
def e14_cohens_d_popularity_vs_content(c):
    return _round_doubles(SG.cohens_d(*_vals(c)))


@query("e13_bootstrap_ci_popularity")
def e13_bootstrap_ci_popularity(c):
    return SG.bootstrap_ci(_vals(c)[0], n_bootstrap=10000)


@query("e15_compare_popularity_vs_content")
def e15_compare_popularity_vs_content(c):
    return _round_doubles(SG.compare_per_user(*_vals(c), n_bootstrap=10000))


@query("e11_multik_popularity_content", B.with_(B.SPLIT, B.ITEMS, B.POP, POP_RECS, B.CONTENT) + POP_RECS20
       + ",\nrelu_ AS (SELECT DISTINCT user_id FROM test WHERE rating >= 4)" + B.content_recs("relu_", "crecs20", 20)
       + "".join(B.ranking_ctes("pop_recs20", "test", k, f"p{k}_") + B.ranking_ctes("crecs20", "test", k, f"c{k}_")
                 for k in (5, 10, 15, 20)) + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{m}' AS model, CAST({k} AS BIGINT) AS k, round(avg(recall), 5) AS recall, round(avg(ndcg), 5) AS ndcg, "
        f"round(avg(hitrate), 5) AS hitrate FROM {p}{k}_pm_" for m, p in (("popularity", "p"), ("content", "c"))
        for k in (5, 10, 15, 20)))
def e11_multik_popularity_content(c):
    return _multik(c, {"popularity": {}, "content": {}})


# The reference's settings of its multi-K charts, all seven models.
SVD_CURVE = dict(n_factors=50, n_epochs=20, lr=0.005, reg=0.02, seed=42)
CURVES = {"popularity": {}, "itemcf": dict(topk_neighbors=120), "svd": SVD_CURVE, "als": dict(n_factors=50, reg=0.1, n_epochs=10),
          "content": {}, "hybrid": dict(alpha=0.75, cf_params=SVD_CURVE), "coldstart": {}}


def _multik(c, models):
    rel = M.relevant_items(c.test)
    users = rel.select("user_id").distinct()
    return _round_doubles(M.multik_models({
        name: M.multik(c.recs(name, **params).join(users, "user_id", "left_semi"), rel) for name, params in models.items()}))


@query("e11_multik_models")
def e11_multik_models(c):
    return _multik(c, CURVES)
