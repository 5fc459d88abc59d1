"""Registered queries: experiment comparison/search and catalogue read queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..models import popularity
from ..operators import catalog as C
from ..operators import experiments as X
from ..operators import evaluate as EV
from ..operators.catalog import tags
from . import oracle_base as B
from .queries_content import CBASE, TOP_GENRES
from .queries_models import POP_RECS, POP_PREDS, K
from .registry import _round_doubles, query

BASE = B.with_(B.SPLIT, B.ITEMS, B.POP, POP_RECS)

NAME = "CASE WHEN regexp_matches({t}, '^(.*)\\s*\\((\\d{{4}})\\)$') THEN trim(regexp_extract({t}, '^(.*)\\s*\\((\\d{{4}})\\)$', 1)) ELSE {t} END"
YEAR = "CASE WHEN regexp_matches({t}, '^(.*)\\s*\\((\\d{{4}})\\)$') THEN CAST(TRY_CAST(regexp_extract({t}, '^(.*)\\s*\\((\\d{{4}})\\)$', 2) AS INTEGER) AS BIGINT) END"
TAGS = ("array_to_string(list_slice(list_filter(list_transform(string_split(replace({g}, '|', ','), ','), "
        "lambda x: trim(x)), lambda x: x <> ''), 1, 4), ', ')")


@query("e16_compare_popularity_vs_content",
       CBASE + POP_RECS + POP_PREDS + ",\nrelu_ AS (SELECT DISTINCT user_id FROM test WHERE rating >= 4)"
       + B.content_recs("relu_") + B.CONTENT_PREDS
       + B.eval_ctes("pop_preds_", "pop_recs", 10, "a_") + B.eval_ctes("content_preds_", "content_recs", 10, "b_") + """,
j_ AS (SELECT coalesce(a.metric, b.metric) AS metric, round(CAST(a.value AS DOUBLE), 6) AS baseline,
              round(CAST(b.value AS DOUBLE), 6) AS target FROM a_metrics_ a FULL OUTER JOIN b_metrics_ b ON a.metric = b.metric),
k_ AS (SELECT *, baseline IS NOT NULL AND target IS NOT NULL AND baseline <> 0 AS ok_, target - baseline AS d_,
              CASE WHEN split_part(metric, '@', 1) IN ('rmse', 'mae') THEN -1 ELSE 1 END AS dir_ FROM j_)
SELECT metric, baseline, target, CASE WHEN ok_ THEN round(d_, 5) END AS delta,
       CASE WHEN ok_ THEN round(d_ / abs(baseline) * 100, 2) END AS delta_pct,
       CASE WHEN NOT ok_ THEN '—'
            WHEN metric IN ('eval_users', 'eval_empty_rec', 'eval_user_coverage', 'eval_rel_size_mean',
                            'cold_users', 'cold_eval_users', 'cold_empty_rec') THEN '(diagnostic)'
            WHEN dir_ * d_ > 0 THEN '↑ better' WHEN d_ = 0 THEN '→ tie' ELSE '↓ worse' END AS judgment FROM k_""")
def e16_compare_popularity_vs_content(c):
    from ..models import content
    a = _round_doubles(EV.evaluate(popularity, c.model("popularity"), c.train, c.test, c.items, K))
    b = _round_doubles(EV.evaluate(content, c.model("content"), c.train, c.test, c.items, K))
    return _round_doubles(X.compare_runs(a, b))


NEIGHBOR_GRID = {"topk_neighbors": [10, 20, 40, 80, 160]}


@query("e20_grid_itemcf_neighbors")
def e20_grid_itemcf_neighbors(c):
    cfg = {"model": {"name": "itemcf"}, "eval": {"k": K, "relevance_threshold": 4.0}}
    return _round_doubles(X.run_grid(c, cfg, NEIGHBOR_GRID, optimize="rmse"))


# The settings of the reference's pipeline, all seven models.
SVD_TUNED = dict(n_factors=50, n_epochs=20, lr=0.005, reg=0.02, seed=42)
TUNED = {"itemcf": dict(topk_neighbors=120), "svd": SVD_TUNED, "als": dict(n_factors=50, reg=0.1, n_epochs=15, seed=42),
         "hybrid": dict(alpha=0.75, cf_params=SVD_TUNED, content_params=dict(like_threshold=4.0))}
PIPELINE_MODELS = ("popularity", "itemcf", "svd", "als", "content", "hybrid", "coldstart")


def _pipeline(c):
    """The multi-model metric table, written once per session and shared."""
    key = ("pipeline", PIPELINE_MODELS)
    if key not in c.models:
        from ..session import materialize
        c.models[key] = materialize(X.run_pipeline(c, list(PIPELINE_MODELS), TUNED))
    return c.models[key]


@query("e24_pipeline_metrics")
def e24_pipeline_metrics(c):
    return _round_doubles(_pipeline(c))


@query("w15_summary_table")
def w15_summary_table(c):
    long = _pipeline(c)
    res = {n: long.filter(F.col("model") == n).select("metric", "value") for n in PIPELINE_MODELS}
    return _round_doubles(X.summary_table(res, ["rmse", "mae", f"recall@{K}", f"ndcg@{K}", "coverage",
                                                "diversity", "novelty", "cold_serve_rate"]))


@query("c1_recommendation_cards_popularity", BASE + """,
cards_ AS (SELECT r.user_id, r.rank, r.item_id, coalesce(i.title, CAST(r.item_id AS VARCHAR)) AS t,
                  coalesce(i.genres, '') AS g, coalesce(p.score, mu.mu) AS prediction
           FROM pop_recs r LEFT JOIN items i ON r.item_id = i.item_id LEFT JOIN pop p ON r.item_id = p.item_id CROSS JOIN mu)
SELECT user_id, CAST(rank AS BIGINT) AS rank, item_id, """ + NAME.format(t="t") + " AS name, " + YEAR.format(t="t")
       + " AS year, " + TAGS.format(g="g") + """ AS tags, round(prediction, 6) AS prediction,
       round(prediction / 5 * 100, 6) AS score_pct FROM cards_""")
def c1_recommendation_cards_popularity(c):
    m = c.model("popularity")
    recs = c.recs("popularity").filter(F.col("rank") <= K)
    preds = popularity.predict(m, recs.select("user_id", "item_id"))
    out = C.recommendation_cards(recs, preds, c.items)
    return _round_doubles(out.select("user_id", F.col("rank").cast("bigint"), "item_id", "name",
                                     F.col("year").cast("bigint"), F.array_join("tags", ", ").alias("tags"),
                                     "prediction", "score_pct"))


@query("c2_user_cards", CBASE + TOP_GENRES + ",\n" + B.USERS.strip() + """,
st_ AS (SELECT user_id, count(*) AS n, avg(CAST(rating AS DOUBLE)) AS m FROM train GROUP BY 1),
bt_ AS (SELECT f.user_id, coalesce(i.title, CAST(f.item_id AS VARCHAR)) AS t FROM (SELECT user_id, item_id, row_number() OVER
        (PARTITION BY user_id ORDER BY rating DESC, item_id) AS r FROM train) f LEFT JOIN items i ON f.item_id = i.item_id WHERE f.r = 1),
b_ AS (SELECT user_id, """ + NAME.format(t="t") + """ AS name FROM bt_)
SELECT u.user_id, CASE u.gender WHEN 'M' THEN '♂ M' WHEN 'F' THEN '♀ F' ELSE '' END AS gender_label,
       CASE u.age WHEN 1 THEN '<18' WHEN 18 THEN '18–24' WHEN 25 THEN '25–34' WHEN 35 THEN '35–44' WHEN 45 THEN '45–49'
                  WHEN 50 THEN '50–55' WHEN 56 THEN '56+' ELSE '' END AS age_label,
       coalesce(st_.n, 0) AS n_ratings, round(st_.m, 6) AS mean_rating, coalesce(tg.genre, '—') AS top_genre,
       coalesce(b_.name, '—') AS favourite_title
FROM users u LEFT JOIN st_ ON u.user_id = st_.user_id LEFT JOIN (SELECT * FROM top_genres_ WHERE grank = 1) tg
     ON u.user_id = tg.user_id LEFT JOIN b_ ON u.user_id = b_.user_id""")
def c2_user_cards(c):
    return _round_doubles(C.user_cards(c.train, c.users, c.items))


@query("c3_favourite_items", BASE + """,
fav_ AS (SELECT * FROM (SELECT user_id, item_id, rating, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rank
         FROM train) WHERE rank <= 8),
fl_ AS (SELECT f.*, coalesce(i.title, CAST(f.item_id AS VARCHAR)) AS t, coalesce(i.genres, '') AS genres
        FROM fav_ f LEFT JOIN items i ON f.item_id = i.item_id)
SELECT user_id, CAST(rank AS BIGINT) AS rank, item_id, """ + NAME.format(t="t") + " AS name, " + YEAR.format(t="t")
       + """ AS year, CAST(rating AS BIGINT) AS rating, genres FROM fl_""")
def c3_favourite_items(c):
    out = C.favourite_items(c.train, c.items, 8)
    return out.select("user_id", F.col("rank").cast("bigint"), "item_id", "name", F.col("year").cast("bigint"),
                      F.col("rating").cast("bigint"), "genres")


DISC = """,
dpop_ AS (SELECT item_id, count(*) AS n_ratings, avg(CAST(rating AS DOUBLE)) AS m FROM ratings GROUP BY 1),
disc_ AS (SELECT i.item_id, i.title, i.genres, i.release_year, coalesce(d.n_ratings, 0) AS n_ratings,
                 coalesce(round(d.m, 1), 0) AS mean_rating FROM items i LEFT JOIN dpop_ d ON i.item_id = d.item_id)"""


@query("c4_discover_popular", BASE + DISC + """
SELECT item_id, title, genres, CAST(release_year AS BIGINT) AS release_year, n_ratings, mean_rating FROM disc_
ORDER BY n_ratings DESC, item_id LIMIT 40""")
def c4_discover_popular(c):
    page, _ = C.discover(c.items, c.ratings, sort="popular", page=0)
    return _round_doubles(page.withColumn("release_year", F.col("release_year").cast("bigint")))


@query("c4_discover_genre_mean_page2", BASE + DISC + """
SELECT item_id, title, genres, CAST(release_year AS BIGINT) AS release_year, n_ratings, mean_rating FROM disc_
WHERE list_contains(list_filter(list_transform(string_split(coalesce(genres, ''), '|'), lambda x: trim(x)), lambda x: x <> ''), 'ECONOMY')
  AND n_ratings >= 20
ORDER BY mean_rating DESC, item_id LIMIT 40 OFFSET 80""")
def c4_discover_genre_mean_page2(c):
    page, _ = C.discover(c.items, c.ratings, genre="ECONOMY", sort="mean", page=2)
    return _round_doubles(page.withColumn("release_year", F.col("release_year").cast("bigint")))


@query("c4_discover_totals", BASE + DISC + """,
f_ AS (SELECT * FROM disc_ WHERE lower(title) LIKE '%ring%')
SELECT count(*) AS n_total, CAST(GREATEST(1, FLOOR((count(*) - 1) / 40)) AS BIGINT) AS last_page FROM f_""")
def c4_discover_totals(c):
    _, totals = C.discover(c.items, c.ratings, keyword="ring", sort="newest")
    return totals


@query("a22_user_top_genre", CBASE + TOP_GENRES + """
SELECT user_id, genre, n FROM top_genres_ WHERE grank = 1""")
def a22_user_top_genre(c):
    return C.user_top_genres(c.train, c.items, 1).select("user_id", "genre", F.col("n").cast("bigint"))


@query("c6_explain_popularity", CBASE + POP_RECS + """,
ugc_ AS (SELECT t.user_id, g AS genre, count(*) AS n FROM train t JOIN
          (SELECT item_id, unnest(list_filter(list_transform(string_split(coalesce(genres, ''), '|'), lambda x: trim(x)),
                                  lambda x: x <> '')) AS g FROM items) ig ON t.item_id = ig.item_id GROUP BY 1, 2),
rg_ AS (SELECT r.user_id, r.item_id, ig.g AS genre, u.n FROM pop_recs r
        JOIN (SELECT item_id, unnest(list_filter(list_transform(string_split(coalesce(genres, ''), '|'), lambda x: trim(x)),
                                     lambda x: x <> '')) AS g FROM items) ig ON r.item_id = ig.item_id
        JOIN ugc_ u ON u.user_id = r.user_id AND u.genre = ig.g),
best_ AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY n DESC, genre) AS r_ FROM rg_)
          WHERE r_ = 1)
SELECT r.user_id, CAST(r.rank AS BIGINT) AS rank, r.item_id,
       CASE WHEN b.genre IS NOT NULL THEN 'your favourite genre: ' || b.genre ELSE 'based on your overall taste' END AS reason
FROM pop_recs r LEFT JOIN best_ b ON r.user_id = b.user_id AND r.item_id = b.item_id""")
def c6_explain_popularity(c):
    recs = c.recs("popularity").filter(F.col("rank") <= K)
    return C.explain(recs, c.train, c.items).withColumn("rank", F.col("rank").cast("bigint"))


@query("c5_onboarding_top_genres", CBASE + TOP_GENRES + """,
ptok_ AS (SELECT user_id AS profile_id, unnest(regexp_extract_all(lower(genre), '[a-z0-9]+')) AS term FROM top_genres_),
pv_ AS (SELECT profile_id, term, sum(idf) AS a FROM ptok_ JOIN idf_ USING (term) GROUP BY 1, 2),
pn_ AS (SELECT profile_id, term, a / sqrt(sum(a * a) OVER (PARTITION BY profile_id)) AS weight FROM pv_),
ps_ AS (SELECT p.profile_id, v.item_id, sum(p.weight * v.weight) AS score FROM pn_ p JOIN ivec_ v USING (term) GROUP BY 1, 2),
pc_ AS (SELECT u.profile_id, d.item_id, coalesce(s.score, 0) AS score FROM (SELECT DISTINCT profile_id FROM pn_) u
        CROSS JOIN docs_ d LEFT JOIN ps_ s ON s.profile_id = u.profile_id AND s.item_id = d.item_id),
pr_ AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY profile_id ORDER BY round(score, 9) DESC, item_id) AS rank
        FROM pc_) WHERE rank <= 10),
pl_ AS (SELECT p.*, coalesce(i.title, CAST(p.item_id AS VARCHAR)) AS t, coalesce(i.genres, '') AS genres
        FROM pr_ p LEFT JOIN items i ON p.item_id = i.item_id)
SELECT profile_id, CAST(rank AS BIGINT) AS rank, item_id, """ + NAME.format(t="t") + " AS name, " + YEAR.format(t="t")
       + """ AS year, genres, round(score, 6) AS score FROM pl_""")
def c5_onboarding_top_genres(c):
    prefs = C.user_top_genres(c.train, c.items, n=2).select(F.col("user_id").alias("profile_id"), "genre")
    out = C.onboarding(c.model("coldstart"), prefs, c.items, K)
    return _round_doubles(out.select("profile_id", F.col("rank").cast("bigint"), "item_id", "name",
                                     F.col("year").cast("bigint"), "genres", "score"))


@query("e23_grid_search_itemcf_neighbors")
def e23_grid_search_itemcf_neighbors(c):
    """Coarse grid, best point, refined grid around it, second pass."""
    cfg = {"model": {"name": "itemcf"}, "eval": {"k": K, "relevance_threshold": 4.0}}
    coarse, fine, best = X.grid_search(c, cfg, NEIGHBOR_GRID, optimize="rmse", n_between=1)
    out = coarse.withColumn("pass", F.lit("coarse")).unionByName(fine.withColumn("pass", F.lit("refined")))
    return _round_doubles(out.withColumn("best_topk_neighbors", F.lit(int(best["topk_neighbors"])).cast("bigint")))
