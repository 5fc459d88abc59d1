"""Registered queries: content model, cold-start routing, questionnaire."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..models import coldstart, content
from ..operators import evaluate as EV
from ..operators.catalog import user_top_genres
from . import oracle_base as B
from .queries_models import POP_RECS, RECS_OUT, K, _recs_out
from .registry import _round_doubles, query

CBASE = B.with_(B.SPLIT, B.ITEMS, B.POP, B.CONTENT)


@query("m9_content_item_vectors", CBASE + """
SELECT item_id, term, round(weight, 6) AS weight FROM ivec_""")
def m9_content_item_vectors(c):
    return _round_doubles(c.model("content").item_vecs.select("item_id", "term", "weight"))


@query("m9_content_profiles", CBASE + """
SELECT user_id, term, round(weight, 6) AS weight FROM prof_""")
def m9_content_profiles(c):
    return _round_doubles(c.model("content").profiles.select("user_id", "term", "weight"))


@query("m10_content_predict", CBASE + B.CONTENT_PREDS + """
SELECT user_id, item_id, CAST(rating AS BIGINT) AS rating, round(prediction, 6) AS prediction FROM content_preds_""")
def m10_content_predict(c):
    out = content.predict(c.model("content"), c.test.select("user_id", "item_id", F.col("rating").cast("bigint")))
    return _round_doubles(out)


@query("m10_content_recommend", CBASE + ",\nall_users_ AS (SELECT DISTINCT user_id FROM ratings)"
       + B.content_recs("all_users_") + "\n" + RECS_OUT + " FROM content_recs")
def m10_content_recommend(c):
    return _recs_out(c.recs("content").filter(F.col("rank") <= K))


@query("e1_evaluate_content", CBASE + ",\nrelu_ AS (SELECT DISTINCT user_id FROM test WHERE rating >= 4)"
       + B.content_recs("relu_") + B.CONTENT_PREDS + B.eval_ctes("content_preds_", "content_recs")
       + "\nSELECT metric, round(CAST(value AS DOUBLE), 6) AS value FROM metrics_")
def e1_evaluate_content(c):
    return _round_doubles(EV.evaluate(content, c.model("content"), c.train, c.test, c.items, K,
                                      recs=c.recs("content")))


@query("m12_coldstart_recommend", CBASE + POP_RECS + B.content_recs("all_users_") + """,
routed_ AS (SELECT user_id, rank, item_id, score FROM content_recs
  UNION ALL SELECT user_id, rank, item_id, score FROM pop_recs
  WHERE user_id NOT IN (SELECT user_id FROM content_recs))
""" + RECS_OUT + " FROM routed_")
def m12_coldstart_recommend(c):
    return _recs_out(c.recs("coldstart").filter(F.col("rank") <= K))


@query("e7_cold_eval_coldstart", CBASE + POP_RECS + B.content_recs("all_users_") + """,
routed_ AS (SELECT user_id, rank, item_id, score FROM content_recs
  UNION ALL SELECT user_id, rank, item_id, score FROM pop_recs WHERE user_id NOT IN (SELECT user_id FROM content_recs))"""
       + B.cold_eval_ctes("routed_") + "\nSELECT metric, round(CAST(value AS DOUBLE), 6) AS value FROM cmetrics_")
def e7_cold_eval_coldstart(c):
    return _round_doubles(EV.evaluate_cold(coldstart, c.model("coldstart"), c.cold, K, recs=c.recs("coldstart")))


TOP_GENRES = """,
ug_ AS (SELECT t.user_id, g AS genre, count(*) AS n FROM train t JOIN
          (SELECT item_id, unnest(list_filter(list_transform(string_split(coalesce(genres, ''), '|'), lambda x: trim(x)),
                                  lambda x: x <> '')) AS g FROM items) ig ON t.item_id = ig.item_id GROUP BY 1, 2),
top_genres_ AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, genre) AS grank FROM ug_)
                WHERE grank <= 2)"""


@query("m13_preferences_recommend", CBASE + TOP_GENRES + """,
ptok_ AS (SELECT user_id AS profile_id, unnest(regexp_extract_all(lower(genre), '[a-z0-9]+')) AS term FROM top_genres_),
pv_ AS (SELECT profile_id, term, sum(idf) AS a FROM ptok_ JOIN idf_ USING (term) GROUP BY 1, 2),
pn_ AS (SELECT profile_id, term, a / sqrt(sum(a * a) OVER (PARTITION BY profile_id)) AS weight FROM pv_),
ps_ AS (SELECT p.profile_id, v.item_id, sum(p.weight * v.weight) AS score FROM pn_ p JOIN ivec_ v USING (term) GROUP BY 1, 2),
pc_ AS (SELECT u.profile_id, d.item_id, coalesce(s.score, 0) AS score FROM (SELECT DISTINCT profile_id FROM pn_) u
        CROSS JOIN docs_ d LEFT JOIN ps_ s ON s.profile_id = u.profile_id AND s.item_id = d.item_id),
pr_ AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY profile_id ORDER BY round(score, 9) DESC, item_id) AS rank
        FROM pc_) WHERE rank <= 10)
SELECT profile_id, CAST(rank AS BIGINT) AS rank, item_id, round(score, 6) AS score FROM pr_""")
def m13_preferences_recommend(c):
    prefs = user_top_genres(c.train, c.items, n=2).select(F.col("user_id").alias("profile_id"), "genre")
    out = coldstart.recommend_for_preferences(c.model("coldstart"), prefs, K)
    return _round_doubles(out.select("profile_id", F.col("rank").cast("bigint"), "item_id", "score"))


@query("m10_content_recommend_repeats", B.with_(B.RATINGS_RAW, """,
train AS (SELECT user_id, item_id, rating FROM ratings_raw)""", "," + B.ITEMS, B.CONTENT)
       + ",\nall_users_ AS (SELECT DISTINCT user_id FROM ratings_raw)" + B.content_recs("all_users_") + "\n" + RECS_OUT
       + " FROM content_recs")
def m10_content_recommend_repeats(c):
    """On a history with repeated rows, and with repeated catalogue rows."""
    m = content.fit(c.ratings_raw, c.items.unionByName(c.items))
    return _recs_out(content.recommend(m, c.ratings_raw.select("user_id").distinct(), K))
