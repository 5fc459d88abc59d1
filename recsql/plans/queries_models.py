"""Registered queries: models, recommendation lists, predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..models import popularity
from . import oracle_base as B
from .registry import _round_doubles, query

K = 10

RECS_OUT = """SELECT user_id, CAST(rank AS BIGINT) AS rank, item_id, round(score, 6) AS score"""


def _recs_out(df):
    return _round_doubles(df.select("user_id", F.col("rank").cast("bigint"), "item_id", "score"))


POP_RECS = """,
all_users_ AS (SELECT DISTINCT user_id FROM ratings),
pop_cand_ AS (SELECT u.user_id, p.item_id, p.score FROM all_users_ u CROSS JOIN pop p
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = p.item_id)),
pop_recs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank
  FROM pop_cand_) WHERE rank <= 10)"""


@query("a9_popularity_scores", B.with_(B.SPLIT, B.POP) + """
SELECT item_id, n, round(mean, 6) AS mean, round(score, 6) AS score FROM pop""")
def a9_popularity_scores(c):
    return _round_doubles(c.model("popularity").scores)


@query("m1_popularity_recommend", B.with_(B.SPLIT, B.POP, POP_RECS) + "\n" + RECS_OUT + " FROM pop_recs")
def m1_popularity_recommend(c):
    return _recs_out(c.recs("popularity").filter(F.col("rank") <= K))


@query("m1_popularity_predict", B.with_(B.SPLIT, B.POP) + """
SELECT t.user_id, t.item_id, CAST(t.rating AS BIGINT) AS rating, round(coalesce(p.score, mu.mu), 6) AS prediction
FROM test t LEFT JOIN pop p ON t.item_id = p.item_id CROSS JOIN mu""")
def m1_popularity_predict(c):
    m = c.model("popularity")
    out = popularity.predict(m, c.test.select("user_id", "item_id", F.col("rating").cast("bigint")))
    return _round_doubles(out)


from ..operators import evaluate as EV  # noqa: E402
from ..operators import metrics as M  # noqa: E402

POP_PREDS = """,
pop_preds_ AS (SELECT t.user_id, t.item_id, t.rating, coalesce(p.score, mu.mu) AS prediction
               FROM test t LEFT JOIN pop p ON t.item_id = p.item_id CROSS JOIN mu)"""


@query("e1_evaluate_popularity", B.with_(B.SPLIT, B.ITEMS, B.POP, POP_RECS, POP_PREDS)
       + B.eval_ctes("pop_preds_", "pop_recs") + "\nSELECT metric, round(CAST(value AS DOUBLE), 6) AS value FROM metrics_")
def e1_evaluate_popularity(c):
    return _round_doubles(EV.evaluate(popularity, c.model("popularity"), c.train, c.test, c.items, K,
                                      recs=c.recs("popularity")))


@query("e7_cold_eval_popularity", B.with_(B.SPLIT, B.ITEMS, B.POP, POP_RECS)
       + B.cold_eval_ctes("pop_recs") + "\nSELECT metric, round(CAST(value AS DOUBLE), 6) AS value FROM cmetrics_")
def e7_cold_eval_popularity(c):
    return _round_doubles(EV.evaluate_cold(popularity, c.model("popularity"), c.cold, K, recs=c.recs("popularity")))


@query("e2_ranking_per_user_popularity", B.with_(B.SPLIT, B.ITEMS, B.POP, POP_RECS)
       + B.ranking_ctes("pop_recs", "test") + """
SELECT user_id, n_rel, CAST(hits AS BIGINT) AS hits, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(hitrate, 6) AS hitrate, round(ndcg, 6) AS ndcg, round(map, 6) AS map FROM pm_""")
def e2_ranking_per_user_popularity(c):
    rel = M.relevant_items(c.test)
    recs = c.recs("popularity").filter(F.col("rank") <= K)
    return _round_doubles(M.ranking_per_user(recs, rel, K))
