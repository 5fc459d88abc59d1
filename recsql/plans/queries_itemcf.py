"""Registered queries: item-based CF."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..models import itemcf
from ..operators import evaluate as EV
from . import oracle_base as B
from .queries_models import RECS_OUT, K, _recs_out
from .registry import _round_doubles, query

IBASE = B.with_(B.SPLIT, B.ITEMS, B.itemcf(50))


@query("m2_itemcf_neighbors", IBASE + """
SELECT i AS item_id, j AS neighbor_id, round(sim, 6) AS sim, CAST(nrank AS BIGINT) AS nrank FROM nbr_""")
def m2_itemcf_neighbors(c):
    nb = c.model("itemcf", topk_neighbors=50).neighbors
    return _round_doubles(nb.select("item_id", "neighbor_id", "sim", F.col("nrank").cast("bigint")))


@query("m3_itemcf_predict", IBASE + B.ITEMCF_PREDS + """
SELECT user_id, item_id, CAST(rating AS BIGINT) AS rating, round(prediction, 6) AS prediction FROM icf_preds_""")
def m3_itemcf_predict(c):
    m = c.model("itemcf", topk_neighbors=50)
    return _round_doubles(itemcf.predict(m, c.test.select("user_id", "item_id", F.col("rating").cast("bigint"))))


@query("m4_itemcf_recommend", IBASE + ",\nall_users_ AS (SELECT DISTINCT user_id FROM ratings)"
       + B.itemcf_recs("all_users_") + "\n" + RECS_OUT + " FROM icf_recs")
def m4_itemcf_recommend(c):
    return _recs_out(c.recs("itemcf", topk_neighbors=50).filter(F.col("rank") <= K))


@query("e1_evaluate_itemcf", IBASE + ",\nrelu_ AS (SELECT DISTINCT user_id FROM test WHERE rating >= 4)"
       + B.itemcf_recs("relu_") + B.ITEMCF_PREDS + B.eval_ctes("icf_preds_", "icf_recs")
       + "\nSELECT metric, round(CAST(value AS DOUBLE), 6) AS value FROM metrics_")
def e1_evaluate_itemcf(c):
    return _round_doubles(EV.evaluate(itemcf, c.model("itemcf", topk_neighbors=50), c.train, c.test, c.items, K,
                                      recs=c.recs("itemcf", topk_neighbors=50)))


# A history with repeated (user, item) rows: the given tables have them.
REPEATS = B.with_(B.RATINGS_RAW) + """,
train AS (SELECT user_id, item_id, rating FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id
  ORDER BY "timestamp" DESC, rating DESC) AS rn_ FROM ratings_raw) WHERE rn_ = 1)""" + B.itemcf(50)


@query("m2_itemcf_neighbors_repeats", REPEATS + """
SELECT i AS item_id, j AS neighbor_id, round(sim, 6) AS sim, CAST(nrank AS BIGINT) AS nrank FROM nbr_""")
def m2_itemcf_neighbors_repeats(c):
    nb = itemcf.fit(c.ratings_raw, c.items, topk_neighbors=50).neighbors
    return _round_doubles(nb.select("item_id", "neighbor_id", "sim", F.col("nrank").cast("bigint")))
