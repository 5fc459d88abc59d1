"""M1: Bayesian-smoothed popularity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ranking import global_positions, score_order, topk_unseen_from_ranking
from ..schemas import ITEM, RATING, TS, USER
from ..session import materialize

SMOOTHING = 5.0  # fixed value: prior weight C of the smoothed mean


@dataclass
class PopularityModel:
    mu: DataFrame          # one row: mu
    scores: DataFrame      # item_id, n, mean, score
    ranked: DataFrame      # item_id, score, pos (global order)
    seen: DataFrame        # user_id, item_id
    n_items: int


def global_mean(train: DataFrame) -> DataFrame:
    """A10: one-row mean rating."""
    return train.agg(F.avg(F.col(RATING).cast("double")).alias("mu"))


def seen_pairs(train: DataFrame) -> DataFrame:
    """The distinct (user, item) pairs of a history that may repeat them."""
    return train.select(USER, ITEM).distinct()


def last_ratings(train: DataFrame) -> DataFrame:
    """One rating per (user, item): the latest, where a time is known, and the
    highest of several at once. Combined before the shuffle."""
    order = [c for c in (TS, RATING) if c in train.columns]
    return (train.groupBy(USER, ITEM).agg(F.max(F.struct(*order)).alias("_last"))
            .select(USER, ITEM, F.col(f"_last.{RATING}").alias(RATING)))


def item_scores(train: DataFrame) -> DataFrame:
    """score = (n*mean + C*mu) / (n + C)."""
    stats = train.groupBy(ITEM).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(RATING).cast("double")).alias("mean"))
    return (stats.crossJoin(F.broadcast(global_mean(train)))  # one-row side
            .select(ITEM, F.col("n").cast("bigint"), "mean",
                    ((F.col("n") * F.col("mean") + F.lit(SMOOTHING) * F.col("mu"))
                     / (F.col("n") + F.lit(SMOOTHING))).alias("score")))


def fit(train: DataFrame, items: DataFrame | None = None, **_params) -> PopularityModel:
    scores = materialize(item_scores(train))
    ranked = global_positions(scores.select(ITEM, "score"), score_order())
    n_items = ranked.count()
    return PopularityModel(materialize(global_mean(train)), scores, ranked,
                           seen_pairs(train), n_items)


def predict(m: PopularityModel, pairs: DataFrame) -> DataFrame:
    """Item score, else the global mean (not clipped)."""
    return (pairs.join(m.scores.select(ITEM, "score"), ITEM, "left")
            .crossJoin(F.broadcast(m.mu))  # one-row side
            .withColumn("prediction", F.coalesce(F.col("score"), F.col("mu"))).drop("score", "mu"))


def recommend(m: PopularityModel, users: DataFrame, k: int = 10) -> DataFrame:
    """Global ranking minus each user's seen items; unknown users get the global list."""
    return topk_unseen_from_ranking(m.ranked, users, m.seen, k, n_ranked=m.n_items)
