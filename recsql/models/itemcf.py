"""M2-M4: item-based collaborative filtering (cosine, top-N neighbours)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.blocked import tiled_spmm
from ..plans.neighbors import cosine_lists, neighbor_sums, neighbor_topk
from ..plans.ranking import global_positions, score_order, topk, topk_unseen_from_ranking
from ..schemas import ITEM, RATING, USER
from ..session import materialize, stored
from .popularity import global_mean, last_ratings

EPS = 1e-9  # fixed value: norm guard of the reference cosine


@dataclass
class ItemCFModel:
    mu: DataFrame           # one row: mu
    neighbors: DataFrame    # item_id, neighbor_id, sim, nrank (sim > 0 only)
    train: DataFrame        # user_id, item_id, rating
    items: DataFrame        # train items: item_id, pos (by id)
    n_items: int
    n_users: int = 0


def similarities(train: DataFrame, n_users: int, n_items: int, n_ratings: int, longest: int = 0) -> DataFrame:
    """A29 + J7: cosine of rating columns, ``dot / ((|i|+eps)(|j|+eps))``, i != j;
    with ``longest``, only each item's first ``longest`` positive ones, with their ranks."""
    return cosine_lists(train, n_items, EPS, longest, ranked=True)


def positive_similarities(train: DataFrame, longest: int = 0, last: bool = False) -> tuple[DataFrame, int, int]:
    """Positive cosines with the user and item counts. With ``longest``, only
    each item's first ``longest`` neighbours are written (cut where they are
    summed); a parameter search writes the longest list it will ask for and
    reuses it for every smaller N. 0: all. ``last``: the history holds each pair once."""
    t = train if last else last_ratings(train)
    stats = t.agg(F.count_distinct(USER).alias("nu"), F.count_distinct(ITEM).alias("ni"),
                  F.count(F.lit(1)).alias("nr")).first()
    n_users, n_items, n_ratings = int(stats.nu), int(stats.ni), int(stats.nr)
    cut = longest if 0 < longest < n_items - 1 else 0
    sims = similarities(t, n_users, n_items, n_ratings, cut).filter(F.col("sim") > 0)
    return stored(sims), n_users, n_items


@dataclass
class History:
    """What models of one history share, whatever their neighbour counts."""
    mu: DataFrame           # one row: mu
    train: DataFrame        # user_id, item_id, rating: the last ones
    items: DataFrame        # item_id, pos (by id)


def history(train: DataFrame) -> History:
    t = stored(last_ratings(train))
    return History(materialize(global_mean(train)), t, global_positions(t.select(ITEM).distinct(), [F.col(ITEM).asc()]))


def fit(train: DataFrame, items: DataFrame | None = None, topk_neighbors: int = 50,
        sims: tuple[DataFrame, int, int] | None = None, base: History | None = None, **_params) -> ItemCFModel:
    base = history(train) if base is None else base
    sims, n_users, n_items = sims if sims is not None else positive_similarities(base.train, int(topk_neighbors), last=True)
    n = int(topk_neighbors)
    if not 0 < n < n_items - 1:
        nb = sims.drop("nrank").withColumn("nrank", F.lit(None).cast("int"))
    elif "nrank" in sims.columns:  # truncate each row independently (asymmetric); ranks came with the lists
        nb = sims.filter(F.col("nrank") <= n)
    else:
        nb = materialize(topk(sims, n, by=ITEM, order=score_order("sim", "neighbor_id"), rank_col="nrank"))
    return ItemCFModel(base.mu, nb, base.train, base.items, n_items, n_users)


def predict(m: ItemCFModel, pairs: DataFrame) -> DataFrame:
    """M3: sum(s*r) / (sum(s) + eps) over the user's rated neighbours, else mu."""
    p = pairs.select(USER, ITEM).distinct()
    contrib = neighbor_sums(p, m.train, m.neighbors)
    out = pairs.join(contrib, [USER, ITEM], "left").crossJoin(F.broadcast(m.mu))  # one-row side
    pred = F.when(F.col("_den").isNotNull(), F.col("_num") / (F.col("_den") + F.lit(EPS))).otherwise(F.col("mu"))
    return out.withColumn("prediction", pred).drop("_num", "_den", "mu")


def _factors(m: ItemCFModel, users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ratings (row, mid, lv) and neighbour lists (mid, col, rv) whose product are the scores."""
    r = m.train.join(users.select(USER).distinct(), USER, "left_semi")
    return (r.select(F.col(USER).alias("row"), F.col(ITEM).alias("mid"), F.col(RATING).cast("double").alias("lv")),
            m.neighbors.select(F.col("neighbor_id").alias("mid"), F.col(ITEM).alias("col"), F.col("sim").alias("rv")))


def scores(m: ItemCFModel, users: DataFrame) -> DataFrame:
    """M4 scores: ``sum_j sim[i, j] * r_uj`` for every item with a rated
    neighbour, as a tiled sparse product of ratings and neighbour lists (no
    row-level join on the rated item, whose raters and reverse neighbours can
    both be unbounded)."""
    left, right = _factors(m, users)
    out = tiled_spmm(left, right, m.n_users, m.n_items)
    return out.select(F.col("row").alias(USER), F.col("col").alias(ITEM), F.col("value").alias("score"))


def recommend(m: ItemCFModel, users: DataFrame, k: int = 10) -> DataFrame:
    """Top-k unseen train items by score; unknown users get nothing; users with
    fewer than k positive scores are filled with zero-score items by item_id."""
    known = users.select(USER).distinct().join(m.train.select(USER).distinct(), USER, "left_semi")
    seen = m.train.select(USER, ITEM)
    left, right = _factors(m, known)
    found = neighbor_topk(left, right, k, m.n_users, left.count(), right.count())
    found = stored(found)  # <= k rows per user, used three times
    short = stored(known.join(found.groupBy(USER).agg(F.count(F.lit(1)).alias("_np")), USER, "left")
                   .filter(F.coalesce(F.col("_np"), F.lit(0)) < k).select(USER))
    if short.isEmpty():
        return found.select(USER, F.col("rank").cast("int"), ITEM, "score")
    pos = found.drop("rank")
    fill_seen = seen.join(short, USER, "left_semi").unionByName(pos.select(USER, ITEM).join(short, USER, "left_semi"))
    ranked = m.items.withColumn("score", F.lit(0.0))
    fill = topk_unseen_from_ranking(ranked, short, fill_seen, k, n_ranked=m.n_items)
    both = pos.select(USER, ITEM, "score").unionByName(fill.select(USER, ITEM, "score"))
    return topk(both, k).select(USER, F.col("rank").cast("int"), ITEM, "score")
