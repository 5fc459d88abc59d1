"""Rating, ranking and catalogue metrics.

Inputs are tables: ``preds`` (user_id, item_id, rating, prediction), ``recs``
(user_id, rank, item_id), ``relevant`` (user_id, item_id). Per-user lists are
at most k rows, so the per-user windows/arrays here are bounded by k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import genre_set_raw
from ..schemas import ITEM, RATING, USER


def rating_metrics(preds: DataFrame) -> DataFrame:
    """RMSE and MAE."""
    e = F.col(RATING).cast("double") - F.col("prediction")
    return preds.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"))


def relevant_items(test: DataFrame, threshold: float = 4.0) -> DataFrame:
    """Test items rated at or above the threshold."""
    return test.filter(F.col(RATING) >= threshold).select(USER, ITEM).distinct()


def _idcg(n: Column) -> Column:
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0.0), lambda acc, i: acc + 1.0 / F.log2(i + 1))


def ranking_per_user(recs: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """E2-E6 for every user that has relevant items and a non-empty list."""
    n_rel = relevant.groupBy(USER).agg(F.count(F.lit(1)).alias("n_rel"))
    r = (recs.filter(F.col("rank") <= k).select(USER, "rank", ITEM)
         .join(relevant.withColumn("hit", F.lit(1)), [USER, ITEM], "left")
         .withColumn("hit", F.coalesce(F.col("hit"), F.lit(0)))
         .join(n_rel, USER))  # inner: only users with relevant items
    w = Window.partitionBy(USER).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    r = r.withColumn("cum_hits", F.sum("hit").over(w))
    per = r.groupBy(USER).agg(
        F.sum("hit").alias("hits"), F.first("n_rel").alias("n_rel"),
        F.sum(F.col("hit") / F.log2(F.col("rank") + 1)).alias("dcg"),
        F.sum(F.when(F.col("hit") == 1, F.col("cum_hits") / F.col("rank")).otherwise(0.0)).alias("ap_sum"))
    ideal = F.least(F.col("n_rel"), F.lit(k))
    return per.select(
        USER, F.col("n_rel").cast("bigint"), F.col("hits").cast("bigint"),
        (F.col("hits") / F.lit(float(k))).alias("precision"),
        (F.col("hits") / F.col("n_rel")).alias("recall"),
        (F.col("hits") > 0).cast("double").alias("hitrate"),
        (F.col("dcg") / _idcg(ideal)).alias("ndcg"),
        (F.col("ap_sum") / ideal).alias("map"))


def coverage(recs: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct recommended items / distinct catalogue items."""
    rec = recs.agg(F.count_distinct(ITEM).alias("_r"))
    cat = items.agg(F.count_distinct(ITEM).alias("_c"))
    return rec.crossJoin(cat).select(  # single-row aggregates
        F.when(F.col("_c") > 0, F.col("_r") / F.col("_c")).otherwise(0.0).alias("coverage"))


def diversity(recs: DataFrame, items: DataFrame) -> DataFrame:
    """Mean Jaccard distance of genre sets over all intra-list pairs of all
    users. Pairs are formed inside each user's (k-bounded) array, not by a join."""
    g = items.select(ITEM, genre_set_raw(F.col("genres")).alias("g"))
    lists = (recs.join(g, ITEM, "left")
             .withColumn("g", F.coalesce(F.col("g"), F.array().cast("array<string>")))
             .groupBy(USER).agg(F.array_sort(F.collect_list(F.struct("rank", "g"))).alias("l"))
             .filter(F.size("l") >= 2))

    def dist(a, b):
        u = F.size(F.array_union(a, b))
        return F.lit(1.0) - F.when(u > 0, F.size(F.array_intersect(a, b)) / u).otherwise(F.lit(0.0))

    n = F.size("l")
    pair_d = F.flatten(F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.transform(
        F.sequence(i + 1, n - 1), lambda j: dist(F.element_at("l", i + 1)["g"], F.element_at("l", j + 1)["g"]))))
    per = lists.select(F.aggregate(pair_d, F.lit(0.0), lambda a, x: a + x).alias("s"),
                       (n * (n - 1) / 2).alias("p"))
    return per.agg(F.coalesce(F.sum("s") / F.sum("p"), F.lit(0.0)).alias("diversity"))


def novelty(recs: DataFrame, train: DataFrame) -> DataFrame:
    """Mean -log2(pop/n_users) over all recommended slots; pop=1 if unseen."""
    pop = train.groupBy(ITEM).agg(F.count(F.lit(1)).alias("pop"))
    nu = train.agg(F.count_distinct(USER).alias("_nu"))
    v = (recs.join(pop, ITEM, "left").crossJoin(F.broadcast(nu))  # one-row side
         .select((F.coalesce(F.col("pop"), F.lit(1)) / F.col("_nu")).alias("p")))
    return v.agg(F.coalesce(F.avg(-F.log2("p")), F.lit(0.0)).alias("novelty"))


def multik(recs: DataFrame, relevant: DataFrame, ks=(5, 10, 15, 20)) -> DataFrame:
    """Recall, NDCG and hit rate at several cut-offs from one list at
    max(k), in one pass: each list row is looked up among the relevant items,
    then paired with the cut-offs it falls under (a broadcast column of len(ks)
    values) and grouped by (k, user)."""
    spark = recs.sparkSession
    cut = F.broadcast(spark.createDataFrame([(int(k),) for k in ks], "k int"))  # len(ks) rows
    n_rel = relevant.groupBy(USER).agg(F.count(F.lit(1)).alias("n_rel"))
    r = (recs.select(USER, "rank", ITEM).join(relevant.withColumn("hit", F.lit(1)), [USER, ITEM], "left")
         .withColumn("hit", F.coalesce(F.col("hit"), F.lit(0))).join(n_rel, USER)
         .crossJoin(cut).filter(F.col("rank") <= F.col("k")))
    per = r.groupBy("k", USER).agg(F.sum("hit").alias("hits"), F.first("n_rel").alias("n_rel"),
                                   F.sum(F.col("hit") / F.log2(F.col("rank") + 1)).alias("dcg"))
    ideal = F.least(F.col("n_rel"), F.col("k"))
    per = per.select("k", (F.col("hits") / F.col("n_rel")).alias("recall"),
                     (F.col("dcg") / _idcg(ideal)).alias("ndcg"), (F.col("hits") > 0).cast("double").alias("hitrate"))
    return per.groupBy("k").agg(*[F.round(F.avg(c), 5).alias(c) for c in ("recall", "ndcg", "hitrate")]).select(
        F.col("k").cast("bigint"), "recall", "ndcg", "hitrate")


def multik_models(curves: dict[str, DataFrame]) -> DataFrame:
    """Several models' multi-K curves in one table with a ``model`` column."""
    from functools import reduce
    return reduce(DataFrame.unionByName, [df.withColumn("model", F.lit(name)) for name, df in curves.items()])
