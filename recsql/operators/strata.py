"""Error analysis and strata.

Quantile edges are exact percentiles with linear interpolation (one
aggregation); buckets are right-closed intervals, the first including the
minimum; duplicate edges collapse (fewer buckets)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ITEM, RATING, USER
from . import metrics as M


def per_user_rmse(preds: DataFrame) -> DataFrame:
    """A14."""
    e = F.col(RATING).cast("double") - F.col("prediction")
    return preds.groupBy(USER).agg(F.sqrt(F.avg(e * e)).alias("rmse"))


def per_user_recall(recs: DataFrame, test: DataFrame, k: int = 10, threshold: float = 4.0) -> DataFrame:
    """Users with relevant items; an empty list counts as recall 0."""
    rel = M.relevant_items(test, threshold)
    n_rel = rel.groupBy(USER).agg(F.count(F.lit(1)).alias("n_rel"))
    hits = (recs.filter(F.col("rank") <= k).join(rel, [USER, ITEM])
            .groupBy(USER).agg(F.count(F.lit(1)).alias("hits")))
    return n_rel.join(hits, USER, "left").select(
        USER, (F.coalesce(F.col("hits"), F.lit(0)) / F.col("n_rel")).alias("recall"))


def quantile_buckets(counts: DataFrame, value: str, n_buckets: int = 4) -> DataFrame:
    """Adds ``bucket`` (1..m) from exact quantile edges of ``value``."""
    probs = [i / n_buckets for i in range(n_buckets + 1)]
    edges = counts.agg(F.array_distinct(F.array_sort(F.percentile(F.col(value).cast("double"), probs))).alias("_e"))
    b = F.lit(1) + F.size(F.filter(F.slice(F.col("_e"), 2, n_buckets), lambda e: e < F.col(value)))
    return counts.crossJoin(F.broadcast(edges)).withColumn("bucket", b.cast("int")).drop("_e")  # one-row side


def by_user_activity(preds: DataFrame, recs: DataFrame, train: DataFrame, test: DataFrame,
                     k: int = 10, threshold: float = 4.0, n_buckets: int = 4) -> DataFrame:
    """Per activity bucket: users, mean train ratings, RMSE, MAE, recall, eval users."""
    act = quantile_buckets(train.groupBy(USER).agg(F.count(F.lit(1)).alias("n_ratings")), "n_ratings", n_buckets)
    e = F.col(RATING).cast("double") - F.col("prediction")
    err = (preds.join(act.select(USER, "bucket"), USER)
           .groupBy("bucket").agg(F.round(F.sqrt(F.avg(e * e)), 4).alias("rmse"), F.round(F.avg(F.abs(e)), 4).alias("mae")))
    rec = (per_user_recall(recs, test, k, threshold).join(act.select(USER, "bucket"), USER)
           .groupBy("bucket").agg(F.round(F.avg("recall"), 4).alias(f"recall@{k}"), F.count(F.lit(1)).alias("eval_users")))
    base = act.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_users"),
                                     F.round(F.avg("n_ratings"), 1).alias("mean_train_ratings"))
    return (base.join(err, "bucket", "left").join(rec, "bucket", "left")
            .select(F.concat(F.lit("Q"), F.col("bucket").cast("string")).alias("bucket"),
                    F.col("n_users").cast("bigint"), "mean_train_ratings", "rmse", "mae",
                    F.coalesce(F.col(f"recall@{k}"), F.lit(0.0)).alias(f"recall@{k}"),
                    F.coalesce(F.col("eval_users"), F.lit(0)).cast("bigint").alias("eval_users")))


def by_item_popularity(recs: DataFrame, train: DataFrame, test: DataFrame, k: int = 10,
                       threshold: float = 4.0, n_buckets: int = 4) -> DataFrame:
    """Per popularity bucket: users with a non-empty list and a relevant
    test item in the bucket, and the share whose list contains one of them."""
    pop = quantile_buckets(train.groupBy(ITEM).agg(F.count(F.lit(1)).alias("n_ratings")), "n_ratings", n_buckets)
    rel = (test.filter(F.col(RATING) >= threshold).select(USER, ITEM)
           .join(pop.select(ITEM, "bucket"), ITEM)
           .join(recs.select(USER).distinct(), USER, "left_semi"))
    hit_pairs = rel.join(recs.filter(F.col("rank") <= k).select(USER, ITEM), [USER, ITEM], "left_semi")
    users = rel.select("bucket", USER).distinct().groupBy("bucket").agg(F.count(F.lit(1)).alias("eval_users"))
    hits = hit_pairs.select("bucket", USER).distinct().groupBy("bucket").agg(F.count(F.lit(1)).alias("_h"))
    base = pop.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_items"), F.round(F.avg("n_ratings"), 1).alias("mean_ratings"))
    return (base.join(users, "bucket", "left").join(hits, "bucket", "left")
            .select(F.concat(F.lit("Q"), F.col("bucket").cast("string")).alias("bucket"),
                    F.col("n_items").cast("bigint"), "mean_ratings",
                    F.when(F.col("eval_users") > 0, F.round(F.coalesce("_h", F.lit(0)) / F.col("eval_users"), 4))
                    .otherwise(0.0).alias("hit_rate"),
                    F.coalesce("eval_users", F.lit(0)).cast("bigint").alias("eval_users")))


def error_summary(preds: DataFrame) -> DataFrame:
    """error = true - pred; rmse, mae, mean error, over/under/exact rates."""
    t, p = F.col(RATING).cast("double"), F.col("prediction")
    e = t - p
    return preds.agg(F.round(F.sqrt(F.avg(e * e)), 4).alias("rmse"), F.round(F.avg(F.abs(e)), 4).alias("mae"),
                     F.round(F.avg(e), 4).alias("mean_error"),
                     F.round(F.avg((p > t).cast("double")), 4).alias("over_est_rate"),
                     F.round(F.avg((p < t).cast("double")), 4).alias("under_est_rate"),
                     F.round(F.avg((F.abs(e) < 0.5).cast("double")), 4).alias("exact_rate"))


def error_by_rating(preds: DataFrame) -> DataFrame:
    """A20."""
    e = F.col(RATING).cast("double") - F.col("prediction")
    return preds.groupBy(F.col(RATING).cast("bigint").alias(RATING)).agg(
        F.count(F.lit(1)).alias("count"), F.round(F.avg(e), 4).alias("mean_error"), F.round(F.avg(F.abs(e)), 4).alias("mae"))


def error_histogram(preds: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width histogram of errors over [min, max], every bin listed;
    the last bin is closed; a zero range is widened by 0.5 on each side."""
    e = (F.col(RATING).cast("double") - F.col("prediction")).alias("e")
    errs = preds.select(e)
    b = errs.agg(F.min("e").alias("_mn"), F.max("e").alias("_mx")).select(
        F.when(F.col("_mx") > F.col("_mn"), F.col("_mn")).otherwise(F.col("_mn") - 0.5).alias("_lo"),
        F.when(F.col("_mx") > F.col("_mn"), F.col("_mx")).otherwise(F.col("_mx") + 0.5).alias("_hi"))
    idx = F.least(F.lit(bins), F.floor((F.col("e") - F.col("_lo")) * F.lit(bins) / (F.col("_hi") - F.col("_lo"))) + 1)
    h = (errs.crossJoin(F.broadcast(b))  # b: one-row bounds
         .groupBy(idx.cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    edges = (b.filter(F.col("_lo").isNotNull())  # one row, all bins
             .select("_lo", "_hi", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(bins).cast("bigint"))).alias("bin")))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    return edges.join(h, "bin", "left").select(
        "bin", (F.col("_lo") + (F.col("bin") - 1) * w).alias("lo"), (F.col("_lo") + F.col("bin") * w).alias("hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))
