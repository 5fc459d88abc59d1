"""Data cleaning and quality reports.

All reports are aggregations (partial + final, so a hot key is combined map
side before the shuffle) returning small DataFrames; nothing is collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ITEM, RATING, TS, USER


def dedup_ratings(raw: DataFrame, tiebreak: list[str] | None = None) -> DataFrame:
    """Keep the latest rating per (user, item).

    Expressed as ``max(struct(ts, tiebreak..., rating))`` per key rather than a
    window, so duplicates are combined before the shuffle and a hot key never
    lands whole in one task."""
    order = [TS] + list(tiebreak or []) + ([RATING] if RATING not in (tiebreak or []) else [])
    latest = F.max(F.struct(*[F.col(c) for c in order])).alias("_m")
    return (raw.groupBy(USER, ITEM).agg(latest)
            .select(USER, ITEM, F.col(f"_m.{RATING}").alias(RATING), F.col(f"_m.{TS}").alias(TS)))


def dedup_report(raw: DataFrame) -> DataFrame:
    """W1 report: rows before/after, removed, and rows in any duplicated key."""
    per_key = raw.groupBy(USER, ITEM).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").cast("bigint").alias("dedup_before"),
        F.count(F.lit(1)).cast("bigint").alias("dedup_after"),
        (F.sum("n") - F.count(F.lit(1))).cast("bigint").alias("dedup_removed"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("dedup_dup_rows"))


def dataset_summary(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct users, catalogue items, ratings, density (5 dp)."""
    r = ratings.agg(F.count_distinct(USER).alias("n_users"), F.count(F.lit(1)).alias("n_ratings"))
    i = items.agg(F.count_distinct(ITEM).alias("n_items"))
    den = F.col("n_users") * F.col("n_items")
    return r.crossJoin(i).select(  # both sides are single-row aggregates
        F.col("n_users").cast("bigint"), F.col("n_items").cast("bigint"), F.col("n_ratings").cast("bigint"),
        F.when(den > 0, F.round(F.col("n_ratings") / den, 5)).otherwise(F.lit(0.0)).alias("density"))


def rating_distribution(ratings: DataFrame) -> DataFrame:
    """A3 summary: mean, sample std, min, max of the rating column."""
    return ratings.agg(F.avg(RATING).alias("mean"), F.stddev_samp(RATING).alias("std"),
                       F.min(RATING).cast("bigint").alias("min"), F.max(RATING).cast("bigint").alias("max"))


def rating_value_counts(ratings: DataFrame) -> DataFrame:
    """A3 distribution: count per rating value."""
    return ratings.groupBy(RATING).agg(F.count(F.lit(1)).alias("n")).select(
        F.col(RATING).cast("bigint").alias(RATING), F.col("n").cast("bigint"))


def entity_count_stats(ratings: DataFrame, key: str) -> DataFrame:
    """A4/A5: distribution of ratings per user (or per item)."""
    counts = ratings.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.avg("n").alias("mean"), F.median("n").cast("double").alias("median"),
                      F.min("n").cast("bigint").alias("min"), F.max("n").cast("bigint").alias("max"),
                      F.stddev_samp("n").alias("std"))


def missing_report(**tables: DataFrame) -> DataFrame:
    """(table, column, n_null) for every column with at least one null."""
    parts = []
    for name, df in tables.items():
        if df is None:
            continue
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
        stack = F.expr("stack({n}, {args}) as (column, n_null)".format(
            n=len(df.columns),
            args=", ".join(f"'{c}', cast(`{c}` as bigint)" for c in df.columns)))
        parts.append(counts.select(F.lit(name).alias("table"), stack))
    out = reduce(DataFrame.unionByName, parts)
    return out.filter(F.col("n_null") > 0)


def low_support(ratings: DataFrame, key: str, min_count: int = 3) -> DataFrame:
    """Ids with strictly fewer than ``min_count`` ratings, with their count."""
    return (ratings.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") < min_count).select(key, F.col("n").cast("bigint")))


def low_support_summary(ratings: DataFrame, min_user: int = 3, min_item: int = 3) -> DataFrame:
    """A7 totals: users/items seen and how many are under the thresholds."""
    u = ratings.groupBy(USER).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_total_users"),
        F.count_if(F.col("n") < min_user).cast("bigint").alias("n_low_activity_users"))
    i = ratings.groupBy(ITEM).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_total_items"),
        F.count_if(F.col("n") < min_item).cast("bigint").alias("n_low_popularity_items"))
    return u.crossJoin(i).select(  # single-row aggregates
        "*", F.lit(min_user).cast("bigint").alias("min_user_ratings_threshold"),
        F.lit(min_item).cast("bigint").alias("min_item_ratings_threshold"))


def _long(section: str, df: DataFrame) -> DataFrame:
    """One-row wide report -> (section, key, value double)."""
    stack = F.expr("stack({n}, {args}) as (key, value)".format(
        n=len(df.columns), args=", ".join(f"'{c}', cast(`{c}` as double)" for c in df.columns)))
    return df.select(F.lit(section).alias("section"), stack)


def quality_report(raw_ratings: DataFrame, items: DataFrame, users: DataFrame | None,
                   clean: DataFrame | None = None, min_user: int = 3, min_item: int = 3) -> DataFrame:
    """Composite report as a long (section, key, value) table."""
    clean = clean if clean is not None else dedup_ratings(raw_ratings)
    dist = rating_value_counts(clean).select(
        F.lit("rating_distribution").alias("section"),
        F.concat(F.lit("count_"), F.col(RATING).cast("string")).alias("key"),
        F.col("n").cast("double").alias("value"))
    missing = missing_report(ratings=raw_ratings.select(USER, ITEM, RATING, TS), items=items, users=users).select(
        F.lit("missing_values").alias("section"),
        F.concat_ws(".", "table", "column").alias("key"), F.col("n_null").cast("double").alias("value"))
    summ = dataset_summary(clean, items)
    parts = [
        _long("dedup", dedup_report(raw_ratings)),
        _long("rating_distribution", rating_distribution(clean)),
        dist,
        missing,
        _long("low_quality_flag", low_support_summary(clean, min_user, min_item)),
        _long("user_stats", entity_count_stats(clean, USER)),
        _long("item_stats", entity_count_stats(clean, ITEM)),
        _long("sparsity", summ.select(F.round(F.col("n_ratings") / (F.col("n_users") * F.col("n_items")), 6)
                                      .alias("density"))),
    ]
    return reduce(DataFrame.unionByName, parts)
