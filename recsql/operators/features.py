"""Feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import genre_list
from ..plans.ranking import global_positions
from ..schemas import ITEM, RATING, USER

# The age codes of the user table.
AGE_CODES = (1, 18, 25, 35, 45, 50, 56)


def rating_stats(ratings: DataFrame, key: str, prefix: str) -> DataFrame:
    """A1/A2: count, mean, sample std (single rating -> 0) and min-max
    normalised count and mean (0 when all equal)."""
    r = F.col(RATING).cast("double")
    agg = ratings.groupBy(key).agg(F.count(F.lit(1)).alias(f"{prefix}_rating_count"),
                                   F.avg(r).alias(f"{prefix}_rating_mean"),
                                   F.coalesce(F.stddev_samp(r), F.lit(0.0)).alias(f"{prefix}_rating_std"))
    cols = [f"{prefix}_rating_count", f"{prefix}_rating_mean"]
    bounds = agg.agg(*[e for c in cols for e in (F.min(c).alias(f"_lo_{c}"), F.max(c).alias(f"_hi_{c}"))])
    out = agg.crossJoin(F.broadcast(bounds))  # one-row side
    for c in cols:
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        out = out.withColumn(f"{c}_norm", F.when(hi > lo, (F.col(c) - lo) / (hi - lo)).otherwise(F.lit(0.0)))
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def item_stats(ratings: DataFrame) -> DataFrame:
    return rating_stats(ratings, ITEM, "item")


def user_stats(ratings: DataFrame) -> DataFrame:
    return rating_stats(ratings, USER, "user")


def genre_vocabulary(items: DataFrame) -> DataFrame:
    """Sorted genre names with a 0-based column index (byte order)."""
    g = items.select(F.explode(genre_list(F.col("genres"))).alias("genre")).distinct()
    return global_positions(g, [F.col("genre").asc()]).select("genre", (F.col("pos") - 1).alias("genre_idx"))


def genre_multihot(items: DataFrame) -> DataFrame:
    """F15 in long form: one row per (item, genre) set cell, with the column index."""
    cells = items.select(ITEM, F.explode(F.array_distinct(genre_list(F.col("genres")))).alias("genre"))
    return cells.join(genre_vocabulary(items), "genre").select(ITEM, "genre", "genre_idx")


def genre_matrix_wide(items: DataFrame, vocab: list[str]) -> DataFrame:
    """F15 wide: one 0/1 column per genre of the stated list; the long form
    ``genre_multihot`` takes a vocabulary of any size."""
    cells = items.select(ITEM).distinct().join(genre_multihot(items), ITEM, "left")
    # Aggregated by position: genre names may differ in case only.
    return cells.groupBy(ITEM).agg(*[F.coalesce(F.max((F.col("genre") == F.lit(g)).cast("double")), F.lit(0.0)).alias(g)
                                     for g in vocab])


def user_features(users: DataFrame, ages: tuple[int, ...] = AGE_CODES) -> DataFrame:
    """X2 (F7-F9): gender flags, min-max age (+1e-9), occupation, one 0/1 column
    per age code of the stated list."""
    b = users.agg(F.min(F.col("age").cast("double")).alias("_lo"), F.max(F.col("age").cast("double")).alias("_hi"))
    u = users.crossJoin(F.broadcast(b))  # one-row side
    cols = [USER,
            (F.col("gender") == "M").cast("int").alias("gender_M"),
            (F.col("gender") == "F").cast("int").alias("gender_F"),
            ((F.col("age").cast("double") - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + F.lit(1e-9)))
            .alias("age_normalized"),
            "occupation"]
    cols += [(F.col("age") == F.lit(a)).cast("int").alias(f"age_bucket_{int(a)}") for a in ages]
    return u.select(*cols)


def all_features(ratings: DataFrame, items: DataFrame, users: DataFrame | None) -> dict:
    """Every feature table, each built once."""
    out = {"genre_matrix": genre_multihot(items), "item_stats": item_stats(ratings),
           "user_stats": user_stats(ratings)}
    if users is not None:
        out["user_features"] = user_features(users)
    return out
