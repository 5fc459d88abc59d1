"""Second-source enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import fuse_genres, norm_title, runtime_int, year_suffix


def enrich_items(items: DataFrame, cache: DataFrame | None) -> DataFrame:
    """Items left-joined to the cache by id; genres become the sorted union
    of both sources. No cache at all -> ``imdb_genres=''``, null runtime and the
    genres untouched. The input DataFrame is not modified (immutable)."""
    if cache is None or cache.isEmpty():
        return items.withColumn("imdb_genres", F.lit("")).withColumn("runtime", F.lit(None).cast("int"))
    c = cache.select("item_id", F.col("imdb_genres").alias("_ig"), F.col("runtime").alias("_rt"))
    j = items.join(c, "item_id", "left")
    ig = F.coalesce(F.col("_ig"), F.lit(""))
    cols = [fuse_genres(F.col("genres"), ig).alias("genres") if n == "genres" else F.col(n)
            for n in items.columns]
    return j.select(*cols, ig.alias("imdb_genres"), runtime_int(F.coalesce(F.col("_rt"), F.lit(""))).alias("runtime"))


def enrichment_coverage(cache: DataFrame) -> DataFrame:
    """Matched items, and how many carry genres / a runtime."""
    return cache.agg(
        F.count(F.lit(1)).cast("bigint").alias("imdb_matched_items"),
        F.count_if(F.coalesce(F.col("imdb_genres"), F.lit("")) != "").cast("bigint").alias("imdb_with_genres"),
        F.count_if(F.coalesce(F.col("runtime"), F.lit("")) != "").cast("bigint").alias("imdb_with_runtime"))


def title_index(basics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P2 + U7 + W16: movie rows keyed by normalised primary and original title.

    First entry wins per key; the order proxy is (tconst, title position).
    ``min(struct(...))`` is an aggregation, so repeated titles are combined map
    side instead of shuffled whole."""
    b = basics.filter(F.col("titleType").isin("movie", "tvMovie"))
    rec = b.select(
        "tconst", "startYear",
        F.coalesce(F.col("genres"), F.lit("")).alias("imdb_genres"),
        F.coalesce(F.col("runtimeMinutes"), F.lit("")).alias("runtime"),
        F.coalesce(F.col("originalTitle"), F.lit("")).alias("orig_title"),
        F.posexplode(F.array("primaryTitle", "originalTitle")).alias("tpos", "t"))
    rec = rec.filter(F.col("t").isNotNull() & (F.col("t") != "")).withColumn("nt", norm_title(F.col("t")))
    first = F.min(F.struct("tconst", "tpos", "imdb_genres", "runtime", "orig_title")).alias("r")
    by_title_year = rec.filter(F.col("startYear").isNotNull()).groupBy("nt", "startYear").agg(first)
    by_title = rec.groupBy("nt").agg(first)
    return by_title_year, by_title


def build_enrichment(movies: DataFrame, basics: DataFrame) -> DataFrame:
    """Cache rows for movies matched on (title, year), else on title.

    Output: item_id, tconst, imdb_genres, runtime, orig_title, match_tier."""
    by_ty, by_t = title_index(basics)
    m = movies.select("item_id", norm_title(F.col("title")).alias("nt"),
                      year_suffix(F.col("title")).cast("string").alias("year"))
    j = (m.join(by_ty.select(F.col("nt").alias("nt1"), F.col("startYear").alias("y1"), F.col("r").alias("r1")),
                (F.col("nt") == F.col("nt1")) & (F.col("year") == F.col("y1")), "left")
         .join(by_t.select(F.col("nt").alias("nt2"), F.col("r").alias("r2")), F.col("nt") == F.col("nt2"), "left"))
    tier = F.when(F.col("r1").isNotNull(), "title_year").when(F.col("r2").isNotNull(), "title")
    r = F.coalesce(F.col("r1"), F.col("r2"))
    return (j.select("item_id", r.alias("r"), tier.alias("match_tier")).filter(F.col("r").isNotNull())
            .select("item_id", "r.tconst", "r.imdb_genres", "r.runtime", "r.orig_title", "match_tier"))


def match_tier_report(movies: DataFrame, cache: DataFrame) -> DataFrame:
    """Total movies, matches per tier, coverage."""
    tot = movies.agg(F.count(F.lit(1)).alias("total_movies"))
    t = cache.agg(F.count_if(F.col("match_tier") == "title_year").alias("matched_title_year"),
                  F.count_if(F.col("match_tier") == "title").alias("matched_title"),
                  F.count(F.lit(1)).alias("matched"))
    return tot.crossJoin(t).select(  # two single-row aggregates
        F.col("total_movies").cast("bigint"), F.col("matched_title_year").cast("bigint"),
        F.col("matched_title").cast("bigint"), F.col("matched").cast("bigint"),
        F.round(F.when(F.col("total_movies") > 0, F.col("matched") / F.col("total_movies")).otherwise(0.0), 6)
        .alias("coverage"))
