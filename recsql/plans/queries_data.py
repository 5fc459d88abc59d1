"""Registered queries: loading, cleaning, quality, features, enrichment, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import norm_title, year_suffix
from ..operators import enrich, quality, splits
from ..sources import tables as T
from . import oracle_base as B
from .registry import _round_doubles, query

L = "CAST(1 AS BIGINT)"


@query("w1_dedup_ratings", B.with_(B.RATINGS) + """
SELECT user_id, item_id, CAST(rating AS BIGINT) AS rating, "timestamp" FROM ratings""")
def w1_dedup_ratings(c):
    return c.ratings.select("user_id", "item_id", F.col("rating").cast("bigint"), "timestamp")


@query("w1_dedup_report", B.with_(B.RATINGS_RAW) + """,
k_ AS (SELECT user_id, item_id, count(*) AS n FROM ratings_raw GROUP BY 1, 2)
SELECT CAST(sum(n) AS BIGINT) AS dedup_before, count(*) AS dedup_after,
       CAST(sum(n) - count(*) AS BIGINT) AS dedup_removed,
       CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS dedup_dup_rows FROM k_""")
def w1_dedup_report(c):
    return quality.dedup_report(c.ratings_raw)


@query("s11_dataset_summary", B.with_(B.RATINGS, B.ITEMS) + """
SELECT (SELECT count(DISTINCT user_id) FROM ratings) AS n_users,
       (SELECT count(DISTINCT item_id) FROM items) AS n_items,
       (SELECT count(*) FROM ratings) AS n_ratings,
       round((SELECT count(*) FROM ratings) / ((SELECT count(DISTINCT user_id) FROM ratings)
             * (SELECT count(DISTINCT item_id) FROM items)), 5) AS density""")
def s11_dataset_summary(c):
    return _round_doubles(quality.dataset_summary(c.ratings, c.items))


@query("a3_rating_distribution", B.with_(B.RATINGS) + """
SELECT round(avg(CAST(rating AS DOUBLE)), 6) AS mean, round(stddev_samp(rating), 6) AS std,
       CAST(min(rating) AS BIGINT) AS min, CAST(max(rating) AS BIGINT) AS max FROM ratings""")
def a3_rating_distribution(c):
    return _round_doubles(quality.rating_distribution(c.ratings))


@query("a3_rating_counts", B.with_(B.RATINGS) + """
SELECT CAST(rating AS BIGINT) AS rating, count(*) AS n FROM ratings GROUP BY rating""")
def a3_rating_counts(c):
    return quality.rating_value_counts(c.ratings)


def _count_stats_sql(key):
    return B.with_(B.RATINGS) + f""",
c_ AS (SELECT {key}, count(*) AS n FROM ratings GROUP BY {key})
SELECT round(avg(n), 6) AS mean, round(CAST(median(n) AS DOUBLE), 6) AS median, CAST(min(n) AS BIGINT) AS min,
       CAST(max(n) AS BIGINT) AS max, round(stddev_samp(n), 6) AS std FROM c_"""


@query("a4_user_count_stats", _count_stats_sql("user_id"))
def a4_user_count_stats(c):
    return _round_doubles(quality.entity_count_stats(c.ratings, "user_id"))


@query("a5_item_count_stats", _count_stats_sql("item_id"))
def a5_item_count_stats(c):
    return _round_doubles(quality.entity_count_stats(c.ratings, "item_id"))


@query("a6_missing_report", B.with_(B.RATINGS, B.ITEMS, B.USERS) + """,
nulls_ AS (
  SELECT 'ratings' AS "table", 'user_id' AS "column", count(*) FILTER (WHERE user_id IS NULL) AS n_null FROM ratings
  UNION ALL SELECT 'ratings', 'rating', count(*) FILTER (WHERE rating IS NULL) FROM ratings
  UNION ALL SELECT 'items', 'title', count(*) FILTER (WHERE title IS NULL) FROM items
  UNION ALL SELECT 'items', 'genres', count(*) FILTER (WHERE genres IS NULL) FROM items
  UNION ALL SELECT 'items', 'release_year', count(*) FILTER (WHERE release_year IS NULL) FROM items
  UNION ALL SELECT 'items', 'runtime', count(*) FILTER (WHERE runtime IS NULL) FROM items
  UNION ALL SELECT 'users', 'gender', count(*) FILTER (WHERE gender IS NULL) FROM users)
SELECT "table", "column", CAST(n_null AS BIGINT) AS n_null FROM nulls_ WHERE n_null > 0""")
def a6_missing_report(c):
    return quality.missing_report(ratings=c.ratings, items=c.items, users=c.users)


@query("a7_low_support_summary", B.with_(B.RATINGS) + """,
u_ AS (SELECT user_id, count(*) AS n FROM ratings GROUP BY 1),
i_ AS (SELECT item_id, count(*) AS n FROM ratings GROUP BY 1)
SELECT (SELECT count(*) FROM u_) AS n_total_users, (SELECT count(*) FILTER (WHERE n < 3) FROM u_) AS n_low_activity_users,
       (SELECT count(*) FROM i_) AS n_total_items, (SELECT count(*) FILTER (WHERE n < 3) FROM i_) AS n_low_popularity_items,
       CAST(3 AS BIGINT) AS min_user_ratings_threshold, CAST(3 AS BIGINT) AS min_item_ratings_threshold""")
def a7_low_support_summary(c):
    return quality.low_support_summary(c.ratings)


@query("a7_low_activity_users", B.with_(B.RATINGS) + """
SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id HAVING count(*) < 3""")
def a7_low_activity_users(c):
    return quality.low_support(c.ratings, "user_id", 3)


@query("a8_quality_report", B.with_(B.RATINGS_RAW) + """,
ratings AS (
  SELECT user_id, item_id, rating, "timestamp" FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, item_id
       ORDER BY "timestamp" DESC, l_orderkey DESC, l_linenumber DESC, rating DESC) AS rn_ FROM ratings_raw) WHERE rn_ = 1),
""" + B.ITEMS.strip() + "," + B.USERS.strip() + """,
k_ AS (SELECT user_id, item_id, count(*) AS n FROM ratings_raw GROUP BY 1, 2),
u_ AS (SELECT user_id, count(*) AS n FROM ratings GROUP BY 1),
i_ AS (SELECT item_id, count(*) AS n FROM ratings GROUP BY 1),
rep_ AS (
  SELECT 'dedup' AS section, 'dedup_before' AS key, CAST(sum(n) AS DOUBLE) AS value FROM k_
  UNION ALL SELECT 'dedup', 'dedup_after', count(*) FROM k_
  UNION ALL SELECT 'dedup', 'dedup_removed', sum(n) - count(*) FROM k_
  UNION ALL SELECT 'dedup', 'dedup_dup_rows', coalesce(sum(CASE WHEN n > 1 THEN n END), 0) FROM k_
  UNION ALL SELECT 'rating_distribution', 'mean', avg(CAST(rating AS DOUBLE)) FROM ratings
  UNION ALL SELECT 'rating_distribution', 'std', stddev_samp(rating) FROM ratings
  UNION ALL SELECT 'rating_distribution', 'min', min(rating) FROM ratings
  UNION ALL SELECT 'rating_distribution', 'max', max(rating) FROM ratings
  UNION ALL SELECT 'rating_distribution', 'count_' || CAST(rating AS VARCHAR), count(*) FROM ratings GROUP BY rating
  UNION ALL SELECT 'low_quality_flag', 'n_total_users', count(*) FROM u_
  UNION ALL SELECT 'low_quality_flag', 'n_low_activity_users', count(*) FILTER (WHERE n < 3) FROM u_
  UNION ALL SELECT 'low_quality_flag', 'n_total_items', count(*) FROM i_
  UNION ALL SELECT 'low_quality_flag', 'n_low_popularity_items', count(*) FILTER (WHERE n < 3) FROM i_
  UNION ALL SELECT 'low_quality_flag', 'min_user_ratings_threshold', 3
  UNION ALL SELECT 'low_quality_flag', 'min_item_ratings_threshold', 3
  UNION ALL SELECT 'user_stats', 'mean', avg(n) FROM u_
  UNION ALL SELECT 'user_stats', 'median', median(n) FROM u_
  UNION ALL SELECT 'user_stats', 'min', min(n) FROM u_
  UNION ALL SELECT 'user_stats', 'max', max(n) FROM u_
  UNION ALL SELECT 'user_stats', 'std', stddev_samp(n) FROM u_
  UNION ALL SELECT 'item_stats', 'mean', avg(n) FROM i_
  UNION ALL SELECT 'item_stats', 'median', median(n) FROM i_
  UNION ALL SELECT 'item_stats', 'min', min(n) FROM i_
  UNION ALL SELECT 'item_stats', 'max', max(n) FROM i_
  UNION ALL SELECT 'item_stats', 'std', stddev_samp(n) FROM i_
  UNION ALL SELECT 'sparsity', 'density', round((SELECT count(*) FROM ratings)
      / ((SELECT count(DISTINCT user_id) FROM ratings) * (SELECT count(DISTINCT item_id) FROM items)), 6))
SELECT section, key, round(CAST(value AS DOUBLE), 6) AS value FROM rep_""")
def a8_quality_report(c):
    return _round_doubles(quality.quality_report(c.ratings_raw, c.items, c.users, clean=c.ratings))


@query("w2_time_split", B.with_(B.RATINGS) + ",\nsplit_ AS (" + B.time_fold("ratings") + """)
SELECT user_id, item_id, CAST(rating AS BIGINT) AS rating, "timestamp", fold FROM split_""")
def w2_time_split(c):
    return splits.split_by_time(c.ratings).withColumn("rating", F.col("rating").cast("bigint"))


@query("w3_cold_user_split", B.with_(B.SPLIT) + """
SELECT user_id, item_id, CAST(rating AS BIGINT) AS rating, "timestamp", fold FROM split""")
def w3_cold_user_split(c):
    return c.split.withColumn("rating", F.col("rating").cast("bigint"))


@query("w4_cold_item_split", B.with_(B.RATINGS) + """,
ic_ AS (SELECT item_id, count(*) AS n FROM ratings GROUP BY 1),
pool_ AS (SELECT item_id FROM ic_ WHERE n <= 5 OR (SELECT count(*) FILTER (WHERE n <= 5) FROM ic_) = 0),
ilist_ AS (SELECT item_id, row_number() OVER (ORDER BY md5(concat('42|', CAST(item_id AS VARCHAR))), item_id) AS pos_,
                  count(*) OVER () AS n_ FROM pool_),
cold_items AS (SELECT item_id FROM ilist_ WHERE pos_ <= GREATEST(1, FLOOR(n_ * CAST(0.05 AS DOUBLE)))),
warm_ AS (SELECT * FROM ratings WHERE item_id NOT IN (SELECT item_id FROM cold_items)),
split_ AS (""" + B.time_fold("warm_") + """
  UNION ALL SELECT user_id, item_id, rating, "timestamp", 'cold_item' FROM ratings
  WHERE item_id IN (SELECT item_id FROM cold_items))
SELECT user_id, item_id, CAST(rating AS BIGINT) AS rating, "timestamp", fold FROM split_""")
def w4_cold_item_split(c):
    return splits.split_cold_items(c.ratings).withColumn("rating", F.col("rating").cast("bigint"))


@query("f1_title_keys", B.with_(B.ITEMS) + """
SELECT item_id, title,
  trim(regexp_replace(lower(regexp_replace(trim(regexp_replace(title, '\\s*\\(\\d{4}\\)\\s*$', '')),
       '^(.*),\\s*(The|A|An|La|Le|Les|Il|El)$', '\\2 \\1', 'i')), '[^a-z0-9]+', ' ', 'g')) AS norm_title,
  CAST(TRY_CAST(NULLIF(regexp_extract(title, '\\((\\d{4})\\)\\s*$', 1), '') AS INTEGER) AS BIGINT) AS year,
  CAST(release_year AS BIGINT) AS release_year FROM items""")
def f1_title_keys(c):
    return c.items.select("item_id", "title", norm_title(F.col("title")).alias("norm_title"),
                          year_suffix(F.col("title")).cast("bigint").alias("year"),
                          F.col("release_year").cast("bigint"))


@query("x3_enriched_items", B.with_(B.ITEMS) + """
SELECT item_id, title, genres, CAST(release_year AS BIGINT) AS release_year, imdb_genres,
       CAST(runtime AS BIGINT) AS runtime FROM items""")
def x3_enriched_items(c):
    return c.items.select("item_id", "title", "genres", F.col("release_year").cast("bigint"), "imdb_genres",
                          F.col("runtime").cast("bigint"))


@query("a24_enrichment_coverage", B.with_(B.ITEMS) + """
SELECT count(*) AS imdb_matched_items, count(*) FILTER (WHERE coalesce(imdb_genres, '') <> '') AS imdb_with_genres,
       count(*) FILTER (WHERE coalesce(runtime, '') <> '') AS imdb_with_runtime FROM cache""")
def a24_enrichment_coverage(c):
    return enrich.enrichment_coverage(c.cache)


_NORM = """trim(regexp_replace(lower(regexp_replace(trim(regexp_replace({t}, '\\s*\\(\\d{{4}}\\)\\s*$', '')),
       '^(.*),\\s*(The|A|An|La|Le|Les|Il|El)$', '\\2 \\1', 'i')), '[^a-z0-9]+', ' ', 'g'))"""

BASICS_SQL = """
basics AS (
  SELECT concat('tt', lpad(CAST(p_partkey AS VARCHAR), 7, '0')) AS tconst,
         CASE WHEN p_partkey % 5 = 0 THEN 'short' WHEN p_partkey % 5 = 1 THEN 'tvMovie' ELSE 'movie' END AS titleType,
         CASE WHEN p_partkey % 2 = 0 THEN concat('The ', p_name) ELSE p_name END AS primaryTitle,
         upper(p_name) AS originalTitle,
         CAST(CASE WHEN p_partkey % 3 = 0 THEN 1951 + p_size ELSE 1950 + p_size END AS VARCHAR) AS startYear,
         CAST(60 + p_size AS VARCHAR) AS runtimeMinutes, replace(p_type, ' ', ',') AS genres FROM part),
rec_ AS (
  SELECT tconst, startYear, coalesce(genres, '') AS imdb_genres, coalesce(runtimeMinutes, '') AS runtime,
         coalesce(originalTitle, '') AS orig_title, tpos, """ + _NORM.format(t="t") + """ AS nt
  FROM (SELECT *, 0 AS tpos, primaryTitle AS t FROM basics UNION ALL SELECT *, 1, originalTitle FROM basics)
  WHERE titleType IN ('movie', 'tvMovie') AND t IS NOT NULL AND t <> ''),
by_ty_ AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY nt, startYear ORDER BY tconst, tpos) AS r_
           FROM rec_ WHERE startYear IS NOT NULL) WHERE r_ = 1),
by_t_ AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY nt ORDER BY tconst, tpos) AS r_ FROM rec_) WHERE r_ = 1),
mv_ AS (SELECT item_id, """ + _NORM.format(t="title") + """ AS nt,
        CAST(TRY_CAST(NULLIF(regexp_extract(title, '\\((\\d{4})\\)\\s*$', 1), '') AS INTEGER) AS VARCHAR) AS year
        FROM items_base),
built_ AS (
  SELECT m.item_id, coalesce(a.tconst, b.tconst) AS tconst, coalesce(a.imdb_genres, b.imdb_genres) AS imdb_genres,
         coalesce(a.runtime, b.runtime) AS runtime, coalesce(a.orig_title, b.orig_title) AS orig_title,
         CASE WHEN a.tconst IS NOT NULL THEN 'title_year' ELSE 'title' END AS match_tier
  FROM mv_ m LEFT JOIN by_ty_ a ON m.nt = a.nt AND m.year = a.startYear LEFT JOIN by_t_ b ON m.nt = b.nt
  WHERE a.tconst IS NOT NULL OR b.tconst IS NOT NULL)"""


@query("x4_build_enrichment", B.with_(B.ITEMS, BASICS_SQL) + """
SELECT item_id, tconst, imdb_genres, runtime, orig_title, match_tier FROM built_""")
def x4_build_enrichment(c):
    return enrich.build_enrichment(c.items_base, T.imdb_basics(c.spark, c.sf_dir))


@query("a25_match_tiers", B.with_(B.ITEMS, BASICS_SQL) + """
SELECT (SELECT count(*) FROM items_base) AS total_movies,
       (SELECT count(*) FILTER (WHERE match_tier = 'title_year') FROM built_) AS matched_title_year,
       (SELECT count(*) FILTER (WHERE match_tier = 'title') FROM built_) AS matched_title,
       (SELECT count(*) FROM built_) AS matched,
       round((SELECT count(*) FROM built_) / (SELECT count(*) FROM items_base), 6) AS coverage""")
def a25_match_tiers(c):
    built = enrich.build_enrichment(c.items_base, T.imdb_basics(c.spark, c.sf_dir))
    return enrich.match_tier_report(c.items_base, built)


from ..operators import features  # noqa: E402


def _stats_sql(key, prefix):
    return B.with_(B.RATINGS) + f""",
s_ AS (SELECT {key}, count(*) AS c, avg(CAST(rating AS DOUBLE)) AS m, coalesce(stddev_samp(rating), 0) AS s
       FROM ratings GROUP BY 1),
b_ AS (SELECT min(c) AS lc, max(c) AS hc, min(m) AS lm, max(m) AS hm FROM s_)
SELECT {key}, c AS {prefix}_rating_count, round(m, 6) AS {prefix}_rating_mean, round(s, 6) AS {prefix}_rating_std,
       round(CASE WHEN hc > lc THEN (c - lc) / (hc - lc) ELSE 0 END, 6) AS {prefix}_rating_count_norm,
       round(CASE WHEN hm > lm THEN (m - lm) / (hm - lm) ELSE 0 END, 6) AS {prefix}_rating_mean_norm
FROM s_ CROSS JOIN b_"""


@query("a1_item_stats", _stats_sql("item_id", "item"))
def a1_item_stats(c):
    return _round_doubles(features.item_stats(c.ratings))


@query("a2_user_stats", _stats_sql("user_id", "user"))
def a2_user_stats(c):
    return _round_doubles(features.user_stats(c.ratings))


@query("f15_genre_multihot", B.with_(B.ITEMS) + """,
cells_ AS (SELECT DISTINCT item_id, g AS genre FROM
  (SELECT item_id, unnest(list_filter(list_transform(string_split(coalesce(genres, ''), '|'), lambda x: trim(x)), lambda x: x <> '')) AS g FROM items)),
voc_ AS (SELECT genre, row_number() OVER (ORDER BY genre) - 1 AS genre_idx FROM (SELECT DISTINCT genre FROM cells_))
SELECT item_id, genre, genre_idx FROM cells_ JOIN voc_ USING (genre)""")
def f15_genre_multihot(c):
    return features.genre_multihot(c.items)


_AGES = (1, 18, 25, 35, 45, 50, 56)


@query("x2_user_features", B.with_(B.USERS) + """,
b_ AS (SELECT min(CAST(age AS DOUBLE)) AS lo, max(CAST(age AS DOUBLE)) AS hi FROM users)
SELECT user_id, CASE WHEN gender = 'M' THEN 1 ELSE 0 END AS gender_M, CASE WHEN gender = 'F' THEN 1 ELSE 0 END AS gender_F,
       round((age - lo) / (hi - lo + 1e-9), 6) AS age_normalized, occupation, """ +
       ", ".join(f"CASE WHEN age = {a} THEN 1 ELSE 0 END AS age_bucket_{a}" for a in _AGES) + """
FROM users CROSS JOIN b_""")
def x2_user_features(c):
    return _round_doubles(features.user_features(c.users))
