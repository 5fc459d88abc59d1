"""Driver test tables mapped onto the recommender schemas.

ratings <- lineitem x orders (customer = user, part = item, quantity -> 1..5),
items <- part (name words = genres, type + last word = second-source genres),
users <- customer. Only the needed columns are selected so the parquet scans
prune to them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import release_year
from ..operators.quality import dedup_ratings


@dataclass(frozen=True)
class Dataset:
    ratings: DataFrame
    items: DataFrame
    users: DataFrame | None = None
    name: str = "dataset"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    od = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").cast("bigint").alias("user_id"),
                    F.col("l_partkey").cast("bigint").alias("item_id"),
                    F.least(F.lit(5), F.lit(1) + F.floor((F.col("l_quantity") - 1) / 10))
                    .cast("int").alias("rating"),
                    (F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * 86400)
                    .alias("timestamp"),
                    "l_orderkey", "l_linenumber"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated ratings: latest (timestamp, orderkey, linenumber, rating) per pair."""
    return dedup_ratings(ratings_raw(spark, sf_dir),
                         tiebreak=["l_orderkey", "l_linenumber", "rating"])


def items_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    title = F.concat(F.col("p_name"), F.lit(" ("), (F.lit(1950) + F.col("p_size")).cast("string"), F.lit(")"))
    return p.select(F.col("p_partkey").cast("bigint").alias("item_id"),
                    title.alias("title"),
                    F.replace(F.col("p_name"), F.lit(" "), F.lit("|")).alias("genres"),
                    release_year(title).alias("release_year"))


def enrichment_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second-source metadata keyed by item id (the cache table of S6)."""
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    return p.select(F.col("p_partkey").cast("bigint").alias("item_id"),
                    F.concat(F.lit("tt"), F.lpad(F.col("p_partkey").cast("string"), 7, "0")).alias("tconst"),
                    F.concat(F.col("p_type"), F.lit(","), F.substring_index("p_name", " ", -1)).alias("imdb_genres"),
                    F.col("p_size").cast("string").alias("runtime"),
                    F.col("p_name").alias("orig_title"))


def imdb_basics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title-basics-shaped rows derived from ``part`` for the matching ETL.

    A third of the rows carry a shifted year (only a title match is possible),
    every fifth is a short (filtered out), and the primary title puts a leading
    article ``The`` so the article rule of the title normaliser is exercised."""
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    year = F.when(F.col("p_partkey") % 3 == 0, F.lit(1951) + F.col("p_size")).otherwise(F.lit(1950) + F.col("p_size"))
    return p.select(
        F.concat(F.lit("tt"), F.lpad(F.col("p_partkey").cast("string"), 7, "0")).alias("tconst"),
        F.when(F.col("p_partkey") % 5 == 0, "short").when(F.col("p_partkey") % 5 == 1, "tvMovie")
        .otherwise("movie").alias("titleType"),
        F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("The "), F.col("p_name")))
        .otherwise(F.col("p_name")).alias("primaryTitle"),
        F.upper(F.col("p_name")).alias("originalTitle"),
        year.cast("string").alias("startYear"),
        (F.lit(60) + F.col("p_size")).cast("string").alias("runtimeMinutes"),
        F.replace(F.col("p_type"), F.lit(" "), F.lit(",")).alias("genres"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue with the second source fused in."""
    from ..operators.enrich import enrich_items
    return enrich_items(items_base(spark, sf_dir), enrichment_cache(spark, sf_dir))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    age = (F.when(F.col("c_custkey") % 7 == 0, 1).when(F.col("c_custkey") % 7 == 1, 18)
           .when(F.col("c_custkey") % 7 == 2, 25).when(F.col("c_custkey") % 7 == 3, 35)
           .when(F.col("c_custkey") % 7 == 4, 45).when(F.col("c_custkey") % 7 == 5, 50).otherwise(56))
    return c.select(F.col("c_custkey").cast("bigint").alias("user_id"),
                    F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender"),
                    age.cast("int").alias("age"),
                    F.col("c_nationkey").cast("int").alias("occupation"),
                    F.substring(F.col("c_name"), -5, 5).alias("zip_code"))


def dataset(spark: SparkSession, sf_dir: str) -> Dataset:
    return Dataset(ratings=ratings(spark, sf_dir), items=items(spark, sf_dir),
                   users=users(spark, sf_dir), name=sf_dir.rstrip("/").split("/")[-1])
