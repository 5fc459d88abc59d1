"""Column names and explicit schemas of the normalised tables."""

from pyspark.sql import types as T

USER, ITEM, RATING, TS = "user_id", "item_id", "rating", "timestamp"

RATINGS = T.StructType([
    T.StructField(USER, T.LongType(), False),
    T.StructField(ITEM, T.LongType(), False),
    T.StructField(RATING, T.IntegerType(), False),
    T.StructField(TS, T.LongType(), False),
])

ITEMS = T.StructType([
    T.StructField(ITEM, T.LongType(), False),
    T.StructField("title", T.StringType(), True),
    T.StructField("genres", T.StringType(), True),
])

USERS = T.StructType([
    T.StructField(USER, T.LongType(), False),
    T.StructField("gender", T.StringType(), True),
    T.StructField("age", T.IntegerType(), True),
    T.StructField("occupation", T.IntegerType(), True),
    T.StructField("zip_code", T.StringType(), True),
])

IMDB_BASICS = T.StructType([
    T.StructField(name, T.StringType(), True)
    for name in ["tconst", "titleType", "primaryTitle", "originalTitle",
                 "startYear", "runtimeMinutes", "genres"]
])

ENRICHMENT = T.StructType([
    T.StructField(ITEM, T.LongType(), False),
    T.StructField("tconst", T.StringType(), True),
    T.StructField("imdb_genres", T.StringType(), True),
    T.StructField("runtime", T.StringType(), True),
    T.StructField("orig_title", T.StringType(), True),
])

RECS = "user_id long, rank int, item_id long, score double"


def require_columns(df, cols, what="table"):
    """Fail fast when a required column is missing (schema validation)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing columns {missing}")
    return df
