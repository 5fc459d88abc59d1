"""File sources and sinks.

The raw rating/movie/user files are ``::``-delimited latin-1 text without a
header; the title basics file is a gzipped TSV with ``\\N`` for null.
Explicit schemas everywhere: no inference pass over the data.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schemas as S
from .publish import current, publish

_MOVIES_RAW = T.StructType([
    T.StructField(S.ITEM, T.LongType(), False),
    T.StructField("title", T.StringType(), True),
    T.StructField("genres", T.StringType(), True),
])


def _read_dat(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # A missing path raises AnalysisException PATH_NOT_FOUND naming it.
    return (spark.read.option("sep", "::").option("encoding", "ISO-8859-1")
            .option("header", "false").option("mode", "FAILFAST")
            .schema(schema).csv(path))


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """``UserID::MovieID::Rating::Timestamp``."""
    return _read_dat(spark, path, S.RATINGS)


def read_movies(spark: SparkSession, path: str) -> DataFrame:
    """S2 + P1: movies with ``release_year`` from the first ``(dddd)`` in the title."""
    from ..functions.text import release_year
    return _read_dat(spark, path, _MOVIES_RAW).withColumn("release_year", release_year("title"))


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """S3: ``UserID::Gender::Age::Occupation::Zip``."""
    return _read_dat(spark, path, S.USERS)


def read_imdb_basics(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Title basics TSV (gzip is unsplittable, so spread rows after the scan)."""
    df = (spark.read.option("sep", "\t").option("header", "true")
          .option("nullValue", "\\N").option("quote", "")
          .schema(S.IMDB_BASICS).csv(path))
    if partitions:
        df = df.repartition(partitions)
    return df


# Spark's error conditions of a path without data, and of files
# that are not of the expected format. Any other failure (storage, rights) is raised.
ABSENT = ("PATH_NOT_FOUND", "FileNotFoundException", "UNABLE_TO_INFER_SCHEMA")
DAMAGED = ("is not a Parquet file", "CANNOT_READ_FILE_FOOTER", "CANNOT_MERGE_SCHEMAS")


class DamagedTable(UserWarning):
    """A table is there but cannot be read as what it should be."""


def _names(error: Exception, conditions: tuple[str, ...]) -> bool:
    return any(name in str(error) for name in conditions)


def read_enrichment(spark: SparkSession, path: str | None) -> DataFrame:
    """Enrichment cache as last published; absent or unreadable -> empty
    table with schema, unreadable with a ``DamagedTable`` warning. All footers
    are read (by a Spark job), so one damaged file is enough to be seen."""
    empty = spark.createDataFrame([], S.ENRICHMENT)
    if not path:
        return empty
    path = current(spark, path)
    try:
        found = {f.name: f.dataType for f in spark.read.option("mergeSchema", "true").parquet(path).schema}
    except Exception as e:  # noqa: BLE001
        if _names(e, DAMAGED):
            warnings.warn(f"{path}: {str(e).splitlines()[0]}", DamagedTable, stacklevel=2)
        elif not _names(e, ABSENT):
            raise
        return empty
    wrong = [f.name for f in S.ENRICHMENT.fields if found.get(f.name) != f.dataType]
    if wrong:
        warnings.warn(f"{path}: columns missing or of another type: {', '.join(wrong)}", DamagedTable, stacklevel=2)
        return empty
    return spark.read.schema(S.ENRICHMENT).parquet(path)


def write_enrichment(cache: DataFrame, path: str) -> None:
    """Replace the enrichment table in one step (see ``publish``)."""
    publish(cache.select([f.name for f in S.ENRICHMENT.fields]), path)


def dataset_from_files(spark: SparkSession, data_dir: str, cache_path: str | None = None):
    """Load the three sources, enrich items, validate columns."""
    from ..operators.enrich import enrich_items
    from .tables import Dataset
    ratings = read_ratings(spark, f"{data_dir}/ratings.dat")
    movies = read_movies(spark, f"{data_dir}/movies.dat")
    try:
        users = read_users(spark, f"{data_dir}/users.dat")
        users.limit(0).collect()
    except Exception as e:  # noqa: BLE001 - users are optional
        if not _names(e, ABSENT):
            raise
        users = None
    items = enrich_items(movies, read_enrichment(spark, cache_path))
    S.require_columns(ratings, [S.USER, S.ITEM, S.RATING, S.TS], "ratings")
    S.require_columns(items, [S.ITEM, "title", "genres"], "items")
    return Dataset(ratings=ratings, items=items, users=users, name="files")
