"""App-level read queries re-aimed as table operators."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import score_percent
from ..functions.text import genre_list
from ..plans.ranking import topk
from ..schemas import ITEM, RATING, USER


RATINGS_COUNTED = 500_000  # ratings of one task that counts genres, about


def user_genre_counts(history: DataFrame, items: DataFrame) -> DataFrame:
    """J4 + explode: (user_id, genre, n) over a user's rated items. Ratings are dealt
    out by user before they are counted, to as many tasks as there are ratings for:
    a count before that would hold nearly one entry per rating and genre."""
    g = items.select(ITEM, genre_list(F.col("genres")).alias("_genres"))
    rated = history.select(USER, ITEM)
    tasks = max(rated.sparkSession.sparkContext.defaultParallelism, math.ceil(rated.count() / RATINGS_COUNTED))
    return (rated.join(g, ITEM).select(USER, "_genres").repartition(tasks, USER)
            .select(USER, F.explode("_genres").alias("genre")).groupBy(USER, "genre").agg(F.count(F.lit(1)).alias("n")))


def user_top_genres(history: DataFrame, items: DataFrame, n: int = 1) -> DataFrame:
    """A user's most frequent genres (ties: genre name)."""
    return topk(user_genre_counts(history, items), n, by=USER,
                order=[F.col("n").desc(), F.col("genre").asc()], rank_col="grank")


# Fixed lookup tables: age codes and colour groups as the reference has them,
# gender signs with English letters.
AGE_LABELS = {1: "<18", 18: "18–24", 25: "25–34", 35: "35–44", 45: "45–49", 50: "50–55", 56: "56+"}
GENDER_LABELS = {"M": "♂ M", "F": "♀ F"}
GENRE_GROUP = {
    "Action": "warm", "Adventure": "warm", "War": "warm", "Western": "warm",
    "Crime": "warm", "Film-Noir": "warm", "Thriller": "warm",
    "Comedy": "golden", "Animation": "golden", "Children's": "golden",
    "Family": "golden", "Musical": "golden", "Music": "golden",
    "Drama": "rose", "Romance": "rose",
    "Documentary": "teal", "Biography": "teal", "History": "teal", "Sport": "teal",
    "Sci-Fi": "plum", "Fantasy": "plum", "Horror": "plum", "Mystery": "plum",
}
GENERIC_REASON = "based on your overall taste"
# The five one-click preference bundles of the onboarding page.
PRESET_BUNDLES = [
    ("action_scifi", ["Action", "Sci-Fi", "Thriller"]),
    ("light_comedy", ["Comedy", "Animation", "Children's"]),
    ("deep_drama", ["Drama", "Romance", "Mystery"]),
    ("horror_suspense", ["Horror", "Thriller", "Mystery"]),
    ("arthouse_documentary", ["Documentary", "Drama", "Musical"]),
]
PAGE_SIZE = 40


def _lookup(mapping: dict, col):
    """small fixed lookup as a literal map expression."""
    pairs = [x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))]
    return F.element_at(F.create_map(*pairs), col)


def genre_group(genre) -> "F.Column":
    """genre -> colour group (``plum`` when unknown)."""
    return F.coalesce(_lookup(GENRE_GROUP, genre), F.lit("plum"))


def tags(genres, limit: int = 4):
    """first ``limit`` genres of ``|``/``,`` separated text."""
    parts = F.filter(F.transform(F.split(F.regexp_replace(F.coalesce(genres, F.lit("")), r"\|", ","), ","),
                                 lambda g: F.trim(g)), lambda g: g != "")
    return F.slice(parts, 1, limit)


def item_lookup(recs: DataFrame, items: DataFrame) -> DataFrame:
    """Recommendations with title, genres, year, runtime; unknown ids show the id."""
    from ..functions.text import split_title
    i = items.select(ITEM, F.col("title").alias("_t"), F.col("genres").alias("_g"), "release_year", "runtime")
    j = recs.join(i, ITEM, "left")
    title = F.coalesce(F.col("_t"), F.col(ITEM).cast("string"))
    name, year = split_title(title)
    return (j.withColumn("title", title).withColumn("name", name).withColumn("year", year)
            .withColumn("genres", F.coalesce(F.col("_g"), F.lit(""))).drop("_t", "_g"))


def recommendation_cards(recs: DataFrame, preds: DataFrame, items: DataFrame) -> DataFrame:
    """Rank, name, year, first genres, predicted rating and its percentage bar."""
    j = item_lookup(recs.select(USER, "rank", ITEM), items).join(preds.select(USER, ITEM, "prediction"), [USER, ITEM], "left")
    return j.select(USER, "rank", ITEM, "name", "year", tags(F.col("genres")).alias("tags"),
                    "prediction", score_percent(F.col("prediction")).alias("score_pct"))


def user_cards(train: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Gender and age labels, ratings count, mean, favourite genre and
    favourite title (highest rating, then smallest item id)."""
    stats = train.groupBy(USER).agg(F.count(F.lit(1)).alias("n_ratings"),
                                    F.avg(F.col(RATING).cast("double")).alias("mean_rating"))
    top = user_top_genres(train, items, 1).select(USER, F.col("genre").alias("top_genre"))
    best = favourite_items(train, items, 1).select(USER, F.col("name").alias("_best"))
    return (users.select(USER, "gender", "age").join(stats, USER, "left").join(top, USER, "left").join(best, USER, "left")
            .select(USER, F.coalesce(_lookup(GENDER_LABELS, F.col("gender")), F.lit("")).alias("gender_label"),
                    F.coalesce(_lookup(AGE_LABELS, F.col("age")), F.lit("")).alias("age_label"),
                    F.coalesce(F.col("n_ratings"), F.lit(0)).cast("bigint").alias("n_ratings"),
                    "mean_rating", F.coalesce(F.col("top_genre"), F.lit("—")).alias("top_genre"),
                    F.coalesce(F.col("_best"), F.lit("—")).alias("favourite_title")))


def favourite_items(train: DataFrame, items: DataFrame, n: int = 8) -> DataFrame:
    """A user's top-n rated titles (rating desc, item id)."""
    top = topk(train.select(USER, ITEM, RATING), n, by=USER, order=[F.col(RATING).desc(), F.col(ITEM).asc()])
    return item_lookup(top, items).select(USER, "rank", ITEM, "name", "year", RATING, "genres")


def discover(items: DataFrame, ratings: DataFrame, genre: str | None = None, keyword: str | None = None,
             sort: str = "popular", page: int = 0, size: int = PAGE_SIZE) -> tuple[DataFrame, DataFrame]:
    """C4 (J3, P5-P7, W12): filtered, sorted, paginated catalogue and its totals.

    Genre matching is on whole genre names (the reference's substring match lets
    "Music" match "Musical"). Sort modes: popular (count desc), mean (count >= 20,
    mean desc), newest (release year desc); ties by item id."""
    pop = ratings.groupBy(ITEM).agg(F.count(F.lit(1)).alias("n_ratings"), F.avg(F.col(RATING).cast("double")).alias("_m"))
    f = (items.join(pop, ITEM, "left")
         .withColumn("n_ratings", F.coalesce(F.col("n_ratings"), F.lit(0)).cast("bigint"))
         .withColumn("mean_rating", F.coalesce(F.round("_m", 1), F.lit(0.0))).drop("_m"))
    if genre:
        f = f.filter(F.array_contains(genre_list(F.col("genres")), genre))
    if keyword:
        f = f.filter(F.lower(F.col("title")).contains(keyword.lower()))
    if sort == "mean":
        f = f.filter(F.col("n_ratings") >= 20)
        order = [F.col("mean_rating").desc(), F.col(ITEM).asc()]
    elif sort == "newest":
        order = [F.col("release_year").desc_nulls_last(), F.col(ITEM).asc()]
    else:
        order = [F.col("n_ratings").desc(), F.col(ITEM).asc()]
    page_df = (f.orderBy(*order).offset(page * size).limit(size)
               .select(ITEM, "title", "genres", "release_year", "n_ratings", "mean_rating"))
    totals = f.agg(F.count(F.lit(1)).alias("n_total")).select(
        F.col("n_total").cast("bigint"),
        F.greatest(F.lit(1), F.floor((F.col("n_total") - 1) / size)).cast("bigint").alias("last_page"))
    return page_df, totals


def explain(recs: DataFrame, train: DataFrame, items: DataFrame) -> DataFrame:
    """The recommended item's genre most frequent in the user's history
    (ties by name), else a generic reason."""
    counts = user_genre_counts(train, items)
    ig = items.select(ITEM, F.explode(genre_list(F.col("genres"))).alias("genre"))
    # A table of lists is some bytes a user when compressed: by its file size it would be broadcast, at any number of users.
    cand = recs.select(USER, "rank", ITEM).hint("merge").join(ig, ITEM).join(counts, [USER, "genre"])
    best = topk(cand, 1, by=[USER, ITEM], order=[F.col("n").desc(), F.col("genre").asc()], rank_col="_r")
    best = best.select(USER, ITEM, "genre")
    return (recs.select(USER, "rank", ITEM).join(best, [USER, ITEM], "left")
            .select(USER, "rank", ITEM, F.when(F.col("genre").isNotNull(),
                                                F.concat(F.lit("your favourite genre: "), F.col("genre")))
                    .otherwise(F.lit(GENERIC_REASON)).alias("reason")))


def preset_preferences(spark) -> DataFrame:
    """The preset bundles as (profile_id, bundle, genre) rows."""
    rows = [(i, name, g) for i, (name, gs) in enumerate(PRESET_BUNDLES) for g in gs]
    return spark.createDataFrame(rows, "profile_id long, bundle string, genre string")


def onboarding(model, prefs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Questionnaire recommendations (M13) as cards: rank, name, year, genres."""
    from ..models import coldstart
    recs = coldstart.recommend_for_preferences(model, prefs, k)
    cards = item_lookup(recs.withColumnRenamed("profile_id", USER), items)
    return cards.select(F.col(USER).alias("profile_id"), "rank", ITEM, "name", "year", "genres", "score")
