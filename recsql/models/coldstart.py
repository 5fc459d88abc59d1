"""Cold-start routing: users with a content profile get content
recommendations (popularity if that list is empty), everyone else popularity."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from ..schemas import ITEM, USER
from ..session import stored
from . import content, popularity


@dataclass
class ColdStartModel:
    content: content.ContentModel
    popularity: popularity.PopularityModel


def fit(train: DataFrame, items: DataFrame, like_threshold: float = 4.0, **_params) -> ColdStartModel:
    return ColdStartModel(content.fit(train, items, like_threshold), popularity.fit(train, items))


def predict(m: ColdStartModel, pairs: DataFrame) -> DataFrame:
    known = pairs.join(m.content.profile_users, USER, "left_semi")
    unknown = pairs.join(m.content.profile_users, USER, "left_anti")
    return content.predict(m.content, known).unionByName(popularity.predict(m.popularity, unknown))


def route(content_recs: DataFrame, popularity_recs: DataFrame, users: DataFrame) -> DataFrame:
    """Users with a content list keep it; every other user gets the popularity list."""
    u = users.select(USER).distinct()
    ct = content_recs.join(u, USER, "left_semi")
    rest = u.join(ct.select(USER).distinct(), USER, "left_anti")
    return ct.unionByName(popularity_recs.join(rest, USER, "left_semi"))


def recommend(m: ColdStartModel, users: DataFrame, k: int = 10) -> DataFrame:
    u = users.select(USER).distinct()
    ct = stored(content.recommend(m.content, u.join(m.content.profile_users, USER, "left_semi"), k))
    return route(ct, popularity_of_rest(m.popularity, ct, u, k), u)


def popularity_of_rest(m: popularity.PopularityModel, content_recs: DataFrame, users: DataFrame, k: int) -> DataFrame:
    """The popularity list of the users without a content list, read off their history alone."""
    rest = stored(users.select(USER).distinct().join(content_recs.select(USER).distinct(), USER, "left_anti"))
    return stored(popularity.recommend(replace(m, seen=stored(m.seen.join(rest, USER, "left_semi"))), rest, k))


def recommend_for_preferences(m: ColdStartModel, prefs: DataFrame, k: int = 10,
                              exclude: DataFrame | None = None) -> DataFrame:
    """M13 with the popularity list of an unknown user as the fallback."""
    return content.recommend_for_preferences(m.content, prefs, k, exclude, fallback=_global(m, k))


def _global(m: ColdStartModel, k: int) -> DataFrame:
    from pyspark.sql import functions as F
    return m.popularity.ranked.filter(F.col("pos") <= k).select(F.col("pos").cast("int").alias("rank"), ITEM, "score")
