"""Shared pieces of the factor models (M5-M8): tables of (id, vec, bias),
hash-seeded initialisation, predictions and blocked top-k recommendation."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clip
from ..plans.pruned import pruned_topk
from ..schemas import ITEM, USER


@dataclass
class FactorModel:
    mu: DataFrame        # one row: mu
    users: DataFrame     # user_id, vec array<double>, bias double
    items: DataFrame     # item_id, vec array<double>, bias double
    seen: DataFrame      # user_id, item_id
    n_users: int
    n_items: int
    params: dict


def md5_int(text: Column) -> Column:
    """The first 52 bits of the MD5 of a text as a whole number: the same hash
    in any engine."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def init_vectors(ids: DataFrame, key: str, k: int, seed: int, side: int, scale: float = 0.1,
                 source: str = "generator") -> DataFrame:
    """N(0, scale) vectors that depend on (seed, side, id, factor) alone, not on
    partitioning or row order: drawn from a NumPy generator keyed by them, or,
    with ``source="md5"``, by Box-Muller from hashed uniforms that any engine
    can compute."""
    if source == "generator":
        @F.pandas_udf("array<double>")
        def draw(idv: pd.Series) -> pd.Series:
            return pd.Series([np.random.default_rng([seed, side, int(i) & 0x7FFFFFFFFFFFFFFF]).normal(0.0, scale, k)
                              for i in idv])
        return ids.select(key).distinct().select(key, draw(F.col(key)).alias("vec"), F.lit(0.0).alias("bias"))

    def uniform(j, half):
        text = F.concat_ws("|", F.lit(seed), F.lit(side), F.col(key).cast("string"), j.cast("string"), F.lit(half))
        return (md5_int(text) + F.lit(0.5)) / F.lit(float(1 << 52))

    vec = F.transform(F.sequence(F.lit(1), F.lit(k)), lambda j: F.lit(scale) * F.sqrt(F.lit(-2.0) * F.log(uniform(j, "a")))
                      * F.cos(F.lit(2 * math.pi) * uniform(j, "b")))
    return ids.select(key).distinct().select(key, vec.alias("vec"), F.lit(0.0).alias("bias"))


def dot(a: Column, b: Column) -> Column:
    """dense dot product as a JVM expression."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def predict(m: FactorModel, pairs: DataFrame) -> DataFrame:
    """Both known -> clip(mu+bu+bi+p.q); one known -> clip(mu+bias); none -> mu."""
    u = m.users.select(USER, F.col("vec").alias("_p"), F.col("bias").alias("_bu"))
    i = m.items.select(ITEM, F.col("vec").alias("_q"), F.col("bias").alias("_bi"))
    j = pairs.join(u, USER, "left").join(i, ITEM, "left").crossJoin(F.broadcast(m.mu))  # one-row side
    ku, ki = F.col("_p").isNotNull(), F.col("_q").isNotNull()
    full = F.col("mu") + F.col("_bu") + F.col("_bi") + dot(F.col("_p"), F.col("_q"))
    pred = (F.when(ku & ki, clip(full)).when(ki, clip(F.col("mu") + F.col("_bi")))
            .when(ku, clip(F.col("mu") + F.col("_bu"))).otherwise(F.col("mu")))
    return j.withColumn("prediction", pred).drop("_p", "_bu", "_q", "_bi", "mu")


def augmented(m: FactorModel, users: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """[p, 1, mu + bu] . [q, bi, 1] = mu + bu + bi + p.q (the unclipped score)."""
    u = m.users if users is None else m.users.join(users.select(USER).distinct(), USER, "left_semi")
    uv = u.crossJoin(F.broadcast(m.mu)).select(  # one-row side
        USER, F.concat(F.col("vec"), F.array(F.lit(1.0), F.col("mu") + F.col("bias"))).alias("vec"))
    iv = m.items.select(ITEM, F.concat(F.col("vec"), F.array(F.col("bias"), F.lit(1.0))).alias("vec"))
    return uv, iv


def recommend(m: FactorModel, users: DataFrame, k: int = 10) -> DataFrame:
    """Unclipped mu+bu+bi+p.q over all train items minus seen; unknown users -> none."""
    uv, iv = augmented(m, users)
    return pruned_topk(uv, iv, m.seen, k, tail=2, n_items=m.n_items)


def train_rmse(m: FactorModel, ratings: DataFrame) -> float:
    """Diagnostic: RMSE of the clipped predictions on the given ratings."""
    p = predict(m, ratings.select(USER, ITEM, "rating"))
    e = F.col("rating").cast("double") - F.col("prediction")
    return float(p.agg(F.sqrt(F.avg(e * e))).first()[0])
