"""Hybrid of biased MF and content.

predict = alpha * mf + (1 - alpha) * content. recommend: both sides scored
(clipped) over every candidate (MF items union catalogue), min-max normalised
per user over *all* candidates (seen included, 0 if the range < 1e-9), fused,
seen removed, top k. Two blocked passes: per-user min/max, then fused top-k.
Missing factors or profiles are zero vectors, which reproduces every fallback
(mu + b_i for a new user, mu + b_u for a new item, mu without a profile)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.blocked import SparseRows, blocked_topk, blocked_user_stats, sparse_dot, sparse_rows, sparse_vectors
from ..schemas import ITEM, USER
from . import content, mf
from ..session import materialize, stored
from .factors import FactorModel

RANGE_EPS = 1e-9  # fixed value: degenerate min-max range


@dataclass
class HybridModel:
    cf: FactorModel
    content: content.ContentModel
    alpha: float
    mu: float


def fit(train: DataFrame, items: DataFrame, alpha: float = 0.6, cf_params: dict | None = None,
        content_params: dict | None = None, **_params) -> HybridModel:
    cf = mf.fit(train, items, **(cf_params or {}))
    ct = content.fit(train, items, **(content_params or {}))
    return HybridModel(cf, ct, float(alpha), float(cf.mu.first()["mu"]))


def predict(m: HybridModel, pairs: DataFrame) -> DataFrame:
    once = pairs.select(USER, ITEM).distinct()
    a = mf.predict(m.cf, once).withColumnRenamed("prediction", "_cf")
    b = content.predict(m.content, once).withColumnRenamed("prediction", "_ct")
    ab = a.join(b, [USER, ITEM])
    return (pairs.join(ab, [USER, ITEM], "left")
            .withColumn("prediction", F.lit(m.alpha) * F.col("_cf") + F.lit(1 - m.alpha) * F.col("_ct"))
            .drop("_cf", "_ct"))


def _vectors(m: HybridModel, users: DataFrame):
    k = int(m.cf.params["n_factors"])
    u = users.select(USER).distinct()
    cfu = m.cf.users.select(USER, F.concat(F.col("vec"), F.array(F.lit(1.0), F.lit(m.mu) + F.col("bias"))).alias("_c"))
    ctu = sparse_vectors(m.content.profiles, USER).withColumnRenamed("vec", "_t")
    zc = F.concat(F.array_repeat(F.lit(0.0), k), F.array(F.lit(1.0), F.lit(m.mu)))
    zt = F.array().cast("array<double>")
    uv = (u.join(cfu, USER, "left").join(ctu, USER, "left")
          .select(USER, F.concat(F.coalesce("_c", zc), F.coalesce("_t", zt)).alias("vec")))
    cands = m.cf.items.select(ITEM).unionByName(m.content.catalogue.select(ITEM)).distinct()
    cfi = m.cf.items.select(ITEM, F.concat(F.col("vec"), F.array(F.col("bias"), F.lit(1.0))).alias("_c"))
    cti = content.item_vectors(m.content).withColumnRenamed("vec", "_t")
    zci = F.array_repeat(F.lit(0.0), k + 2)
    iv = (cands.join(cfi, ITEM, "left").join(cti, ITEM, "left")
          .select(ITEM, F.concat(F.coalesce("_c", zci), F.coalesce("_t", zt)).alias("vec")))
    return uv, iv, k + 2


def _sides(kc: int, mu: float):
    def cf(U: SparseRows, I: SparseRows):
        S = U.dense[:, -kc:] @ I.dense[:, -kc:].T
        return np.clip(S, 1.0, 5.0, out=S)

    def ct(U: SparseRows, I: SparseRows):
        S = sparse_dot(U, I)
        S += mu
        return np.clip(S, 1.0, 5.0, out=S)
    return cf, ct


def _mm(S, lo, hi):
    rng = hi - lo
    S -= lo[:, None]
    S /= np.where(rng < RANGE_EPS, 1.0, rng)[:, None]
    S[rng < RANGE_EPS] = 0.0
    return S


def recommend(m: HybridModel, users: DataFrame, k: int = 10) -> DataFrame:
    uv, iv, kc = _vectors(m, users)
    uv, iv = materialize(uv), materialize(iv)  # used by both passes
    n_users, n_items = uv.count(), iv.count()
    cf, ct = _sides(kc, m.mu)

    def both(U, I):
        return [cf(U, I), ct(U, I)]
    both.n_outputs = 2
    # One pass for both sides' min/max, written: it scores all pairs and is not to be run again.
    st = stored(blocked_user_stats(uv, iv, both, n_users=n_users, n_items=n_items, pack=sparse_rows(kc)))
    uvs = uv.join(st, USER).select(USER, F.concat(F.array("lo0", "hi0", "lo1", "hi1"), "vec").alias("vec"))
    alpha = m.alpha

    def fused(U: SparseRows, I: SparseRows):
        lo1, hi1, lo2, hi2 = U.dense[:, :4].T
        a, b = _mm(cf(U, I), lo1, hi1), _mm(ct(U, I), lo2, hi2)
        a *= alpha
        b *= 1 - alpha
        a += b
        return a

    # Both sides of a block have the same number of leading values.
    ivs = iv.select(ITEM, F.concat(F.array_repeat(F.lit(0.0), 4), "vec").alias("vec"))
    return blocked_topk(uvs, ivs, m.cf.seen, k, score_fn=fused, n_users=n_users, n_items=n_items, pack=sparse_rows(kc + 4))
