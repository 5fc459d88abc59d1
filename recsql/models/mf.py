"""M5/M6: biased matrix factorisation trained by stratified distributed SGD
(DSGD, Gemulla et al. 2011).

Users and items are hashed into ``n_strata`` blocks (a constant, whatever the
data or the session). An epoch has as many sub-epochs; in sub-epoch s the
blocks (b, b + s mod n_strata) share no user and no item, so they are trained
in parallel, one co-group each: the block pair's factors and its ratings. A
mini-batch adds lr times its gradient, taken at the batch's start:

    e = r - (mu + b_u + b_i + p_u . q_i)
    [p_u, b_u] += lr * ([e q_i, e] - reg [p_u, b_u]),  and likewise [q_i, b_i].

A side is one matrix with the bias as its last column; a batch's gradients are
summed per id by sorted segments and added once. Factors and ratings travel packed, a few
rows of arrays a block (``CHUNK`` ids or ratings each). Each group returns all factors
of its two blocks, so the union of the groups is the complete new state, which
is written every ``SUB_EPOCHS_PER_PLAN`` sub-epochs, however many strata there
are. ``batch_size=None`` takes a block pair's ratings as one batch: its gradient
is one sum per id, which joins and an aggregation over all block pairs give, so no
task holds a block."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.blocked import spread_column, spread_keys
from ..schemas import ITEM, RATING, USER
from ..session import Steps, delete_path, ensure_checkpoint_dir, materialize
from .factors import FactorModel, dot, init_vectors, md5_int
from .factors import predict as _predict
from .factors import recommend as _recommend
from .popularity import global_mean, seen_pairs

CHUNK = 16_384  # ids or ratings of a packed row
_STATE = "kind string, b int, ids binary, vb binary"  # vb: float64 bytes of the vectors, each with its bias
_RATED = "_k long, _s int, part int, uids binary, iids binary, r binary"
SUB_EPOCHS_PER_PLAN = 8


def _block(col: str, n_strata: int):
    return F.pmod(md5_int(F.concat(F.lit("b|"), F.col(col).cast("string"))), F.lit(n_strata)).cast("int")


def _encode(df: DataFrame) -> DataFrame:
    """array<double> vectors and biases -> packed rows of bytes (the training state)."""
    def enc(batches):
        for pdf in batches:
            for (kind, b), g in pdf.groupby(["kind", "b"]):
                table = np.column_stack([np.stack(list(g["vec"])), g["bias"]])
                yield pd.DataFrame({"kind": [kind], "b": [b], "ids": [g["id"].to_numpy(np.int64).tobytes()], "vb": [table.tobytes()]})
    return df.select("kind", "b", "id", "vec", "bias").mapInPandas(enc, _STATE)


def _decode(df: DataFrame, k: int) -> DataFrame:
    """bytes -> array<double> vectors and biases (the public factor tables)."""
    def dec(batches):
        for pdf in batches:
            for kind, ids, vb in zip(pdf["kind"], pdf["ids"], pdf["vb"], strict=True):
                m = np.frombuffer(vb, dtype=np.float64).reshape(-1, k + 1)
                yield pd.DataFrame({"kind": kind, "id": np.frombuffer(ids, np.int64), "vec": list(m[:, :k]), "bias": m[:, k]})
    return df.select("kind", "ids", "vb").mapInPandas(dec, "kind string, id long, vec array<double>, bias double")


def _pack_ratings(pdf: pd.DataFrame) -> pd.DataFrame:
    """Ratings of a block pair by (user, item, rating), ``CHUNK`` to a row."""
    u, i, r = pdf["uid"].to_numpy(np.int64), pdf["iid"].to_numpy(np.int64), pdf["r"].to_numpy(np.float64)
    order = np.lexsort((r, i, u))
    u, i, r = u[order], i[order], r[order]
    cuts = range(0, len(u), CHUNK)
    return pd.DataFrame({"_k": int(pdf["_k"].iloc[0]), "_s": int(pdf["_s"].iloc[0]), "part": list(range(len(cuts))),
                         **{n: [x[j:j + CHUNK].tobytes() for j in cuts] for n, x in (("uids", u), ("iids", i), ("r", r))}})


class _Side:
    """The factors of one block: rows of [vector, bias] by sorted id."""

    def __init__(self, pdf: pd.DataFrame, width: int):
        ids = np.frombuffer(b"".join(pdf["ids"]), np.int64)
        order = np.argsort(ids)
        self.ids = ids[order]
        self.table = np.frombuffer(b"".join(pdf["vb"]), np.float64).reshape(-1, width)[order]

    def packed(self, kind: str, block: int) -> list[tuple]:
        return [(kind, block, self.ids[j:j + CHUNK].tobytes(), self.table[j:j + CHUNK].tobytes())
                for j in range(0, len(self.ids), CHUNK)]

    def rows(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ids, ids)

    def add(self, rows: np.ndarray, change: np.ndarray) -> None:
        """Add each row's changes; those of a row that comes more than once are summed first."""
        by_row = np.argsort(rows, kind="stable")
        again = np.diff(rows[by_row], prepend=-1) == 0
        again[:-1] |= again[1:]
        if again.any():
            some = by_row[again]
            heads = np.flatnonzero(np.diff(rows[some], prepend=-1))
            summed = np.add.reduceat(change[some], heads, axis=0)
            change[some[heads]] = summed
            by_row = np.concatenate([by_row[~again], some[heads]])
            rows, change = rows[by_row], change[by_row]
        self.table[rows] += change


def _train_block(k: int, mu: float, lr: float, reg: float, batch: int, seed: int, turn: int,
                 blocks: dict[int, int], shift: int):
    """``blocks``: the user block of a group key; its item block lies ``shift`` on."""
    def fn(key, state: pd.DataFrame, ratings: pd.DataFrame) -> pd.DataFrame:
        is_user = (state["kind"] == "U").to_numpy()
        users, items = (_Side(state[m], k + 1) for m in (is_user, ~is_user))
        g = blocks[int(key[0])]
        ratings = ratings.sort_values("part")
        uid, iid, r = (np.frombuffer(b"".join(ratings[c]), t) for c, t in (("uids", np.int64), ("iids", np.int64), ("r", np.float64)))
        # Rows lie sorted, whatever the shuffle's order was; a retried task replays the same steps.
        order = np.random.default_rng([seed, turn, g if len(r) else 0]).permutation(len(r))
        u, i, r = users.rows(uid)[order], items.rows(iid)[order], r[order]
        for lo in range(0, len(r), batch):
            part = slice(lo, lo + batch)
            a, b = users.table[u[part]], items.table[i[part]]
            e = r[part] - mu - a[:, k] - b[:, k] - np.einsum("ij,ij->i", a[:, :k], b[:, :k])
            to_a, to_b = b * (lr * e)[:, None], a * (lr * e)[:, None]
            to_a[:, k] = to_b[:, k] = lr * e
            a *= lr * reg
            b *= lr * reg
            to_a -= a
            to_b -= b
            users.add(u[part], to_a)
            items.add(i[part], to_b)
        rows = users.packed("U", g) + items.packed("I", (g + shift) % len(blocks))
        return pd.DataFrame(rows, columns=["kind", "b", "ids", "vb"])
    return fn


def _full_batch(state: DataFrame, rows: DataFrame, mu: float, lr: float, reg: float, k: int) -> DataFrame:
    """One step over all block pairs of a stratum, which share no user and no item."""
    a = state.filter(F.col("kind") == "U").select(F.col("id").alias("uid"), F.col("vec").alias("p"), F.col("bias").alias("bu"))
    b = state.filter(F.col("kind") == "I").select(F.col("id").alias("iid"), F.col("vec").alias("q"), F.col("bias").alias("bi"))
    met = rows.select("uid", "iid", "r").join(a, "uid").join(b, "iid").withColumn(
        "e", F.col("r") - F.lit(mu) - F.col("bu") - F.col("bi") - dot(F.col("p"), F.col("q")))
    both = F.array(F.struct(F.lit("U").alias("kind"), F.col("uid").alias("id"), F.col("q").alias("v")),
                   F.struct(F.lit("I").alias("kind"), F.col("iid").alias("id"), F.col("p").alias("v")))
    sums = (met.select("e", F.explode(both).alias("t")).groupBy("t.kind", "t.id")
            .agg(F.array(*[F.sum(F.col("e") * F.col("t.v")[j]) for j in range(k)]).alias("_g"),
                 F.sum("e").alias("_e"), F.count(F.lit(1)).alias("_n")))
    old = state.join(sums, ["kind", "id"], "left")
    vec = F.zip_with("vec", "_g", lambda x, g: x + F.lit(lr) * (g - F.lit(reg) * F.col("_n") * x))
    bias = F.col("bias") + F.lit(lr) * (F.col("_e") - F.lit(reg) * F.col("_n") * F.col("bias"))
    return old.select("kind", "id", F.coalesce(vec, "vec").alias("vec"), F.coalesce(bias, "bias").alias("bias"))


def fit(train: DataFrame, items: DataFrame | None = None, n_factors: int = 50, n_epochs: int = 20,
        lr: float = 0.005, reg: float = 0.02, seed: int = 42, batch_size: int | None = 2048,
        n_strata: int = 4, init: str = "generator", **_params) -> FactorModel:
    """``n_strata``: blocks per side and parallel tasks per sub-epoch; it sets
    the order of the SGD steps and so belongs to the model's definition (take
    more for larger data; at least 2)."""
    if n_strata < 2:
        raise ValueError("n_strata must be at least 2")
    spark, nb = train.sparkSession, int(n_strata)
    r = train.select(USER, ITEM, RATING)
    mu_df = materialize(global_mean(r))
    mu = float(mu_df.first()["mu"])
    spread = spread_keys(spark, nb)
    # Ratings are written once, by stratum s = (item block - user block) mod n:
    # a sub-epoch reads only its own (partition pruning).
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/dsgd-ratings-{uuid.uuid4().hex}"
    ub, ib = _block(USER, nb), _block(ITEM, nb)
    rated = r.select(F.col(USER).alias("uid"), F.col(ITEM).alias("iid"), F.col(RATING).cast("double").alias("r"),
                     ub.alias("g"), F.pmod(ib - ub, F.lit(nb)).alias("_s"))
    if batch_size:
        # A rating without a user or an item lies in no stratum: it is not trained on.
        rated = rated.filter(F.col("_s").isNotNull()).withColumn("_k", spread_column("g", spread)).repartition(nb * nb, "_k", "_s")
        rated = rated.groupBy("_k", "_s").applyInPandas(_pack_ratings, _RATED)
    rated.write.partitionBy("_s").parquet(path)
    rated = spark.read.parquet(path)
    start = (init_vectors(r, USER, n_factors, seed, 1, source=init).select(F.lit("U").alias("kind"), F.col(USER).alias("id"), "vec", "bias")
             .unionByName(init_vectors(r, ITEM, n_factors, seed, 2, source=init)
                          .select(F.lit("I").alias("kind"), F.col(ITEM).alias("id"), "vec", "bias")))
    steps = Steps(spark)
    state = steps.write(_encode(start.withColumn("b", F.coalesce(_block("id", nb), F.lit(0)))) if batch_size else start)
    turns = [(epoch, s) for epoch in range(int(n_epochs)) for s in range(nb)]
    for turn, (_, s) in enumerate(turns):
        if not batch_size:
            state = steps.write(_full_batch(state, rated.filter(F.col("_s") == s), mu, lr, reg, n_factors))
            continue
        block = F.when(F.col("kind") == "U", F.col("b")).otherwise(F.pmod(F.col("b") - F.lit(s), F.lit(nb)))
        facts = state.withColumn("g", block).withColumn("_k", spread_column("g", spread)).drop("g")
        rows = rated.filter(F.col("_s") == s).select("_k", "part", "uids", "iids", "r")
        # One block pair per task: both sides partitioned on a key whose hash
        # partition is the block itself (a fixed count, so AQE does not merge).
        train_block = _train_block(n_factors, mu, lr, reg, batch_size, seed, turn, {key: g for g, key in enumerate(spread)}, s)
        state = facts.repartition(nb, "_k").groupBy("_k").cogroup(rows.repartition(nb, "_k").groupBy("_k")).applyInPandas(train_block, _STATE)
        if (turn + 1) % SUB_EPOCHS_PER_PLAN == 0 or turn == len(turns) - 1:
            state = steps.write(state)
    # A missing id is the smallest long, as in the tables of the batched training.
    final = materialize(_decode(state, n_factors) if batch_size
                        else state.withColumn("id", F.coalesce("id", F.lit(-(1 << 63)))))
    delete_path(spark, path)
    steps.drop()
    users = final.filter(F.col("kind") == "U").select(F.col("id").alias(USER), "vec", "bias")
    its = final.filter(F.col("kind") == "I").select(F.col("id").alias(ITEM), "vec", "bias")
    return FactorModel(mu_df, users, its, seen_pairs(r), users.count(), its.count(),
                       dict(n_factors=n_factors, n_epochs=n_epochs, lr=lr, reg=reg, seed=seed,
                            batch_size=batch_size, n_strata=nb, init=init))


predict = _predict
recommend = _recommend
