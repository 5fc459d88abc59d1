"""M7/M8: biased alternating least squares.

Half-step for users (mirrored for items), with the other side fixed:
``t = r - mu - b_other``; ``(Q^T Q + reg I) p = Q^T t``; ``b = mean(t - Q p)``.
Everything needed is additive per id (sum q q^T, sum q t, sum t, sum q, n),
and ids are hashed into blocks. A block's ratings are packed once, one row of arrays
a block, with the ids of the other side that they need (``packed_side``). A half-step
sends every factor once to each block that needs it and solves a block in one task with
batched NumPy. Ids with more than ``HOT_ROWS`` ratings go row by row instead
(``half_step``): dealt over slots, summed there first, and only their sums meet. Factor
tables are written after each half-step to cut the lineage; only the last two stay.

``fit_ml`` is the pyspark.ml ALS variant (no biases, regularisation scaled by
the number of ratings), exposed separately because it is a different model."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.blocked import spread_column, spread_keys
from ..plans.ranking import global_positions
from ..schemas import ITEM, RATING, USER
from ..session import Steps, ensure_checkpoint_dir, materialize
from .factors import FactorModel, init_vectors
from .factors import predict as _predict
from .factors import recommend as _recommend
from .popularity import global_mean, seen_pairs

HOT_ROWS = 65_536  # ratings of one id summed in one place
RUNNING_ROWS = 4_096  # rows and partials of one id kept before they are added up
BLOCK_RATINGS = 500_000  # ratings of a block, about
LEAST_RATINGS, BLOCKS = 20_000, 24  # smaller blocks are not worth a task; as many while tables are small
SOLVE_IDS, SOLVE_ROWS = 1024, 32_768  # ids and ratings solved at once
ML_CHECKPOINT = 2  # iterations of pyspark.ml's ALS between checkpoints, at which its shuffle files go
_MISSING = -(1 << 63)  # what a missing id becomes
_PACKED = "_k long, to int, ids binary, counts binary, at binary, r binary"  # to -1: ratings; else ids that block ``to`` gives
_STATE = "b int, ids binary, vb binary"  # vb: float64 vectors, each followed by its bias
_PARTIAL = "id long, vb binary, t double, a binary, c binary, st double, sq binary, n long"
_SOLVED = "id long, vb binary, bias double"  # vb: float64 vector bytes (loop state)


def _bytes_rows(m: np.ndarray) -> list:
    raw, step = np.ascontiguousarray(m, dtype=np.float64).tobytes(), m.shape[1] * 8
    return [raw[j * step:(j + 1) * step] for j in range(m.shape[0])]


def _mat(col, k2: int) -> np.ndarray:
    return np.frombuffer(b"".join(col), dtype=np.float64).reshape(-1, k2)


def _fold(ids: np.ndarray, Q: np.ndarray, t: np.ndarray, k: int):
    """Per-id sums (sum qq^T, sum qt, sum t, sum q, n) of id-sorted rows,
    in bounded chunks of the k*k outer-product buffer."""
    starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    out_ids, A, C, ST, SQ, N = [], [], [], [], [], []
    for lo in range(0, len(ids), 1024):
        hi = min(len(ids), lo + 1024)
        cut = np.unique(np.r_[lo, starts[(starts > lo) & (starts < hi)]])
        Qc, tc = Q[lo:hi], t[lo:hi]
        seg = cut - lo
        A.append(np.add.reduceat(np.einsum("ni,nj->nij", Qc, Qc).reshape(hi - lo, k * k), seg, axis=0))
        C.append(np.add.reduceat(Qc * tc[:, None], seg, axis=0))
        ST.append(np.add.reduceat(tc, seg))
        SQ.append(np.add.reduceat(Qc, seg, axis=0))
        N.append(np.diff(np.r_[seg, hi - lo]))
        out_ids.append(ids[cut])
    return (np.concatenate(out_ids), np.concatenate(A), np.concatenate(C), np.concatenate(ST),
            np.concatenate(SQ), np.concatenate(N))


def _partials(k: int):
    """Map side: ids with at least k rows in a batch are folded into one
    partial (k*k values, smaller than their k-wide rows: this is what keeps a
    popular id from shipping all its rows); other rows travel as they are."""
    def fn(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            pdf = pdf.sort_values("id", kind="stable")
            ids = pdf["id"].to_numpy(np.int64)
            counts = np.unique(ids, return_counts=True)
            heavy = np.isin(ids, counts[0][counts[1] >= k])
            Q = _mat(pdf["vb"].to_numpy(), k)
            t = pdf["t"].to_numpy(np.float64)
            parts = []
            if heavy.any():
                parts.append(_partial_rows(*_fold(ids[heavy], Q[heavy], t[heavy], k)))
            if (~heavy).any():
                light = pdf[~heavy]
                parts.append(pd.DataFrame({"id": light["id"].to_numpy(np.int64), "vb": light["vb"].to_numpy(),
                                           "t": light["t"].to_numpy(np.float64), "a": None, "c": None,
                                           "st": np.nan, "sq": None, "n": 0}))
            yield pd.concat(parts, ignore_index=True)
    return fn


def _sums(pdf: pd.DataFrame, k: int):
    """Sums per id of raw rows and partials, ids sorted."""
    raw, agg = pdf[pdf["a"].isna()].sort_values("id", kind="stable"), pdf[pdf["a"].notna()]
    pieces = []
    if len(raw):
        pieces.append(_fold(raw["id"].to_numpy(np.int64), _mat(raw["vb"].to_numpy(), k), raw["t"].to_numpy(np.float64), k))
    if len(agg):
        pieces.append((agg["id"].to_numpy(np.int64), _mat(agg["a"].to_numpy(), k * k), _mat(agg["c"].to_numpy(), k),
                       agg["st"].to_numpy(np.float64), _mat(agg["sq"].to_numpy(), k), agg["n"].to_numpy(np.float64)))
    ids, *sums = (np.concatenate([p[j] for p in pieces]) for j in range(6))
    o = np.argsort(ids, kind="stable")
    ids = ids[o]
    starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    return ids[starts], *(np.add.reduceat(x[o].astype(np.float64), starts, axis=0) for x in sums)


def _partial_rows(ids, A, C, ST, SQ, N) -> pd.DataFrame:
    return pd.DataFrame({"id": ids, "vb": None, "t": np.nan, "a": _bytes_rows(A), "c": _bytes_rows(C), "st": ST,
                         "sq": _bytes_rows(SQ), "n": np.asarray(N, dtype=np.int64)})


def _solver(k: int, reg: float):
    eye = np.eye(k)

    def finish(rows: list[pd.DataFrame]) -> pd.DataFrame:
        ids, A, C, ST, SQ, N = _sums(pd.concat(rows, ignore_index=True), k)
        P = np.linalg.solve(A.reshape(-1, k, k) + reg * eye, C[:, :, None])[:, :, 0]
        bias = (ST - np.einsum("ij,ij->i", SQ, P)) / N
        return pd.DataFrame({"id": ids, "vb": _bytes_rows(P), "bias": bias})

    def fn(batches):
        pending: list[pd.DataFrame] = []
        for pdf in batches:
            if pdf.empty:
                continue
            last = pdf["id"].iloc[-1]
            done = pdf[pdf["id"] != last]
            if len(done):
                yield finish(pending + [done])
                pending = []
            pending.append(pdf[pdf["id"] == last])
            if sum(map(len, pending)) > RUNNING_ROWS:  # one id goes on and on: keep its running sums
                pending = [_partial_rows(*_sums(pd.concat(pending, ignore_index=True), k))]
        if pending:
            yield finish(pending)
    return fn


def _encode(df: DataFrame) -> DataFrame:
    """(id, vec array<double>, bias) -> (id, vb float64 bytes, bias)."""
    def enc(batches):
        for pdf in batches:
            pdf["vb"] = [np.asarray(v, dtype=np.float64).tobytes() for v in pdf.pop("vec")]
            yield pdf[["id", "vb", "bias"]]
    return df.select("id", "vec", "bias").mapInPandas(enc, _SOLVED)


def _decode(df: DataFrame, k: int) -> DataFrame:
    """(id, vb, bias) -> (id, vec array<double>, bias): the public factor table."""
    def dec(batches):
        for pdf in batches:
            m = np.frombuffer(b"".join(pdf.pop("vb").to_numpy()), dtype=np.float64).reshape(-1, k)
            pdf["vec"] = list(m)
            yield pdf[["id", "vec", "bias"]]
    return df.select("id", "vb", "bias").mapInPandas(dec, "id long, vec array<double>, bias double")


def hot_ids(ratings: DataFrame, key: str) -> DataFrame | None:
    """(id, slots) of ids with more than HOT_ROWS ratings: into how many slots
    their rows are dealt before they are summed. None: there are none."""
    n = F.count(F.lit(1))
    hot = materialize(ratings.groupBy(F.col(key).alias("id")).agg(F.ceil(n / F.lit(HOT_ROWS)).alias("slots")).filter("slots > 1"))
    return None if hot.isEmpty() else hot


def _solved_rows(ratings: DataFrame, fixed: DataFrame, self_key: str, other_key: str, mu: float,
                 k: int, reg: float, hot: DataFrame | None) -> DataFrame:
    j = ratings.join(fixed.select(F.col("id").alias(other_key), "vb", F.col("bias").alias("_b")), other_key)
    rows = j.select(F.col(self_key).alias("id"), "vb", F.xxhash64(other_key).alias("_h"),
                    (F.col(RATING).cast("double") - F.lit(mu) - F.col("_b")).alias("t"))
    plain = rows if hot is None else rows.join(hot, "id", "left_anti")
    part = plain.select("id", "vb", "t").mapInPandas(_partials(k), _PARTIAL)
    if hot is not None:  # a hot id's rows meet in its slots first, and only their sums meet in one task
        dealt = rows.join(hot, "id").withColumn("slot", F.pmod("_h", "slots")).repartition("id", "slot")
        part = part.unionByName(dealt.select("id", "vb", "t").mapInPandas(_partials(k), _PARTIAL))
    n_parts = ratings.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return part.repartition(int(n_parts), "id").sortWithinPartitions("id").mapInPandas(_solver(k, reg), _SOLVED)


def half_step(ratings: DataFrame, fixed: DataFrame, self_key: str, other_key: str, mu: float,
              k: int, reg: float, hot: DataFrame | None = None, steps: Steps | None = None) -> DataFrame:
    """A half-step over plain tables (id, vb, bias), rating by rating."""
    solved = _solved_rows(ratings, fixed, self_key, other_key, mu, k, reg, hot)
    return materialize(solved) if steps is None else steps.write(solved)


def _block(col, nb: int):
    return F.pmod(F.xxhash64(col), F.lit(nb)).cast("int")


def _pack_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Ratings of one block by (id, other id, rating), and per block of the other
    side the ids needed from it."""
    ids, other, r, h = (pdf[c].to_numpy(t) for c, t in (("id", np.int64), ("o", np.int64), ("r", np.float64), ("h", np.int32)))
    order = np.lexsort((r, other, ids))
    ids, other, r, h = ids[order], other[order], r[order], h[order]
    need, first = np.unique(other, return_index=True)
    own, counts = np.unique(ids, return_counts=True)
    key, from_block = int(pdf["_k"].iloc[0]), h[first]
    rows = [(key, -1, own.tobytes(), counts.astype(np.int64).tobytes(), np.searchsorted(need, other).astype(np.int32).tobytes(), r.tobytes()),
            (key, -2, need.tobytes(), None, None, None)]
    rows += [(key, int(b), need[from_block == b].tobytes(), None, None, None) for b in np.unique(from_block)]
    return pd.DataFrame(rows, columns=["_k", "to", "ids", "counts", "at", "r"])


def packed_side(ratings: DataFrame, self_key: str, other_key: str, nb: int, spread: list[int],
                hot: DataFrame | None) -> DataFrame:
    """``ratings`` packed by blocks of ``self_key``, without hot ids."""
    rows = ratings.filter(F.col(other_key).isNotNull())
    if hot is not None:
        rows = rows.join(hot.select(F.col("id").alias(self_key)), self_key, "left_anti")
    rows = rows.select(
        F.coalesce(F.col(self_key).cast("long"), F.lit(_MISSING)).alias("id"), F.col(other_key).cast("long").alias("o"),
        F.coalesce(F.col(RATING).cast("double"), F.lit(float("nan"))).alias("r")).withColumn("_g", _block("id", nb)).select(
        spread_column("_g", spread).alias("_k"), "id", "o", "r", _block("o", nb).alias("h"))
    return materialize(rows.repartition(nb, "_k").groupBy("_k").applyInPandas(_pack_block, _PACKED))


def _table(pdf: pd.DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids ascending and their rows of [vector, bias]."""
    ids = np.frombuffer(b"".join(pdf["ids"]), np.int64)
    table = np.frombuffer(b"".join(pdf["vb"]), np.float64).reshape(-1, width)
    order = np.argsort(ids, kind="stable")
    return ids[order], table[order]


def _find(ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(ids, wanted), max(0, len(ids) - 1))
    return at, (ids[at] == wanted) if len(ids) else np.zeros(len(wanted), bool)


def _sender(k: int):
    """Rows of a block that other blocks need, one packed row for each of them."""
    def fn(state: pd.DataFrame, routes: pd.DataFrame) -> pd.DataFrame:
        out = {"_k": [], "ids": [], "vb": []}
        if len(state) and len(routes):
            ids, table = _table(state, k + 1)
            for to, raw in zip(routes["_k"], routes["ids"], strict=True):
                wanted = np.frombuffer(raw, np.int64)
                at, ok = _find(ids, wanted)
                out["_k"].append(int(to))
                out["ids"].append(wanted[ok].tobytes())
                out["vb"].append(table[at[ok]].tobytes())
        return pd.DataFrame(out)
    return fn


def _solve_sorted(counts: np.ndarray, Q: np.ndarray, at: np.ndarray, r: np.ndarray, k: int, reg: float) -> np.ndarray:
    """[vector, bias] of ids whose ratings lie one after another: rating j has the
    value ``r[j]`` (mean taken off) and the other side's row ``Q[at[j]]``. Ids of equal
    counts are solved together."""
    out, eye = np.empty((len(counts), k + 1)), reg * np.eye(k)
    start = np.cumsum(counts) - counts
    for c in np.unique(counts):
        same = np.flatnonzero(counts == c)
        step = int(max(1, min(SOLVE_IDS, SOLVE_ROWS // c)))
        for j in range(0, len(same), step):
            some = same[j:j + step]
            rows = (start[some][:, None] + np.arange(c)).ravel()
            X = Q[at[rows]].reshape(len(some), c, k + 1)
            V, t = X[:, :, :k], r[rows].reshape(len(some), c) - X[:, :, k]
            Vt = V.transpose(0, 2, 1)
            P = np.linalg.solve(Vt @ V + eye, Vt @ t[:, :, None])[:, :, 0]
            out[some, :k] = P
            out[some, k] = (t.sum(axis=1) - (V.sum(axis=1) * P).sum(axis=1)) / c
    return out


def _block_solver(mu: float, k: int, reg: float, blocks: dict[int, int]):
    def fn(sent: pd.DataFrame, side: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"b": [], "ids": [], "vb": []})
        if sent.empty or side.empty:
            return out
        ids, Q = _table(sent, k + 1)
        rated, need = (side[side["to"] == t].iloc[0] for t in (-1, -2))
        own, counts = np.frombuffer(rated["ids"], np.int64), np.frombuffer(rated["counts"], np.int64)
        at, r = np.frombuffer(rated["at"], np.int32), np.frombuffer(rated["r"], np.float64) - mu
        place, ok = _find(ids, np.frombuffer(need["ids"], np.int64))
        if not ok.all():  # a rating of an id without factors does not count
            kept = ok[at]
            counts = np.bincount(np.repeat(np.arange(len(own)), counts)[kept], minlength=len(own))
            own, counts, at, r = own[counts > 0], counts[counts > 0], at[kept], r[kept]
        if not len(own):
            return out
        solved = _solve_sorted(counts, Q, place[at], r, k, reg)
        return pd.DataFrame({"b": [blocks[int(side["_k"].iloc[0])]], "ids": [own.tobytes()], "vb": [solved.tobytes()]})
    return fn


def _unpack(df: DataFrame, k: int) -> DataFrame:
    """Packed state -> (id, vb, bias)."""
    def fn(batches):
        for pdf in batches:
            for ids, vb in zip(pdf["ids"], pdf["vb"], strict=True):
                m = np.frombuffer(vb, np.float64).reshape(-1, k + 1)
                yield pd.DataFrame({"id": np.frombuffer(ids, np.int64), "vb": _bytes_rows(m[:, :k]), "bias": m[:, k]})
    return df.select("ids", "vb").mapInPandas(fn, _SOLVED)


def _pack(df: DataFrame, nb: int) -> DataFrame:
    """(id, vb, bias) -> packed state, one row a block and batch."""
    def fn(batches):
        for pdf in batches:
            for b, g in pdf.groupby("b"):
                raw = b"".join(v + np.float64(x).tobytes() for v, x in zip(g["vb"], g["bias"], strict=True))
                yield pd.DataFrame({"b": [b], "ids": [g["id"].to_numpy(np.int64).tobytes()], "vb": [raw]})
    return df.select(_block("id", nb).alias("b"), "id", "vb", "bias").mapInPandas(fn, _STATE)


def packed_step(ratings: DataFrame, side: DataFrame, state: DataFrame, self_key: str, other_key: str, mu: float,
                k: int, reg: float, nb: int, spread: list[int], hot: DataFrame | None = None) -> DataFrame:
    """One half-step: the packed state of ``self_key`` from that of ``other_key``."""
    routes = side.filter("to >= 0").select(spread_column("to", spread).alias("_from"), "_k", "ids")
    held = state.select(spread_column("b", spread).alias("_from"), "ids", "vb")
    sent = (held.repartition(nb, "_from").groupBy("_from").cogroup(routes.repartition(nb, "_from").groupBy("_from"))
            .applyInPandas(_sender(k), "_k long, ids binary, vb binary"))
    solver = _block_solver(mu, k, reg, {key: b for b, key in enumerate(spread)})
    new = (sent.repartition(nb, "_k").groupBy("_k").cogroup(side.filter("to < 0").repartition(nb, "_k").groupBy("_k"))
           .applyInPandas(solver, _STATE))
    if hot is not None:
        rows = ratings.join(hot.select(F.col("id").alias(self_key)), self_key, "left_semi")
        new = new.unionByName(_pack(_solved_rows(rows, _unpack(state, k), self_key, other_key, mu, k, reg, hot), nb))
    return new


def fit(train: DataFrame, items: DataFrame | None = None, n_factors: int = 50, reg: float = 0.1,
        n_epochs: int = 15, seed: int = 42, init: str = "generator", **_params) -> FactorModel:
    r = train.select(USER, ITEM, RATING)
    mu_df = materialize(global_mean(r))
    mu = float(mu_df.first()["mu"])
    steps = Steps(r.sparkSession, keep=2)  # a half-step reads the state before it
    n = r.count()
    nb = max(1, min(BLOCKS, -(-n // LEAST_RATINGS)), -(-n // BLOCK_RATINGS))
    spread = spread_keys(r.sparkSession, nb)
    q = steps.write(_pack(_encode(init_vectors(r, ITEM, n_factors, seed, 2, source=init).withColumnRenamed(ITEM, "id")), nb))
    p = None
    hot_users, hot_items = hot_ids(r, USER), hot_ids(r, ITEM)
    if int(n_epochs):
        by_user = packed_side(r, USER, ITEM, nb, spread, hot_users)
        by_item = packed_side(r, ITEM, USER, nb, spread, hot_items)
    for _ in range(int(n_epochs)):
        p = steps.write(packed_step(r, by_user, q, USER, ITEM, mu, n_factors, reg, nb, spread, hot_users))
        q = steps.write(packed_step(r, by_item, p, ITEM, USER, mu, n_factors, reg, nb, spread, hot_items))
    if p is None:
        p = materialize(_pack(_encode(init_vectors(r, USER, n_factors, seed, 1, source=init).withColumnRenamed(USER, "id")), nb))
    users = materialize(_decode(_unpack(p, n_factors), n_factors)).withColumnRenamed("id", USER)
    its = materialize(_decode(_unpack(q, n_factors), n_factors)).withColumnRenamed("id", ITEM)
    steps.drop()
    return FactorModel(mu_df, users, its, seen_pairs(r), users.count(), its.count(),
                       dict(n_factors=n_factors, reg=reg, n_epochs=n_epochs, seed=seed, init=init))


predict = _predict
recommend = _recommend


def fit_ml(train: DataFrame, items: DataFrame | None = None, n_factors: int = 50, reg: float = 0.1,
           n_epochs: int = 15, seed: int = 42, **_params) -> FactorModel:
    """pyspark.ml ALS (explicit feedback, no biases). It wants INT ids, so
    users and items go in by their position."""
    from pyspark.ml.recommendation import ALS
    ensure_checkpoint_dir(train.sparkSession)
    places = {key: global_positions(train.select(key).distinct(), [F.col(key).asc()], f"_{key}") for key in (USER, ITEM)}
    r = train.select(USER, ITEM, F.col(RATING).cast("float").alias(RATING))
    for key, ids in places.items():
        r = r.join(ids, key).drop(key).withColumnRenamed(f"_{key}", key)
    model = ALS(rank=n_factors, maxIter=n_epochs, regParam=reg, seed=seed, userCol=USER, itemCol=ITEM,
                ratingCol=RATING, coldStartStrategy="nan", checkpointInterval=ML_CHECKPOINT).fit(r)
    mu_df = materialize(global_mean(r).withColumn("mu", F.lit(0.0)))  # no bias terms in this variant
    users = model.userFactors.select(F.col("id").cast("long").alias(USER),
                                     F.col("features").cast("array<double>").alias("vec"), F.lit(0.0).alias("bias"))
    its = model.itemFactors.select(F.col("id").cast("long").alias(ITEM),
                                   F.col("features").cast("array<double>").alias("vec"), F.lit(0.0).alias("bias"))
    users, its = (materialize(df.withColumnRenamed(key, f"_{key}").join(places[key], f"_{key}").drop(f"_{key}"))
                  for key, df in ((USER, users), (ITEM, its)))
    return FactorModel(mu_df, users, its, seen_pairs(train), users.count(), its.count(),
                       dict(n_factors=n_factors, reg=reg, n_epochs=n_epochs, seed=seed, variant="ml"))
