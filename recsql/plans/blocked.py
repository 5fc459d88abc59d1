"""Blocked all-pairs scoring with per-block top-k (user x catalogue ranking).

Ranking every catalogue item for every user is an all-pairs problem. Rows are
never crossed one by one: users and items are hashed into blocks, each
(user block, item block) pair meets in one ``applyInPandas`` group, a NumPy
matrix product scores the block tile by tile, the user's seen items *in that item block*
are masked (they arrive as packed rows routed to the same group, so a user with
a huge history is split across item blocks), and only the top k per user
leaves the task. A final ``row_number() <= k`` merges the per-block lists.

A block travels as few rows of arrays. What is shipped is users x item blocks +
items x user blocks, so blocks grow with the tables up to ``USERS_SHIPPED`` and
``ITEMS_SHIPPED``; tiles bound the scores a task holds, blocks the vectors. The number
of groups grows with the data, so the work spreads over the cluster.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import score_order, topk

USER_BLOCK = 1024   # users and items of the least block
ITEM_BLOCK = 4096
USERS_SHIPPED = 32_768  # users and items of a block, at most: what is shipped falls as blocks grow
ITEMS_SHIPPED = 32_768
USER_PARTS, ITEM_PARTS = 16, 8  # blocks a side that are wanted while tables are small
USER_TILE, ITEM_TILE = 512, 4096  # cells of a block scored at once
DENSE_TILE = 256, 2048  # the same for plain products, which cost little beside the screening
PACKED = 4096       # ids of one row, about

_OUT = "user_id long, item_id long, score double"
_MISSING = -(1 << 63)  # what a missing id becomes


def _n_blocks(n: int, size: int) -> int:
    return max(1, math.ceil(n / size))


def _block(col: str, nb: int):
    return F.pmod(F.xxhash64(F.col(col)), F.lit(nb)).cast("int")


def user_block_size(n: int, block: int | None = None, most: int = USERS_SHIPPED) -> int:
    return block or max(USER_BLOCK, min(most, math.ceil(n / USER_PARTS)))


def item_block_size(n: int, block: int | None = None, most: int = ITEMS_SHIPPED) -> int:
    return block or max(ITEM_BLOCK, min(most, math.ceil(n / ITEM_PARTS)))


def no_null_id(col: str):
    return F.coalesce(F.col(col).cast("long"), F.lit(_MISSING))


def _packed(vecs: DataFrame, key: str, block: str, nb: int, size: int) -> DataFrame:
    """(block, ids, lens, vals): vectors end to end, about ``PACKED`` ids a row.
    Rows are packed once, before they are copied to the blocks of the other side."""
    fine = vecs.select(_block(key, nb * _n_blocks(size, PACKED)).alias("_f"), no_null_id(key).alias("id"),
                       F.col("vec").cast("array<double>").alias("vec"))
    m = fine.groupBy("_f").agg(F.collect_list(F.struct("id", "vec")).alias("m"))
    return m.select((F.col("_f") % F.lit(nb)).cast("int").alias(block), F.col("m.id").alias("ids"),
                    F.transform("m", lambda x: F.size(x["vec"]).cast("long")).alias("lens"), F.flatten("m.vec").alias("vals"))


def _grouped(user_vecs: DataFrame, item_vecs: DataFrame, seen: DataFrame | None,
             nu: int, ni: int, user_block: int, item_block: int) -> DataFrame:
    """Packed rows of every pair of blocks. ``kind`` S: seen cells, the users in
    ``ids`` and the items in ``lens``."""
    ib_all = F.explode(F.sequence(F.lit(0), F.lit(ni - 1)))
    ub_all = F.explode(F.sequence(F.lit(0), F.lit(nu - 1)))
    u = _packed(user_vecs, "user_id", "_ub", nu, user_block).select("_ub", ib_all.alias("_ib"), F.lit("U").alias("kind"), "ids", "lens", "vals")
    i = _packed(item_vecs, "item_id", "_ib", ni, item_block).select(ub_all.alias("_ub"), "_ib", F.lit("I").alias("kind"), "ids", "lens", "vals")
    parts = u.unionByName(i)
    if seen is not None:
        cells = seen.select(_block("user_id", nu * _n_blocks(user_block, PACKED)).alias("_f"), _block("item_id", ni).alias("_ib"),
                            F.struct(no_null_id("user_id").alias("u"), no_null_id("item_id").alias("i")).alias("c"))
        s = cells.groupBy("_f", "_ib").agg(F.collect_list("c").alias("m")).select(
            (F.col("_f") % F.lit(nu)).cast("int").alias("_ub"), "_ib", F.lit("S").alias("kind"), F.col("m.u").alias("ids"),
            F.col("m.i").alias("lens"), F.lit(None).cast("array<double>").alias("vals"))
        parts = parts.unionByName(s)
    return parts


def spread_keys(spark, n: int) -> list[int]:
    """For partitions 0..n-1, a long key that hash partitioning sends there.

    ``repartition(n, col)`` places a row by ``pmod(hash(col), n)``; grouping
    on ``keys[g]`` instead of ``g`` gives every one of n groups its own task.
    Computed from a small range of candidates (a few rows per partition)."""
    cand = spark.range(0, max(64, 64 * n)).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("p"))
    got = {r.p: r.k for r in cand.groupBy("p").agg(F.min("id").alias("k")).collect()}
    if len(got) < n:
        return list(range(n))
    return [int(got[p]) for p in range(n)]


def spread_column(g: str, keys: list[int]):
    """``g`` (0..n-1) -> its spread key, as a literal lookup expression."""
    return F.element_at(F.create_map(*[x for i, k in enumerate(keys) for x in (F.lit(i), F.lit(k))]),
                        F.col(g).cast("int")).cast("long")


def _pinned(df: DataFrame, n_groups: int, *keys: str) -> DataFrame:
    """Hash-partition the block groups into a fixed number of partitions.

    Block groups are small in bytes but heavy in compute, so adaptive
    coalescing (which sizes by bytes) must not merge them into few tasks; an
    explicit partition count is left alone by AQE."""
    cap = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(1, min(n_groups, cap)), *keys)


def _one_group_per_task(df: DataFrame, nu: int, ni: int) -> DataFrame:
    """Adds ``_k`` for block pair (ub, ib), partitioned on it: when the pairs
    fit the partition count each gets its own task (spread keys), otherwise
    plain hashing spreads many pairs evenly."""
    spark = df.sparkSession
    n = nu * ni
    cap = int(spark.conf.get("spark.sql.shuffle.partitions"))
    g = (F.col("_ub").cast("long") * F.lit(ni) + F.col("_ib")).alias("_gi")
    df = df.withColumn("_gi", g)
    if n <= cap:
        df = df.withColumn("_k", spread_column("_gi", spread_keys(spark, n)))
    else:
        df = df.withColumn("_k", F.col("_gi"))
    return df.drop("_gi").repartition(max(1, min(n, cap)), "_k")


def _dot(U: np.ndarray, I: np.ndarray) -> np.ndarray:
    return U @ I.T


def _row_topk(key: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, col) of the first k finite entries per row under (key desc, col asc).

    A linear-time partition finds each row's k-th value; only entries at or
    above it (ties included) are sorted, so the cost is O(cells + candidates)."""
    n_rows, n_cols = key.shape
    take = min(k, n_cols)
    if take == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kth = -np.partition(-key, take - 1, axis=1)[:, take - 1]
    r, c = np.nonzero((key >= kth[:, None]) & np.isfinite(key))
    order = np.lexsort((c, -key[r, c], r))  # row, then key desc, then column (= item id) asc
    r, c = r[order], c[order]
    starts = np.searchsorted(r, np.arange(n_rows))
    rank = np.arange(len(r)) - starts[r]
    keep = rank < take
    return r[keep], c[keep]


def _stack(vecs: list):
    return np.stack(vecs) if len(vecs) else np.zeros((0, 0))


DENSE_TERMS = 512   # terms written out at once
HELD_CELLS = 1 << 20  # cells of a tile of items that stay written out, while tiles of users pass
DENSE_WORTH = 100   # multiplications of a dense product that cost as much as one sparse


@dataclass
class SparseRows:
    """Rows of ``dense`` leading values each, followed by sparse entries."""
    dense: np.ndarray
    row: np.ndarray
    idx: np.ndarray
    val: np.ndarray
    _terms: np.ndarray | None = None
    _over: tuple | None = None

    def terms(self) -> np.ndarray:
        if self._terms is None:
            self._terms = np.unique(self.idx)
        return self._terms

    def over(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows written out over some terms, and how many hold each; the last are kept."""
        if self._over is None or not np.array_equal(self._over[0], terms):
            out = _dense(self, terms)
            self._over = terms, out, np.bincount(np.searchsorted(terms, self.idx[np.isin(self.idx, terms)]), minlength=len(terms)).astype(np.float64)
        return self._over[1:]


def sparse_rows(dense: int = 0):
    """Packs vectors written by ``sparse_vectors`` behind ``dense`` plain values."""
    def pack(vecs: list) -> SparseRows:
        n = np.array([(len(v) - dense) // 2 for v in vecs], dtype=np.int64)
        flat = [np.asarray(v, dtype=np.float64) for v in vecs]
        none = [np.zeros(0)]
        return SparseRows(np.stack([v[:dense] for v in flat]) if flat else np.zeros((0, dense)),
                          np.repeat(np.arange(len(vecs)), n),
                          np.concatenate([v[dense:dense + c] for v, c in zip(flat, n, strict=True)] + none).astype(np.int64),
                          np.concatenate([v[dense + c:] for v, c in zip(flat, n, strict=True)] + none))
    return pack


_last: SparseRows | None = None


def sparse_dot(U: SparseRows, I: SparseRows) -> np.ndarray:
    """All inner products of the sparse parts. Where the terms that both sides
    hold are few for the products they give, they are written out densely, some
    at a time, and multiplied; otherwise read term by term from the entries. Memory does not
    depend on how many terms there are. Where the items' terms are few, tiles stay
    written out for the tiles that follow."""
    global _last
    terms = I.terms()
    if 0 < len(terms) <= DENSE_TERMS and len(terms) * len(I.dense) <= HELD_CELLS:
        if _last is not U:  # of users, one tile is kept
            if _last is not None:
                _last._over = None
            _last = U
        (u, nu), (i, ni) = U.over(terms), I.over(terms)
        if len(terms) * len(U.dense) * len(I.dense) <= DENSE_WORTH * (nu @ ni):
            return u @ i.T
    terms = np.intersect1d(U.idx, I.idx)
    met = np.bincount(np.searchsorted(terms, U.idx[np.isin(U.idx, terms)]), minlength=len(terms)).astype(np.float64)
    met = met @ np.bincount(np.searchsorted(terms, I.idx[np.isin(I.idx, terms)]), minlength=len(terms))
    if len(terms) * len(U.dense) * len(I.dense) > DENSE_WORTH * met:
        return _sparse_tile(U.idx, U.row, U.val, I.idx, I.row, I.val, len(U.dense), len(I.dense))
    out = np.zeros((len(U.dense), len(I.dense)))
    for j in range(0, len(terms), DENSE_TERMS):
        some = terms[j:j + DENSE_TERMS]
        out += _dense(U, some) @ _dense(I, some).T
    return out


def _dense(rows: SparseRows, terms: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(terms, rows.idx), len(terms) - 1)
    ok = terms[at] == rows.idx
    out = np.zeros((len(rows.dense), len(terms)))
    np.add.at(out, (rows.row[ok], at[ok]), rows.val[ok])
    return out


def sparse_vectors(sparse: DataFrame, key: str, idx: str = "idx", val: str = "weight") -> DataFrame:
    """(key, idx, weight) long rows -> (key, vec): the indexes, then the weights,
    in order of the indexes (doubles hold indexes up to 2^53 exactly)."""
    m = sparse.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(idx).alias("i"), F.col(val).alias("w")))).alias("_m"))
    return m.select(key, entries_to_vec("_m").alias("vec"))


def entries_to_vec(col: str):
    return F.concat(F.transform(col, lambda e: e["i"].cast("double")), F.transform(col, lambda e: e["w"]))


def _side(pdf: pd.DataFrame) -> tuple[np.ndarray, list]:
    """Ids ascending, and their vectors."""
    if pdf.empty:
        return np.zeros(0, np.int64), []
    ids = np.concatenate([np.asarray(x, np.int64) for x in pdf["ids"]])
    ends = [np.cumsum(np.asarray(x, np.int64))[:-1] for x in pdf["lens"]]
    vecs = [v for x, e in zip(pdf["vals"], ends, strict=True) for v in np.split(np.asarray(x, np.float64), e)]
    order = np.argsort(ids, kind="stable")
    return ids[order], [vecs[j] for j in order]


def _split(pdf: pd.DataFrame):
    return _side(pdf[pdf["kind"] == "U"]), _side(pdf[pdf["kind"] == "I"]), pdf[pdf["kind"] == "S"]


class SeenCells:
    """(row, column) of the seen cells of a block, by row; others are left out."""

    def __init__(self, uids: np.ndarray, iids: np.ndarray, u: np.ndarray, i: np.ndarray):
        r, c = np.searchsorted(uids, u), np.searchsorted(iids, i)
        ok = (r < len(uids)) & (c < len(iids))
        r, c, u, i = r[ok], c[ok], u[ok], i[ok]
        ok = (uids[r] == u) & (iids[c] == i)
        order = np.argsort(r[ok], kind="stable")
        self.row, self.col = r[ok][order], c[ok][order]

    def of(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = np.searchsorted(self.row, [lo, hi])
        return self.row[a:b] - lo, self.col[a:b]


GROUPS = 64  # groups of columns of a tile


def _reaching(S: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column), rows ascending, of the cells that reach their row's bound and may be
    among the row's first k by rounded value; NaN reaches nothing."""
    n, w = S.shape
    deep = w // GROUPS
    if deep < 2:
        return np.nonzero(S >= bound[:, None])
    cells = S[:, :deep * GROUPS].reshape(n, deep, GROUPS)  # column j lies in group j % GROUPS
    most = cells.max(axis=1)
    if np.isnan(most).any():
        most = np.fmax.reduce(cells, axis=1)
        most[np.isnan(most)] = -np.inf
    if k <= GROUPS:
        kth = -np.partition(-most, k - 1, axis=1)[:, k - 1]
        bound = np.maximum(bound, kth - 1e-9 - 1e-12 * np.where(np.isfinite(kth), np.abs(kth), 0.0))
    r, g = np.nonzero(most >= bound[:, None])
    if 4 * len(r) > n * GROUPS:  # no bound to speak of
        return np.nonzero(S >= bound[:, None])
    hit, d = np.nonzero(cells[r, :, g] >= bound[r][:, None])
    r, c = r[hit], d * GROUPS + g[hit]
    if w > deep * GROUPS:
        rest = np.nonzero(S[:, deep * GROUPS:] >= bound[:, None])
        r, c = np.concatenate([r, rest[0]]), np.concatenate([c, rest[1] + deep * GROUPS])
        by_row = np.argsort(r, kind="stable")
        r, c = r[by_row], c[by_row]
    return r, c


def tiled_topk(n_users: int, n_items: int, k: int, score: Callable[[slice, slice], np.ndarray],
               seen: SeenCells | None, least: np.ndarray, user_tile: int = USER_TILE,
               item_tile: int = ITEM_TILE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, score) of each user's first k unseen items by (score rounded
    to nine places desc, column asc), among those whose rounded score is at least the
    user's ``least``. Tile by tile: a tile's columns lie in groups, and only groups whose
    maximum reaches a user's bound are looked into. The bound is the k-th maximum of
    the tile's groups (k cells reach it), or the k-th score of the tiles before."""
    found = []
    for lo in range(0, n_users, user_tile):
        hi = min(n_users, lo + user_tile)
        floor, full = least[lo:hi].copy(), np.zeros(hi - lo, bool)  # a full list is entered above its last score only
        sr, sc = seen.of(lo, hi) if seen is not None else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        lists, waiting = [], 0
        for a in range(0, n_items, item_tile):
            b = min(n_items, a + item_tile)
            S = np.asarray(score(slice(lo, hi), slice(a, b)), dtype=np.float64)
            if len(sr):
                here = (sc >= a) & (sc < b)
                if here.any():
                    S = S if S.flags.writeable else S.copy()
                    S[sr[here], sc[here] - a] = -np.inf
            bound = floor - np.where(full, -4e-10, 1e-9) - 1e-12 * np.where(np.isfinite(floor), np.abs(floor), 0.0)
            r, c = _reaching(S, bound, k)
            if len(r) > 4 * k * (hi - lo):  # many equal scores: cut by column at once
                key = np.round(S, 9)
                key[~np.where(full[:, None], key > floor[:, None], key >= floor[:, None])] = -np.inf
                r, c = _row_topk(key, k)
                key = key[r, c]
            else:
                key = np.round(S[r, c], 9)
                ok = np.where(full[r], key > floor[r], key >= floor[r]) & np.isfinite(key)
                r, c, key = r[ok], c[ok], key[ok]
            if len(r):
                lists.append((r, c + a, key, S[r, c]))
                waiting += len(r)
            if waiting > k * (hi - lo) or (lists and b == n_items):
                r, c, key, val = (np.concatenate(x) for x in zip(*lists, strict=True))
                order = np.lexsort((c, -key, r))
                r, c, key, val = r[order], c[order], key[order], val[order]
                rank = np.arange(len(r)) - np.searchsorted(r, r)
                keep = rank < k
                last = rank == k - 1
                floor[r[last]], full[r[last]] = key[last], True
                lists, waiting = [(r[keep], c[keep], key[keep], val[keep])], 0
        if lists:
            r, c, _, val = lists[0]
            found.append((r + lo, c, val))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _tiles(vecs: list, size: int, pack: Callable) -> list:
    return [pack(vecs[j:j + size]) for j in range(0, len(vecs), size)]


def blocked_topk(user_vecs: DataFrame, item_vecs: DataFrame, seen: DataFrame | None, k: int,
                 score_fn: Callable[[np.ndarray, np.ndarray], np.ndarray] = _dot,
                 n_users: int | None = None, n_items: int | None = None,
                 user_block: int | None = None, item_block: int | None = None, pack: Callable = _stack) -> DataFrame:
    """Top-k unseen items per user by ``score_fn(U, I)`` (default: dot product);
    ``pack`` turns vectors of a tile into what ``score_fn`` takes.

    user_vecs: (user_id, vec array<double>); item_vecs: (item_id, vec);
    seen: (user_id, item_id) or None. Returns (user_id, rank, item_id, score)
    ordered by round(score, 9) desc, item_id asc."""
    n_users = n_users if n_users is not None else user_vecs.count()
    n_items = n_items if n_items is not None else item_vecs.count()
    user_block, item_block = user_block_size(n_users, user_block), item_block_size(n_items, item_block)
    nu, ni = _n_blocks(n_users, user_block), _n_blocks(n_items, item_block)
    kk = int(k)
    ut, it = DENSE_TILE if pack is _stack else (USER_TILE, ITEM_TILE)

    def score_block(pdf: pd.DataFrame) -> pd.DataFrame:
        (uids, us), (iids, its), s = _split(pdf)
        if len(uids) == 0 or len(iids) == 0:
            return pd.DataFrame({"user_id": [], "item_id": [], "score": []})
        cells = SeenCells(uids, iids, np.concatenate([np.asarray(x, np.int64) for x in s["ids"]]),
                          np.concatenate([np.asarray(x, np.int64) for x in s["lens"]])) if len(s) else None
        U, I = _tiles(us, ut, pack), _tiles(its, it, pack)
        rows, cols, val = tiled_topk(len(uids), len(iids), kk, lambda u, i: score_fn(U[u.start // ut], I[i.start // it]),
                                     cells, np.full(len(uids), -np.inf), ut, it)
        return pd.DataFrame({"user_id": uids[rows], "item_id": iids[cols], "score": val})

    parts = _one_group_per_task(_grouped(user_vecs, item_vecs, seen, nu, ni, user_block, item_block), nu, ni)
    partial = parts.groupBy("_k").applyInPandas(score_block, _OUT)
    return topk(partial, k, order=score_order()).select("user_id", F.col("rank").cast("int"), "item_id", "score")


def blocked_user_stats(user_vecs: DataFrame, item_vecs: DataFrame,
                       score_fn: Callable[[np.ndarray, np.ndarray], np.ndarray] = _dot,
                       n_users: int | None = None, n_items: int | None = None,
                       user_block: int | None = None, item_block: int | None = None, pack: Callable = _stack) -> DataFrame:
    """Per-user min and max of ``score_fn`` over *all* items (partial per block,
    combined with a min/max aggregation). ``score_fn`` may return a list of
    score matrices; the columns are then lo0, hi0, lo1, hi1, ..."""
    n_users = n_users if n_users is not None else user_vecs.count()
    n_items = n_items if n_items is not None else item_vecs.count()
    user_block, item_block = user_block_size(n_users, user_block), item_block_size(n_items, item_block)
    nu, ni = _n_blocks(n_users, user_block), _n_blocks(n_items, item_block)

    n_out = getattr(score_fn, "n_outputs", 1)
    names = ["user_id"] + [f"{p}{j}" for j in range(n_out) for p in ("lo", "hi")]

    def stats_block(pdf: pd.DataFrame) -> pd.DataFrame:
        (uids, us), (iids, its), _ = _split(pdf)
        if len(uids) == 0 or len(iids) == 0:
            return pd.DataFrame({c: [] for c in names})
        out = {"user_id": uids} | {f"lo{j}": np.full(len(uids), np.inf) for j in range(n_out)}
        out |= {f"hi{j}": np.full(len(uids), -np.inf) for j in range(n_out)}
        I = _tiles(its, ITEM_TILE, pack)
        for t, U in enumerate(_tiles(us, USER_TILE, pack)):
            at = slice(t * USER_TILE, (t + 1) * USER_TILE)
            for V in I:
                res = score_fn(U, V)
                for j, S in enumerate(res if isinstance(res, (list, tuple)) else [res]):
                    S = np.asarray(S, dtype=np.float64)
                    out[f"lo{j}"][at] = np.minimum(out[f"lo{j}"][at], S.min(axis=1))
                    out[f"hi{j}"][at] = np.maximum(out[f"hi{j}"][at], S.max(axis=1))
        return pd.DataFrame(out)[names]

    schema = ", ".join(["user_id long"] + [f"{c} double" for c in names[1:]])
    parts = _one_group_per_task(_grouped(user_vecs, item_vecs, None, nu, ni, user_block, item_block), nu, ni)
    partial = parts.groupBy("_k").applyInPandas(stats_block, schema)
    aggs = []
    for j in range(n_out):
        aggs += [F.min(f"lo{j}").alias(f"lo{j}"), F.max(f"hi{j}").alias(f"hi{j}")]
    out = partial.groupBy("user_id").agg(*aggs)
    return out.withColumnRenamed("lo0", "lo").withColumnRenamed("hi0", "hi") if n_out == 1 else out


GRAM_ITEM_BLOCK = 2048
GRAM_PAIRS_PER_SLICE = 4_000_000


def _sparse_tile(lu, li, lr, ru, ri, rr, n_left: int, n_right: int) -> np.ndarray:
    """``X_L^T X_R`` of one tile from its non-zero cells, without densifying X.

    Every left cell meets the right cells of the same user (a user's pairs in
    one tile are bounded by the tile size); products are summed into the
    n_left x n_right tile with ``bincount``, a bounded slice of pairs at a time."""
    G = np.zeros(n_left * n_right)
    if len(lu) == 0 or len(ru) == 0:
        return G.reshape(n_left, n_right)
    ro = np.argsort(ru, kind="stable")
    ru, ri, rr = ru[ro], ri[ro], rr[ro]
    start = np.searchsorted(ru, lu, side="left")
    count = np.searchsorted(ru, lu, side="right") - start
    done = 0
    csum = np.cumsum(count)
    while done < len(lu):
        base = csum[done - 1] if done else 0
        stop = max(done + 1, int(np.searchsorted(csum, base + GRAM_PAIRS_PER_SLICE, side="right")))
        c = count[done:stop]
        tot = int(c.sum())
        if tot:
            rep = np.repeat(np.arange(done, stop), c)
            off = np.arange(tot) - np.repeat(np.cumsum(c) - c, c)
            rj = start[rep] + off
            G += np.bincount(li[rep] * n_right + ri[rj], weights=lr[rep] * rr[rj], minlength=n_left * n_right)
        done = stop
    return G.reshape(n_left, n_right)
GRAM_USERS_PER_CHUNK = 262_144  # tiles are sparse-accumulated; this only bounds rows per group
GRAM_ROWS_PER_GROUP = 1_000_000


def blocked_gram(ratings: DataFrame, n_users: int, n_items: int, n_ratings: int,
                 user: str = "user_id", item: str = "item_id", value: str = "rating") -> DataFrame:
    """Item-item co-rating sums ``dot(i, j) = sum_u r_ui * r_uj`` for i != j.

    The rating matrix is tiled into item blocks and user chunks; each
    (user chunk, item block a <= b) group receives the rows of both blocks for
    those users (a rating is routed only to the blocks its user also rates in)
    and accumulates ``X_a^T X_b`` from the non-zero cells, emitting only
    non-zero products. Chunk partials are then summed per (i, j) with a partial/final
    aggregation. No row-level self-join: a user with a huge history is one
    matrix row spread over item blocks, not a quadratic set of pairs."""
    nb = _n_blocks(n_items, GRAM_ITEM_BLOCK)
    uc = max(_n_blocks(n_users, GRAM_USERS_PER_CHUNK),
             _n_blocks(2 * n_ratings, GRAM_ROWS_PER_GROUP * max(1, nb)))
    r = ratings.select(F.col(user).alias("u"), F.col(item).alias("i"), F.col(value).cast("double").alias("r"),
                       _block(user, uc).alias("_uc"), _block(item, nb).alias("_a"))
    touched = r.select(F.col("u"), F.col("_a").alias("_b")).distinct()  # item blocks each user rates in
    r = r.join(touched, "u")  # a cell meets only blocks its user has partners in (at most nb)
    lo, hi = F.least("_a", "_b"), F.greatest("_a", "_b")
    side = F.when(F.col("_a") == F.col("_b"), "B").when(F.col("_a") < F.col("_b"), "L").otherwise("R")
    g = r.select("_uc", lo.alias("_lo"), hi.alias("_hi"), side.alias("side"), "u", "i", "r")

    def gram_block(pdf: pd.DataFrame) -> pd.DataFrame:
        left = pdf[pdf.side != "R"]
        right = pdf[pdf.side != "L"]
        li, lidx = np.unique(left.i.to_numpy(np.int64), return_inverse=True)
        ri, ridx = np.unique(right.i.to_numpy(np.int64), return_inverse=True)
        G = _sparse_tile(left.u.to_numpy(np.int64), lidx, left.r.to_numpy(np.float64),
                         right.u.to_numpy(np.int64), ridx, right.r.to_numpy(np.float64), len(li), len(ri))
        a, b = np.nonzero(G)
        ii, jj, d = li[a], ri[b], G[a, b]
        keep = ii != jj
        ii, jj, d = ii[keep], jj[keep], d[keep]
        if (pdf.side == "B").all():
            return pd.DataFrame({"i": ii, "j": jj, "dot": d})
        return pd.DataFrame({"i": np.concatenate([ii, jj]), "j": np.concatenate([jj, ii]),
                             "dot": np.concatenate([d, d])})

    g = _pinned(g, uc * nb * (nb + 1) // 2, "_uc", "_lo", "_hi")
    part = g.groupBy("_uc", "_lo", "_hi").applyInPandas(gram_block, "i long, j long, dot double")
    return part.groupBy("i", "j").agg(F.sum("dot").alias("dot"))


SPMM_ROWS_PER_CHUNK = 4096
SPMM_COLS_PER_BLOCK = 4096


def _sum_pairs(keys: np.ndarray, vals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    uk, inv = np.unique(keys, return_inverse=True)
    return uk, np.bincount(inv, weights=vals, minlength=len(uk))


def tiled_spmm(left: DataFrame, right: DataFrame, n_rows: int, n_cols: int) -> DataFrame:
    """Sparse product ``out[r, c] = sum_m left[r, m] * right[m, c]``.

    left: (row, mid, lv); right: (mid, col, rv). Rows are hashed into chunks
    and columns into blocks; a left cell is routed only to the column blocks
    its ``mid`` reaches, and a right cell only to the row chunks that contain
    its ``mid`` (both found by ``distinct`` aggregations), so nothing is
    replicated to tiles where it has no partner. Each (row chunk, column
    block) tile holds every term of its cells, contracts over ``mid`` with
    NumPy and emits complete sums, so there is no cross-tile aggregation and
    no row-level join on ``mid`` (a popular ``mid`` is split across tiles)."""
    rc = _n_blocks(n_rows, SPMM_ROWS_PER_CHUNK)
    cb = _n_blocks(n_cols, SPMM_COLS_PER_BLOCK)
    lb = left.select("row", "mid", "lv", _block("row", rc).alias("_ub"))
    rb = right.select("mid", "col", "rv", _block("col", cb).alias("_ib"))
    reach_cols = rb.select("mid", "_ib").distinct()
    reach_rows = lb.select("mid", "_ub").distinct()
    L = lb.join(reach_cols, "mid").select("_ub", "_ib", F.lit("L").alias("side"), "row", "mid",
                                          F.lit(None).cast("long").alias("col"), F.col("lv").alias("v"))
    R = rb.join(reach_rows, "mid").select("_ub", "_ib", F.lit("R").alias("side"), F.lit(None).cast("long").alias("row"),
                                          "mid", "col", F.col("rv").alias("v"))
    parts = _one_group_per_task(L.unionByName(R), rc, cb)

    def tile(pdf: pd.DataFrame) -> pd.DataFrame:
        lft = pdf[pdf.side == "L"]
        rgt = pdf[pdf.side == "R"]
        if lft.empty or rgt.empty:
            return pd.DataFrame({"row": [], "col": [], "value": []})
        rows, rinv = np.unique(lft.row.to_numpy(np.int64), return_inverse=True)
        cols, cinv = np.unique(rgt.col.to_numpy(np.int64), return_inverse=True)
        lm, lv = lft.mid.to_numpy(np.int64), lft.v.to_numpy(np.float64)
        rm, rv = rgt.mid.to_numpy(np.int64), rgt.v.to_numpy(np.float64)
        o = np.argsort(rm, kind="stable")
        rm, rv, cinv = rm[o], rv[o], cinv[o]
        start = np.searchsorted(rm, lm, side="left")
        count = np.searchsorted(rm, lm, side="right") - start
        csum = np.cumsum(count)
        keys_acc, vals_acc = [], []
        done = 0
        while done < len(lm):
            base = csum[done - 1] if done else 0
            stop = max(done + 1, int(np.searchsorted(csum, base + GRAM_PAIRS_PER_SLICE, side="right")))
            c = count[done:stop]
            tot = int(c.sum())
            if tot:
                rep = np.repeat(np.arange(done, stop), c)
                off = np.arange(tot) - np.repeat(np.cumsum(c) - c, c)
                rj = start[rep] + off
                k, s = _sum_pairs(rinv[rep] * len(cols) + cinv[rj], lv[rep] * rv[rj])
                keys_acc.append(k)
                vals_acc.append(s)
            done = stop
        if not keys_acc:
            return pd.DataFrame({"row": [], "col": [], "value": []})
        k, s = _sum_pairs(np.concatenate(keys_acc), np.concatenate(vals_acc))
        return pd.DataFrame({"row": rows[k // len(cols)], "col": cols[k % len(cols)], "value": s})

    return parts.groupBy("_k").applyInPandas(tile, "row long, col long, value double")


def blocked_group_cover(user_vecs: DataFrame, group_vecs: DataFrame, seen_counts: DataFrame, k: int,
                        n_users: int | None = None, n_groups: int | None = None,
                        user_block: int | None = None, item_block: int | None = None) -> DataFrame:
    """Candidate groups per user for a top-k over items that share a group score.

    user_vecs and group_vecs: (user_id, vec) and (group_id, vec, size) with
    vectors of ``sparse_vectors``; seen_counts: (user_id, group_id, n_seen).
    For each user and block of groups, the best-scoring groups whose unseen
    items cover k (plus every group tied with the last one) leave the task as
    (user_id, group_id, score, unseen, n_seen). The global cover is a superset-safe
    union of these per-block covers."""
    n_users = n_users if n_users is not None else user_vecs.count()
    n_groups = n_groups if n_groups is not None else group_vecs.count()
    user_block, item_block = user_block_size(n_users, user_block), item_block or ITEM_BLOCK
    nu, ni = _n_blocks(n_users, user_block), _n_blocks(n_groups, item_block)
    kk = int(k)
    ib_all = F.explode(F.sequence(F.lit(0), F.lit(ni - 1)))
    ub_all = F.explode(F.sequence(F.lit(0), F.lit(nu - 1)))
    u = _packed(user_vecs, "user_id", "_ub", nu, user_block).select("_ub", ib_all.alias("_ib"), F.lit("U").alias("kind"), "ids", "lens", "vals")
    sized = group_vecs.select("group_id", F.concat(F.array(F.col("size").cast("double")), F.col("vec").cast("array<double>")).alias("vec"))
    g = _packed(sized, "group_id", "_ib", ni, item_block).select(ub_all.alias("_ub"), "_ib", F.lit("I").alias("kind"), "ids", "lens", "vals")
    cells = seen_counts.select(_block("user_id", nu * _n_blocks(user_block, PACKED)).alias("_f"), _block("group_id", ni).alias("_ib"),
                               F.struct(no_null_id("user_id").alias("u"), no_null_id("group_id").alias("g"), F.col("n_seen").cast("double").alias("n")).alias("c"))
    s = cells.groupBy("_f", "_ib").agg(F.collect_list("c").alias("m")).select(
        (F.col("_f") % F.lit(nu)).cast("int").alias("_ub"), "_ib", F.lit("S").alias("kind"), F.col("m.u").alias("ids"),
        F.col("m.g").alias("lens"), F.col("m.n").alias("vals"))
    parts = _one_group_per_task(u.unionByName(g).unionByName(s), nu, ni)

    def cover(pdf: pd.DataFrame) -> pd.DataFrame:
        (uids, us), (gids, gs), ss = _split(pdf)
        if len(uids) == 0 or len(gids) == 0:
            return pd.DataFrame({"user_id": [], "group_id": [], "score": [], "unseen": [], "n_seen": []})
        G = sparse_rows(1)(gs)
        size = G.dense[:, 0]
        su, sg, sn = (np.concatenate([np.asarray(x, t) for x in ss[c]] + [np.zeros(0, t)])
                      for c, t in (("ids", np.int64), ("lens", np.int64), ("vals", np.float64)))
        r, c = np.minimum(np.searchsorted(uids, su), len(uids) - 1), np.minimum(np.searchsorted(gids, sg), len(gids) - 1)
        ok = (uids[r] == su) & (gids[c] == sg)  # rows of users/groups not in this block are ignored
        by_row = np.argsort(r[ok], kind="stable")
        r, c, sn = r[ok][by_row], c[ok][by_row], sn[ok][by_row]
        found = []
        for t, U in enumerate(_tiles(us, USER_TILE, sparse_rows())):
            lo, n = t * USER_TILE, len(U.dense)
            a, b = np.searchsorted(r, [lo, lo + n])
            S = sparse_dot(U, G)
            unseen = np.tile(size, (n, 1))
            np.subtract.at(unseen, (r[a:b] - lo, c[a:b]), sn[a:b])
            key = np.where(unseen > 0, np.round(S, 9), -np.inf)
            # Every such group has an unseen item, so the first k groups cover k, if all do.
            tr, tc = _row_topk(key, kk)
            have = np.zeros((n, kk))
            first = np.full((n, kk), -np.inf)
            rank = np.arange(len(tr)) - np.searchsorted(tr, tr)
            have[tr, rank], first[tr, rank] = unseen[tr, tc], key[tr, tc]
            reach = (np.cumsum(have, axis=1) < kk).sum(axis=1)  # first position covering k
            thr = np.where(reach < kk, first[np.arange(n), np.minimum(reach, kk - 1)], -np.inf)
            rr, cc = np.nonzero((key >= thr[:, None]) & np.isfinite(key))
            found.append(pd.DataFrame({"user_id": uids[rr + lo], "group_id": gids[cc], "score": S[rr, cc], "unseen": unseen[rr, cc],
                                       "n_seen": size[cc] - unseen[rr, cc]}))
        return pd.concat(found, ignore_index=True)

    return parts.groupBy("_k").applyInPandas(cover, "user_id long, group_id long, score double, unseen double, n_seen double")
