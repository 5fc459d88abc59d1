"""Item neighbours and neighbourhood scores, cut to k where they are summed.

Both jobs are sparse products whose results are far larger than the lists kept
of them. All terms of a sum meet in one task, so only finished lists leave it:

* ``cosine_lists``: a user's cells travel once to every item block the user
  rated in, as arrays beside the cells of that block. Blocks stream through
  their task sorted; the sums of the block at hand are kept as (i, j) cells, so
  memory does not grow with the raters of an item. Products are never shuffled.
* ``neighbor_sums``: a user's history travels once to every item block with a pair of
  the user, an item's list to its own block only. Looking a history up in the lists
  costs pairs x history, however long the lists are.
* ``neighbor_topk``: a (row chunk, column block) tile sums its scores, drops the
  seen cells (a row's own) and emits each row's first k.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocked import _block, _n_blocks, _one_group_per_task, spread_column, spread_keys
from .ranking import score_order, topk

LISTS_ITEM_BLOCK = 2048    # items of a block, at most
LISTS_PAIRS = 4_000_000    # cells of a block's result, about; blocks keep at least LISTS_LEAST items
LISTS_LEAST = 64
USER_CHUNK = 4096          # cells of one user in one row
PAIRS_AT_ONCE = 1_000_000  # products made at once
PENDING_PAIRS = 4_000_000  # products kept before they are summed
TOPK_LEFT = 1 << 20        # left cells of a row chunk, about
TOPK_RIGHT = 1 << 22       # right cells of a column block, about

_COSINES = "item_id long, neighbor_id long, sim double"
_SCORES = "user_id long, item_id long, score double"


def _slices(counts: np.ndarray):
    """(from, to) of consecutive rows with at most PAIRS_AT_ONCE pairs (or one row)."""
    csum, done = np.cumsum(counts), 0
    while done < len(counts):
        base = csum[done - 1] if done else 0
        stop = max(done + 1, int(np.searchsorted(csum, base + PAIRS_AT_ONCE, side="right")))
        yield done, stop
        done = stop


def _runs(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... count[0] times, then the next run."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def _lists(batch: pa.RecordBatch, *names: str) -> tuple[np.ndarray, ...]:
    """Lengths of a batch's lists (the same in every column) and their values end to end."""
    col = [batch.column(n) for n in names]
    return (np.diff(np.asarray(col[0].offsets)), *(c.flatten().to_numpy(zero_copy_only=False) for c in col))


def _codes(x: np.ndarray) -> tuple[np.ndarray, int, Callable[[np.ndarray], np.ndarray]]:
    """Codes of the values in their order, how many there may be, and the way back."""
    low, span = int(x.min()), int(x.max()) - int(x.min()) + 1
    if span < 1 << 31:
        return x.astype(np.int64) - low, span, lambda c: c + low
    codes, values = pd.factorize(x, sort=True)
    return codes, len(values), lambda c: values[c]


def _sums_by(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys ascending, none of them negative, and their sums."""
    order = np.argsort(key)
    key = key[order]
    heads = np.flatnonzero(np.diff(key, prepend=-1))
    return key[heads], np.add.reduceat(value[order], heads)


def _summed(i: np.ndarray, j: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums per (i, j), in that order."""
    if not len(i):
        return i, j, value
    (a, _, of_i), (b, nj, of_j) = _codes(i), _codes(j)
    key, value = _sums_by(a * nj + b, value)
    return of_i(key // nj), of_j(key % nj), value


def _bounds(value: np.ndarray, heads: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """Per row of ``counts`` cells from ``heads`` on, a value that k of its cells reach
    (-inf: it has few): the k-th largest maximum of some pieces of the row."""
    pieces = 4 * k
    long = np.flatnonzero(counts > 2 * pieces)
    out = np.full(len(heads), -np.inf)
    if len(long):
        # Pieces of equal lengths but one; a row ends where the next one begins.
        at = heads[long][:, None] + np.arange(pieces) * (counts[long] // pieces)[:, None]
        ends = np.column_stack([at, heads[long] + counts[long]]).ravel()  # the last of a row closes it
        most = np.maximum.reduceat(np.append(value, -np.inf), ends).reshape(len(long), -1)[:, :pieces]
        out[long] = -np.partition(-most, k - 1, axis=1)[:, k - 1]
    return out


def _first(row: np.ndarray, value: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and ranks of each row's first k by (rounded value descending, col), of
    cells in order of (row, col); NaN counts as largest."""
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    heads = np.flatnonzero(np.diff(row, prepend=row[0] - 1))
    counts = np.diff(np.append(heads, len(row)))
    value = np.where(np.isnan(value), np.inf, value)
    low = _bounds(value, heads, counts, k)
    low -= 1e-9 + 1e-12 * np.where(np.isfinite(low), np.abs(low), 0.0)
    near = np.flatnonzero(value >= np.repeat(low, counts))
    row = row[near]
    order = np.lexsort((-np.round(value[near], 9), row))
    heads = np.flatnonzero(np.diff(row, prepend=row[0] - 1))
    rank = np.arange(len(row)) - np.repeat(heads, np.diff(np.append(heads, len(row))))
    return near[order[rank < k]], rank[rank < k]


class _Sums:
    """Running sums of products per (i, j) of one block, and the items' square sums."""

    def __init__(self):
        self.i, self.j, self.dot, self.ids, self.q, self.pending = [], [], [], [], [], 0

    def add(self, i, j, dot) -> None:
        self.i.append(i)
        self.j.append(j)
        self.dot.append(dot)
        self.pending += len(i)
        if self.pending > PENDING_PAIRS:
            before, self.pending = self.pending, 0
            i, j, dot = self.summed()
            self.i, self.j, self.dot = [i], [j], [dot]
            self.pending = max(0, 2 * len(i) - before)  # twice as much next time when little was saved

    def squares(self, ids, q) -> None:
        code, ids = pd.factorize(ids)
        of = np.empty(len(ids))
        of[code] = q
        self.ids.append(ids)
        self.q.append(of)

    def summed(self):
        return _summed(np.concatenate(self.i), np.concatenate(self.j), np.concatenate(self.dot))

    def lists(self, eps: float, longest: int, ranked: bool) -> pa.RecordBatch:
        i, j, dot = self.summed()
        ids, at = np.unique(np.concatenate(self.ids), return_index=True)
        norm = np.sqrt(np.concatenate(self.q)[at]) + eps
        sim = dot / (norm[np.searchsorted(ids, i)] * norm[np.searchsorted(ids, j)])
        if longest > 0:
            keep = ~(sim <= 0)
            i, j, sim = i[keep], j[keep], sim[keep]
            keep, rank = _first(i, sim, longest)
            i, j, sim = i[keep], j[keep], sim[keep]
        out = [pa.array(i, pa.int64()), pa.array(j, pa.int64()), pa.array(sim, pa.float64())]
        if ranked:
            out.append(pa.array(rank + 1, pa.int32()))
        return pa.RecordBatch.from_arrays(out, ["item_id", "neighbor_id", "sim", "nrank"][:len(out)])


def _cosines(eps: float, longest: int, ranked: bool):
    def fn(batches):
        block, sums = None, _Sums()
        for batch in batches:
            blocks = batch.column("_b").to_numpy()
            edges = np.flatnonzero(np.diff(blocks, prepend=blocks[:1] - 1)) if len(blocks) else []
            for lo, hi in zip(edges, [*edges[1:], len(blocks)]):
                if blocks[lo] != block:
                    if sums.i:
                        yield sums.lists(eps, longest, ranked)
                    block, sums = blocks[lo], _Sums()
                part = batch.slice(lo, hi - lo)
                nl, li, lr, lq = _lists(part, "li", "lr", "lq")
                nr, ri, rr, rq = _lists(part, "ri", "rr", "rq")
                li, ri, lr, rr = li.astype(np.int64), ri.astype(np.int64), lr.astype(np.float64), rr.astype(np.float64)
                sums.squares(np.concatenate([li, ri]), np.concatenate([lq, rq]))
                start, count = np.repeat(np.cumsum(nr) - nr, nl), np.repeat(nr, nl)  # a left cell's right cells
                for a, b in _slices(count):
                    left, right = np.repeat(np.arange(a, b), count[a:b]), _runs(start[a:b], count[a:b])
                    other = li[left] != ri[right]
                    left, right = left[other], right[other]
                    sums.add(li[left], ri[right], lr[left] * rr[right])
        if sums.i:
            yield sums.lists(eps, longest, ranked)
    return fn


_NARROW = ("tinyint", 1 << 7), ("smallint", 1 << 15), ("int", 1 << 31), ("bigint", 1 << 63)


def _narrow(type_name: str, low, high) -> str:
    """The least type that holds whole numbers from low to high; other numbers stay as they are."""
    if type_name not in dict(_NARROW) or low is None:
        return type_name
    return next(t for t, n in _NARROW if -n <= low and high < n)


def cosine_lists(ratings: DataFrame, n_items: int, eps: float, longest: int = 0, user: str = "user_id",
                 item: str = "item_id", value: str = "rating", ranked: bool = False) -> DataFrame:
    """Cosines ``dot / ((|i| + eps)(|j| + eps))`` of the rating columns i != j that
    share a rater: (item_id, neighbor_id, sim). With ``longest``, each item's first
    ``longest`` positive ones by (rounded cosine descending, neighbour), and with
    ``ranked`` their place (nrank). Ratings hold one row per (user, item); rows without
    a user count in the norms alone. Cells travel in the least types that hold them."""
    kind = dict(ratings.select(value).dtypes)[value]
    number = "bigint" if kind in dict(_NARROW) else "double"
    every = ratings.select(F.col(user).alias("u"), F.col(item).alias("i"), F.col(value).cast(number).alias("r"))
    r = every.dropna(subset=["u", "i"])
    n = F.count(F.lit(1)).alias("n")
    seen = r.groupBy("u").agg(n, *[f(c).alias(f"{p}{c}") for c in "ir" for p, f in (("lo_", F.min), ("hi_", F.max))]).agg(
        F.sum(F.col("n") * F.col("n")).alias("pairs"),
        *[f(f"{p}{c}").alias(f"{p}{c}") for c in "ir" for p, f in (("lo_", F.min), ("hi_", F.max))]).first()
    n_pairs = seen["pairs"] or 0
    nb = min(max(_n_blocks(n_items, LISTS_ITEM_BLOCK), _n_blocks(n_pairs, LISTS_PAIRS)),
             max(_n_blocks(n_items, LISTS_ITEM_BLOCK), _n_blocks(n_items, LISTS_LEAST)))
    squares = every.groupBy("i").agg(F.sum(F.col("r").cast("double") * F.col("r")).alias("q"))
    i_type, r_type = _narrow("bigint", seen["lo_i"], seen["hi_i"]), _narrow(number, seen["lo_r"], seen["hi_r"])
    cell = F.struct(_block("i", nb).alias("b"), F.col("i").cast(i_type).alias("i"), F.col("r").cast(r_type).alias("r"), "q")
    users = (r.join(squares, "i").groupBy("u").agg(F.collect_list(cell).alias("m")).filter(F.size("m") > 1))
    chunk = F.sequence(F.lit(0), F.floor((F.size("m") - 1) / USER_CHUNK).cast("int"))
    dealt = (users.select("m", F.explode(F.array_distinct(F.col("m.b"))).alias("_b"))
             .select("_b", "m", F.filter("m", lambda x: x["b"] == F.col("_b")).alias("l"), F.explode(chunk).alias("c"))
             .select("_b", "l", F.slice("m", F.col("c") * USER_CHUNK + 1, F.lit(USER_CHUNK)).alias("m"))
             .select("_b", *[F.col(f"{a}.{c}").alias(f"{n}{c}") for a, n in (("l", "l"), ("m", "r")) for c in "irq"]))
    cap = int(r.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(max(1, min(nb, cap)), "_b").sortWithinPartitions("_b")
    ranked = ranked and longest > 0
    return dealt.mapInArrow(_cosines(eps, int(longest), ranked), _COSINES + ", nrank int" * ranked)


SUMS_LISTS = 1 << 22       # cells of an item block's lists, about
SUMS_CELLS = 1 << 22       # cells of the histories that meet there, about
_SUMS = "user_id long, item_id long, num double, den double"


def _pair_sums(pairs: pa.Table, lists: pa.Table) -> pa.Table:
    """Of every pair of the block: sum(sim * r) and sum(sim) over the lists' neighbours in
    the user's history. A rating that is missing counts in the second sum alone."""
    out, pairs, lists = [], pairs.combine_chunks().to_batches(), lists.combine_chunks().to_batches()
    if pairs and lists:
        items, users = lists[0].column("id").to_numpy(), pairs[0].column("id").to_numpy()
        n, js, sims = _lists(lists[0], "ids", "vals")
        n_wanted, wanted = _lists(pairs[0], "wanted")
        n_hist, hist, r = _lists(pairs[0], "ids", "vals")
        hist, r = hist.astype(np.int64), r.astype(np.float64)
        # Cells of the lists by (item, neighbour), both as places among the block's own.
        by_item, names = np.argsort(items), np.unique(js)
        place = np.empty(len(items), np.int64)
        place[by_item] = np.arange(len(items))
        cell = np.repeat(place, n) * len(names) + np.searchsorted(names, js)
        order = np.argsort(cell)
        cell, sims = cell[order], sims[order]
        at = np.minimum(np.searchsorted(names, hist), len(names) - 1)
        hist, r, of = at[ok := names[at] == hist], r[ok], np.repeat(np.arange(len(users)), n_hist)[ok]
        count = np.bincount(of, minlength=len(users))
        start = np.cumsum(count) - count
        of = np.repeat(np.arange(len(users)), n_wanted)  # the row of a pair
        at = np.minimum(np.searchsorted(items[by_item], wanted), len(items) - 1)
        of, wanted, at = of[ok := items[by_item][at] == wanted], wanted[ok], at[ok]
        for a, b in _slices(count[of]):
            look, pair = _runs(start[of[a:b]], count[of[a:b]]), np.repeat(np.arange(a, b), count[of[a:b]])
            key = at[pair] * len(names) + hist[look]
            where = np.minimum(np.searchsorted(cell, key), len(cell) - 1)
            met = cell[where] == key
            pair, where, value = pair[met], where[met], r[look[met]]
            some = np.flatnonzero(np.diff(pair, prepend=-1))
            if not len(some):
                continue
            known = ~np.isnan(value)
            num = np.add.reduceat(np.where(known, sims[where] * value, 0.0), some)
            num[np.add.reduceat(known.astype(np.int64), some) == 0] = np.nan
            out.append((users[of[pair[some]]], wanted[pair[some]], num, np.add.reduceat(sims[where], some)))
    u, i, num, den = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, t) for t in "iidd")
    return pa.table({"user_id": pa.array(u, pa.int64()), "item_id": pa.array(i, pa.int64()),
                     "num": pa.array(num, pa.float64(), mask=np.isnan(num)), "den": pa.array(den, pa.float64())})


def neighbor_sums(pairs: DataFrame, ratings: DataFrame, lists: DataFrame, user: str = "user_id",
                  item: str = "item_id", value: str = "rating") -> DataFrame:
    """(user, item, _num, _den) of the pairs, which are distinct: ``sum(sim * rating)`` and
    ``sum(sim)`` over the item's neighbours (item_id, neighbor_id, sim) that the user
    rated; pairs without such a neighbour have no row."""
    p = pairs.select(F.col(user).alias("id"), F.col(item).alias("i")).dropna()
    held = ratings.select(F.col(user).alias("id"), F.col(item).alias("i"), F.col(value).alias("r")).dropna(subset=["id", "i"])
    n = F.count(F.lit(1))
    met = (p.groupBy("id").agg(n.alias("np")).join(held.groupBy("id").agg(n.alias("nh")), "id")
           .agg(F.sum(F.col("np") * F.col("nh")).alias("n")).first()["n"] or 0)
    nb = max(_n_blocks(lists.count(), SUMS_LISTS), _n_blocks(met, SUMS_CELLS))
    nb = max(nb, min(8, _n_blocks(met, SUMS_CELLS // 16)))
    wanted = p.withColumn("_b", _block("i", nb)).groupBy("id", "_b").agg(F.collect_list("i").alias("wanted"))
    hist = held.groupBy("id").agg(F.collect_list(F.struct("i", "r")).alias("m"))
    chunk = F.sequence(F.lit(0), F.floor((F.size("m") - 1) / USER_CHUNK).cast("int"))
    own = (wanted.join(hist, "id").withColumn("c", F.explode(chunk))
           .withColumn("m", F.slice("m", F.col("c") * USER_CHUNK + 1, F.lit(USER_CHUNK)))
           .select("_b", "id", "wanted", F.col("m.i").alias("ids"), F.col("m.r").alias("vals")))
    named = lists.select(F.col("item_id").alias("id"), F.col("neighbor_id").alias("j"), "sim").dropna(subset=["id", "j"])
    named = (named.groupBy("id").agg(F.collect_list(F.struct("j", "sim")).alias("m"))
             .select(_block("id", nb).alias("_b"), "id", F.col("m.j").alias("ids"), F.col("m.sim").alias("vals")))
    cap = max(1, min(nb, int(p.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    keys = spread_keys(p.sparkSession, nb) if nb <= cap else None
    key = spread_column("_b", keys) if keys else F.col("_b").cast("long")
    own, named = (df.withColumn("_k", key).drop("_b").repartition(cap, "_k").groupBy("_k") for df in (own, named))
    sums = own.cogroup(named).applyInArrow(lambda a, b: _pair_sums(a.drop(["_k"]), b.drop(["_k"])), _SUMS)
    return (sums.groupBy(F.col("user_id").alias(user), F.col("item_id").alias(item))
            .agg(F.sum("num").alias("_num"), F.sum("den").alias("_den")))


def _scored(k: int):
    def tile(t: pa.Table) -> pa.Table:
        is_left = pa.array(t.column("is_left").to_numpy())
        left, right = (t.filter(m).combine_chunks().to_batches() for m in (is_left, pa.compute.invert(is_left)))
        out = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if left and right:
            rows, mids = left[0].column("id").to_numpy(), right[0].column("id").to_numpy()
            n_left, mid, lv = _lists(left[0], "ids", "vals")
            n, cols, vals = _lists(right[0], "ids", "vals")
            mid, lv, cols = mid.astype(np.int64), lv.astype(np.float64), cols.astype(np.int64)
            by_mid = np.argsort(mids)
            at = by_mid[np.minimum(np.searchsorted(mids, mid, sorter=by_mid), len(mids) - 1)]
            start, count = (np.cumsum(n) - n)[at], np.where(mids[at] == mid, n[at], 0)
            edges, found = np.append(0, np.cumsum(n_left)), []
            row, (code, nc, of_col) = np.repeat(np.arange(len(rows)), n_left), _codes(cols)
            # A seen cell's code: mids are columns of the tile, or none of them.
            by_col, at_col = np.unique(cols, return_index=True)
            place = np.minimum(np.searchsorted(by_col, mid), len(by_col) - 1)
            is_col, own = by_col[place] == mid, code[at_col[place]]
            del by_col, at_col, place
            for x, y in _slices(np.add.reduceat(count, edges[:-1])):  # whole rows; none is empty
                a, b = edges[x], edges[y]
                take, of = _runs(start[a:b], count[a:b]), np.repeat(np.arange(a, b), count[a:b])
                if not len(of):
                    continue
                key, total = _sums_by((row[of] - x) * nc + code[take], lv[of] * vals[take])
                had = (row[a:b] - x)[is_col[a:b]] * nc + own[a:b][is_col[a:b]]
                at_key = np.minimum(np.searchsorted(key, had), len(key) - 1)
                new = np.ones(len(key), bool)
                new[at_key[key[at_key] == had]] = False
                key, total = key[new], total[new]
                keep, _ = _first(key // nc, total, k)
                found.append((rows[key[keep] // nc + x], of_col(key[keep] % nc), total[keep]))
            if found:
                out = [np.concatenate(x) for x in zip(*found)]
        return pa.table({"user_id": pa.array(out[0], pa.int64()), "item_id": pa.array(out[1], pa.int64()),
                         "score": pa.array(out[2], pa.float64())})
    return tile


def neighbor_topk(left: DataFrame, right: DataFrame, k: int, n_rows: int, n_left: int, n_right: int) -> DataFrame:
    """Each row's first k cells of ``sum_m left[row, m] * right[m, col]`` outside
    the cells of ``left`` itself, by (rounded sum descending, col): (user_id,
    rank, item_id, score). left: (row, mid, lv), one row per cell; right:
    (mid, col, rv). Rows without an id have no scores."""
    rc = max(_n_blocks(n_left, TOPK_LEFT), min(8, _n_blocks(n_rows, 4096)))
    cb = max(_n_blocks(n_right, TOPK_RIGHT), min(2, _n_blocks(n_right, 1 << 16)))
    lb = left.dropna(subset=["row", "mid"]).withColumn("_ub", _block("row", rc))
    rb = right.dropna(subset=["mid", "col"]).withColumn("_ib", _block("col", cb))
    reach = lb.select("mid", "_ub").distinct()  # row chunks that hold a middle id
    lists = F.col("m.i").alias("ids"), F.col("m.v").alias("vals")
    L = (lb.groupBy("_ub", F.col("row").alias("id"))
         .agg(F.collect_list(F.struct(F.col("mid").alias("i"), F.col("lv").cast("double").alias("v"))).alias("m"))
         .select("_ub", F.explode(F.sequence(F.lit(0), F.lit(cb - 1))).alias("_ib"), F.lit(True).alias("is_left"), "id", *lists))
    R = (rb.groupBy("mid", "_ib").agg(F.collect_list(F.struct(F.col("col").alias("i"), F.col("rv").alias("v"))).alias("m"))
         .join(reach, "mid").select("_ub", "_ib", F.lit(False).alias("is_left"), F.col("mid").alias("id"), *lists))
    parts = _one_group_per_task(L.unionByName(R), rc, cb)
    found = parts.groupBy("_k").applyInArrow(_scored(int(k)), _SCORES)
    return topk(found, k, order=score_order()).select("user_id", F.col("rank").cast("int"), "item_id", "score")
