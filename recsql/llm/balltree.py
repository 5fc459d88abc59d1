"""Exact ranked lexical search as inner-product search in sparse ball trees.

Documents are vectors over the terms of the queries: the coordinate of a term
is its weight times the document's integer term score, so a query is the 0/1
vector of its terms and a document's score the inner product of both.

* Forward table. One pass over all texts keeps each document's length and the
  counts of the queries' terms in it; corpus figures (N, L, df) are summed from
  that table.
* Trees. Documents are dealt out by range of their strongest term, so that
  neighbours are alike. A task reads its documents in blocks of ``BLOCK`` and
  splits each block by halves, along the line between two far documents, into
  ``FAN`` children and these again until at most ``LEAF`` are left. A node keeps
  its centroid, the largest distance of
  its documents from it, and by coordinate how far they reach above it.
* Bound. No document below a node scores more than the centroid does plus the
  distance times the length of the query, nor more than the centroid plus the
  reach of the query's coordinates; the lower of both holds. It is rounded up
  by more than floating point can lose, so it is safe.
* Best first. Per query the node with the highest bound is opened next; the
  search of a block ends at the first bound below the k-th best score found so
  far in this task, over all blocks before. Leaves are scored in 64-bit
  integers, so results are exact, ties included.

Queries are taken in sets of about ``QUERY_BYTES`` of text: a stated query set
against all rows, in blocks.

Defined results: a null text has no terms; documents without terms count
neither for N nor for L; rows that share an item id are one item with the
terms of all; items without terms or matches give no rows; of rows with equal
score the smaller doc_id ranks first (null before all), repeated rows rank
each; other columns are ignored. Terms are compared by 64-bit hashes: exact
but for a hash collision."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch
from .terms import byte_set, row_slices, terms_of

TERM_BYTES = byte_set(range(0x30, 0x3A), range(0x41, 0x5B), range(0x61, 0x7B), range(0x80, 0x100))
GAPS = ~TERM_BYTES
BLOCK = 4096
ENTRIES = 1 << 19
FAN = 8
LEAF = 16
QUERY_BYTES = 1 << 20
_SIEVE = 1 << 20
_U = np.uint64


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def term_scores(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Integer score of a term that occurs tf times in a document of n terms."""
    m = 100 - 50 + (50 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def _forward(vocabulary: np.ndarray):
    """(doc_id, n, terms, counts) of documents with a term; ``vocabulary`` has
    the sorted hashes of the terms wanted."""
    sieve = np.zeros(_SIEVE, dtype=bool)
    sieve[(vocabulary & _U(_SIEVE - 1)).astype(np.int64)] = True

    def fn(batches):
        for batch in batches:
            for part in row_slices(batch, 1):
                t = terms_of(part.column(1), GAPS)
                n = np.bincount(t.rows, minlength=part.num_rows)
                maybe = np.flatnonzero(sieve[(t.hashes & _U(_SIEVE - 1)).astype(np.int64)])
                at = np.searchsorted(vocabulary, t.hashes[maybe])
                hit = vocabulary[np.minimum(at, len(vocabulary) - 1)] == t.hashes[maybe] if len(vocabulary) else at < 0
                key, count = np.unique(t.rows[maybe[hit]] * max(1, len(vocabulary)) + at[hit], return_counts=True)
                row, term = np.divmod(key, max(1, len(vocabulary)))
                some = np.flatnonzero(n)
                edges = np.concatenate([np.searchsorted(row, some), [len(row)]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(some)), pa.array(n[some], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(edges), pa.array(term, pa.int32())),
                     pa.ListArray.from_arrays(pa.array(edges), pa.array(count, pa.int32()))],
                    names=["doc_id", "n", "terms", "counts"])
    return fn


def _row_sums(values: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Sums of consecutive runs that begin at ``first`` (runs may be empty)."""
    out = np.add.reduceat(np.concatenate([values, np.zeros(1, values.dtype)]), np.minimum(first, n))
    out[np.diff(first, append=n) == 0] = 0
    return out


class BallTree:
    """A tree over the rows of a sparse matrix (edges, terms, values)."""

    def __init__(self, edges: np.ndarray, terms: np.ndarray, values: np.ndarray, dim: int):
        self.edges, self.terms, self.values, self.dim = edges, terms, values.astype(np.float64), dim
        # (first, last) row of a leaf, else what bounds the children, and these.
        self.nodes: list[tuple] = []
        self.square = self._per_row(np.arange(len(edges) - 1), lambda at: self.values[at] ** 2)
        self.order: list[np.ndarray] = []
        self._split(np.arange(len(edges) - 1), 0)
        # Rows and entries in leaf order, so that a leaf is a slice.
        self.rows = np.concatenate(self.order)
        at, first = self._at(self.rows)
        self.exact, self.terms = values[at], terms[at]
        self.edges = np.concatenate([first, [len(at)]])

    def _at(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the rows' entries, and each row's first among them."""
        length = self.edges[rows + 1] - self.edges[rows]
        first = np.cumsum(length) - length
        return np.arange(length.sum()) + np.repeat(self.edges[rows] - first, length), first

    def _per_row(self, rows: np.ndarray, of) -> np.ndarray:
        at, first = self._at(rows)
        return _row_sums(of(at), first, len(at))

    def _dots(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        return self._per_row(rows, lambda at: self.values[at] * dense[self.terms[at]])

    def _dense(self, row: int) -> np.ndarray:
        out = np.zeros(self.dim)
        at = slice(self.edges[row], self.edges[row + 1])
        out[self.terms[at]] = self.values[at]
        return out

    def _outline(self, rows: np.ndarray):
        """(terms, highest coordinates, centroid, radius) of rows: the bounds of
        a node, by coordinate and as a ball."""
        at, _ = self._at(rows)
        order = np.argsort(self.terms[at], kind="stable")
        t, v = self.terms[at][order], self.values[at][order]
        first = np.flatnonzero(np.diff(t, prepend=-1))
        centre = np.add.reduceat(v, first) / len(rows) if len(first) else v
        reach = (np.maximum.reduceat(v, first) if len(first) else v) - centre
        dense = np.zeros(self.dim)
        dense[t[first]] = centre
        whole = centre @ centre
        far = self.square[rows] - 2 * self._dots(rows, dense) + whole
        # Rounding loses less than this share of the terms that were summed.
        radius = math.sqrt(max(0.0, float(far.max())) + 1e-10 * (float(self.square[rows].max()) + whole))
        return t[first], (centre + reach) * (1 + 1e-12), centre, radius

    def _halves(self, rows: np.ndarray) -> list[np.ndarray]:
        """Rows in two, along the line between two that lie far apart; equal
        rows stay together."""
        from_first = self.square[rows] - 2 * self._dots(rows, self._dense(int(rows[0])))
        one = self._dense(int(rows[np.argmax(from_first)]))
        from_one = self.square[rows] - 2 * self._dots(rows, one)
        two = self._dense(int(rows[np.argmax(from_one)]))
        side = from_one - self.square[rows] + 2 * self._dots(rows, two)
        order = np.argsort(side, kind="stable")
        if side[order[0]] >= side[order[-1]]:
            return [rows]
        return [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]

    def _split(self, rows: np.ndarray, done: int) -> int:
        """Adds a node over rows whose places begin at ``done``."""
        node = len(self.nodes)
        self.nodes.append((done, done + len(rows)))
        parts, whole = [rows], []
        while parts and len(parts) + len(whole) < FAN:
            parts.sort(key=len)
            widest = parts.pop()
            halves = self._halves(widest) if len(widest) > LEAF else [widest]
            (parts if len(halves) == 2 else whole).extend(halves)
        parts += whole
        if len(parts) == 1:
            self.order.append(rows)
            return node
        outlines = [self._outline(p) for p in parts]
        terms = np.unique(np.concatenate([o[0] for o in outlines]))
        highest, centre = np.zeros((len(parts), len(terms))), np.zeros((len(parts), len(terms)))
        for i, (t, h, c, _) in enumerate(outlines):
            at = np.searchsorted(terms, t)
            highest[i, at], centre[i, at] = h, c
        children = []
        for p in parts:
            children.append(self._split(p, done))
            done += len(p)
        self.nodes[node] = (terms, highest, centre, np.array([o[3] for o in outlines]), children)
        return node

    def bounds(self, node: int, query: np.ndarray) -> np.ndarray:
        """For each child at least the score of every row below it: the
        centroid's score and how far rows reach beyond it."""
        terms, highest, centre, radius, _ = self.nodes[node]
        at = np.searchsorted(terms, query)
        at = at[terms[np.minimum(at, len(terms) - 1)] == query] if len(terms) else at[:0]
        ball = centre[:, at].sum(axis=1) + radius * math.sqrt(len(query))
        return np.minimum(highest[:, at].sum(axis=1), ball) * (1 + 1e-9) + 1

    def scores(self, first: int, last: int, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of a leaf's rows against the terms True in ``wanted``."""
        lo, hi = self.edges[first], self.edges[last]
        return _row_sums(np.where(wanted[self.terms[lo:hi]], self.exact[lo:hi], 0), self.edges[first:last] - lo, hi - lo)

    def search(self, query: np.ndarray, ids: np.ndarray, best: list, k: int) -> int:
        """Put the block's documents among the ``k`` best of a query into the
        heap ``best`` of (score, -id); returns the number of leaves scored."""
        wanted = np.zeros(self.dim, dtype=bool)
        wanted[query] = True
        todo, leaves = [(-math.inf, 0)], 0
        while todo:
            high, node = heapq.heappop(todo)
            floor = best[0][0] if len(best) == k else 1
            if -high < floor:
                break
            below = self.nodes[node]
            if len(below) > 2:
                for bound, child in zip(self.bounds(node, query).tolist(), below[-1], strict=True):
                    if bound >= floor:
                        heapq.heappush(todo, (-bound, child))
                continue
            leaves += 1
            got = self.scores(below[0], below[1], wanted)
            for j in np.flatnonzero(got >= floor).tolist():
                entry = (int(got[j]), -int(ids[self.rows[below[0] + j]]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return leaves


def _blocks(batch: pa.RecordBatch):
    """Slices of at most ``BLOCK`` rows and about ``ENTRIES`` terms."""
    edges = batch.column(2).offsets.to_numpy().astype(np.int64)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(edges, edges[at] + ENTRIES, side="right")) - 1)
        end = min(end, at + BLOCK, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def _search(items: list, queries: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    missing = -(1 << 63) + 1  # stands for a null id, before all others

    def fn(batches):
        best: list[list] = [[] for _ in queries]
        for batch in batches:
            for part in _blocks(batch):
                ids = part.column(0).fill_null(missing).to_numpy()
                lists = part.column(2)
                edges = lists.offsets.to_numpy().astype(np.int64)
                terms, tf = (part.column(c).values.to_numpy()[edges[0]:edges[-1]].astype(np.int64) for c in (2, 3))
                edges = edges - edges[0]
                n = np.repeat(part.column(1).to_numpy(), np.diff(edges))
                tree = BallTree(edges, terms, term_scores(tf, n, n_docs, n_terms) * weights[terms], len(weights))
                for q, heap in zip(queries, best, strict=True):
                    tree.search(q, ids, heap, k)
        found = [(items[i], None if x == -missing else -x, s) for i, heap in enumerate(best) for s, x in heap]
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                                          pa.array([f[2] for f in found], pa.int64())], names=["item_id", "doc_id", "score"])
    return fn


def _query_terms(rows: list) -> tuple[list, np.ndarray, list[np.ndarray]]:
    """(item ids, sorted hashes of all terms, each item's term numbers)."""
    terms = terms_of(pa.array([r.text for r in rows], pa.string()), GAPS)
    vocabulary, number = np.unique(terms.hashes, return_inverse=True)
    by_item: dict = {}
    for k, r in enumerate(rows):
        lo, hi = np.searchsorted(terms.rows, [k, k + 1])
        by_item.setdefault(r.item_id, []).append(number[lo:hi])
    items = [i for i, parts in by_item.items() if sum(map(len, parts))]
    return items, vocabulary, [np.unique(np.concatenate(by_item[i])) for i in items]


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` highest-scoring documents."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    sets = max(1, -(-(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // QUERY_BYTES))
    out = None
    for s in range(sets):
        rows = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(sets)) == s).collect()  # about QUERY_BYTES
        names, vocabulary, queries = _query_terms(rows)
        forward = scratch.write(src.mapInArrow(_forward(vocabulary), "doc_id long, n long, terms array<int>, counts array<int>"))
        n_docs, n_terms = forward.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = forward.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        df = {r.term: r.df for r in held.collect()}  # at most the query set's terms
        weights = np.array([term_weight(n_docs, df.get(t, 0)) for t in range(len(vocabulary))], dtype=np.int64)
        alike = (forward.filter(F.size("terms") > 0)
                 .withColumn("key", _strongest(weights)).repartitionByRange("key", F.xxhash64("terms", "counts", "doc_id"))
                 .drop("key"))
        found = alike.mapInArrow(_search(names, queries, weights, n_docs, n_terms, k), "item_id long, doc_id long, score long")
        out = found if out is None else out.unionByName(found)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    return scratch.finish(out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                          .select("item_id", F.col("rank").cast("int"), "doc_id", "score"))


def _strongest(weights: np.ndarray):
    """The heaviest of a document's terms, the first of equal ones."""
    w = F.lit(weights.tolist()) if len(weights) else F.array().cast("array<long>")
    return F.array_max(F.transform("terms", lambda t: F.struct(F.get(w, t).alias("w"), (-t).alias("t"))))["t"]
