import math
import re
from collections import Counter

import numpy as np
from recsql.llm import balltree as B

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))


def brute(docs, items, k):
    tfs = [(d, Counter(terms(t))) for d, t in docs]
    tfs = [(d, c, sum(c.values())) for d, c in tfs if c]
    n_docs, n_terms = len(tfs), sum(n for _, _, n in tfs)
    df = Counter(t for _, c, _ in tfs for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, q in asked.items():
        found = []
        for d, c, n in tfs:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m))
                    for t in q if t in c)
            if s > 0:
                found.append((-s, d is not None, d if d is not None else 0))
        out += [(i, r + 1, d if some else None, -s) for r, (s, some, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def check(docs, items, k=50):
    got = sorted((tuple(r) for r in B.ranked_search(docs, items, k).collect()), key=str)
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()],
                 [(r.item_id, r.text) for r in items.select("item_id", "text").collect()], k)
    assert got == want
    return got


def test_benchmark(spark, sf, documents):
    assert check(documents, spark.read.parquet(f"{sf}/benchmark.parquet"))


def test_edge_rows(spark, edge_docs, empty_docs):
    asked = "item_id long, text string"
    items = spark.createDataFrame([(1, "ONE two texts"), (1, "row"), (2, None), (3, "漢字 é nowhere"), (None, "the same row"), (5, "...")], asked)
    got = check(edge_docs, items, k=3)
    assert {r[0] for r in got} == {1, 3, None}
    assert B.ranked_search(empty_docs, items).collect() == []
    assert B.ranked_search(edge_docs, items.filter("false")).collect() == []


def test_query_sets(spark, documents, monkeypatch):
    items = documents.filter("doc_id < 8").selectExpr("doc_id AS item_id", "text")
    monkeypatch.setattr(B, "QUERY_BYTES", 2000)
    check(documents, items, k=7)


def rows_below(tree, node):
    parts = tree.nodes[node]
    if len(parts) == 2:
        yield tree.rows[parts[0]:parts[1]]
    else:
        for child in parts[-1]:
            yield from rows_below(tree, child)


def test_subtrees_are_pruned_and_bounds_hold():
    rng = np.random.default_rng(5)
    rows, dim = 2000, 400
    topic = rng.integers(0, 20, rows)
    lists = [np.unique(np.concatenate([rng.integers(20 * t, 20 * t + 20, 12), rng.integers(0, dim, 3)])) for t in topic]
    edges = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    terms_, values = np.concatenate(lists), rng.integers(1, 1 << 40, edges[-1])
    tree = B.BallTree(edges, terms_, values, dim)
    leaves = sum(len(x) == 2 for x in tree.nodes)
    opened = 0
    for t in range(20):
        query = np.arange(20 * t, 20 * t + 8)
        want = np.array([values[a:b][np.isin(terms_[a:b], query)].sum() for a, b in zip(edges[:-1], edges[1:], strict=True)])
        best = []
        opened += tree.search(query, np.arange(rows), best, 10)
        assert sorted(s for s, _ in best) == sorted(want.tolist())[-10:]
        for node, parts in enumerate(tree.nodes):
            if len(parts) > 2:
                for bound, child in zip(tree.bounds(node, query), parts[-1], strict=True):
                    assert all(want[r].max() <= bound for r in rows_below(tree, child))
    assert opened < 0.5 * 20 * leaves
