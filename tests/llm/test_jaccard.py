import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from recsql.llm import jaccard as J
from recsql.llm.graph import components
from recsql.llm.scratch import Scratch
from recsql.llm.words import word_hashes


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def brute(rows, n, num, den):
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x])
        for j, k in shared.items():
            if den * k >= num * (len(s) + len(sets[j]) - k):
                parent[find(i)] = find(j)
        for x in s:
            holders[x].append(i)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return Counter((d, len(sets[i]), low.get(find(i))) for i, (d, _) in enumerate(rows))


def got(df, **params):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_classes(df, **params).collect())


def edited(rng, words, share):
    out = list(words)
    for _ in range(int(share * len(out))):
        out[rng.randrange(len(out))] = f"new{rng.random()}"
    return out


@pytest.mark.parametrize(("n", "num"), [(3, 90), (5, 80)])
def test_documents(documents, n, num):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert got(documents, n=n, num=num, den=100) == brute(rows, n, num, 100)


@pytest.mark.parametrize("num", [80, 90])
def test_near_copies_shared_passages_and_chains(spark, num, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 16)  # many block pairs
    rng = random.Random(num)
    passage = [f"p{i}" for i in range(60)]
    base = [f"b{i}" for i in range(300)]
    texts = [" ".join(base)]
    texts += [" ".join(edited(rng, base, s)) for s in (0.004, 0.01, 0.02, 0.03, 0.05) for _ in range(30)]
    chain = [f"c{i}" for i in range(120)]
    for _ in range(25):
        texts.append(" ".join(chain))
        chain = edited(rng, chain, 0.01)
    for k in range(120):
        own = [f"o{k}_{i}" for i in range(rng.randrange(5, 250))]
        at = rng.randrange(len(own))
        texts.append(" ".join(own[:at] + passage + own[at:]))
    texts += [" ".join(f"s{rng.randrange(12)}" for _ in range(rng.randrange(1, 14))) for _ in range(150)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert got(df, n=3, num=num, den=100) == brute(rows, 3, num, 100)


def test_tiles_miss_no_linked_pair():
    """The pigeonhole itself: linked sets share a tile."""
    rng = np.random.default_rng(4)
    for num in (80, 90):
        for n in (4, 6, 9, 10, 11, 19, 30, 64, 150, 400):
            for _ in range(40):
                x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
                drop, extra = rng.integers(0, n // 5 + 1, 2)
                y = np.unique(np.concatenate([rng.permutation(x)[drop:], rng.integers(0, 1 << 63, extra, dtype=np.uint64)]))
                both = len(np.intersect1d(x, y))
                if 100 * both >= num * (len(x) + len(y) - both) and len(np.setxor1d(x, y)):
                    assert np.intersect1d(J._tiles(x, num, 100), J._tiles(y, num, 100)).size


def test_words_across_chunks(monkeypatch):
    from recsql.llm import words as W
    texts = ["alpha beta\tgamma", None, "", " lead and trail \n", "é" * 50, "x" * 90, "alpha", "A1 a1"]
    whole = word_hashes(pa.array(texts))
    monkeypatch.setattr(W, "_CHUNK", 7)
    small = word_hashes(pa.array(texts))
    assert (whole[0] == small[0]).all() and (whole[1] == small[1]).all()
    assert np.diff(whole[1]).tolist() == [3, 0, 0, 3, 1, 1, 1, 2]
    assert whole[0][0] == whole[0][8] and whole[0][9] == whole[0][10]


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 9), (9, 8), (8, 7), (7, 6), (5, 5), (20, 21), (21, 20)] + [(100, i) for i in range(101, 160)]
    df = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.root for r in components(df, Scratch(spark)).collect()}
    assert found == {1: 1, 2: 1, 3: 1, **dict.fromkeys(range(6, 11), 6), 20: 20, 21: 20, **dict.fromkeys(range(100, 160), 100)}


def test_edges(edge_docs, empty_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    found = got(edge_docs)
    assert {k: v for k, v in found.items() if k[0] is not None} == {k: v for k, v in brute(rows, 3, 90, 100).items() if k[0] is not None}
    assert found[(1, 0, 1)] == found[(2, 0, 2)] == found[(3, 0, 3)] == 1  # empty: linked with nothing
    assert found[(12, 6, 8)] == 1 and found[(8, 6, 8)] == 2
    assert got(empty_docs) == {}
