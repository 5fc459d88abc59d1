import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recsql.llm import lm as L


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(rows):
    """Losses with the whole vocabulary and all bigrams seen twice or more."""
    texts = [(i, words(t), bool(y)) for i, t, y in rows]
    vocabulary = {w for _, ws, _ in texts for w in ws}
    size = len(vocabulary) + 2
    uni = [Counter(w for _, ws, y in texts if y == k for w in ws) for k in (True, False)]
    two = [Counter(p for _, ws, y in texts if y == k for p in zip([None, *ws], ws)) for k in (True, False)]
    listed = {p for p in {**two[0], **two[1]} if two[0][p] + two[1][p] >= 2}
    out = []
    for i, ws, _ in texts:
        mean = []
        for k in (0, 1):
            total = sum(uni[k].values())
            before = lambda h: max(uni[k][h] if h is not None else sum(bool(x) and y == (k == 0) for _, x, y in texts), 1e-9)  # noqa: B023, E731
            loss = 0.0
            for h, w in zip([None, *ws], ws):
                rest = 1 - L.WEIGHT * min(1, sum(two[k][p] for p in listed if p[0] == h) / before(h))
                p = rest * (uni[k][w] + 1) / (total + size)
                if (h, w) in listed:
                    p += L.WEIGHT * two[k][(h, w)] / before(h)
                loss -= math.log(p)
            mean.append(loss / max(1, len(ws)))
        out.append((i, len(ws), *mean, mean[0] - mean[1]))
    return out


ROWS = [(1, "the cat sat on the mat", True), (2, "The cat sat\ton the hat", True), (3, "buy now buy cheap now", False),
        (4, "buy cheap cats", None), (5, "", True), (6, None, False), (7, "the cat", False), (7, "the cat", False), (8, " \n", True)]


def test_losses(spark, monkeypatch):
    monkeypatch.setattr(L, "FLUSH", 5)  # merge often
    df = spark.createDataFrame(ROWS, "doc_id long, text string, y boolean").repartition(3)
    got = sorted(tuple(r) for r in L.cross_entropy_difference(df, "y").collect())
    for a, b in zip(got, sorted(brute(ROWS)), strict=True):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], abs=1e-6)


def test_probabilities_add_up(spark, documents):
    import numpy as np
    df = documents.withColumn("y", F.col("source") == "src0")
    models = {}
    original = L._score
    try:
        L._score = lambda shared: models.setdefault("m", shared.value) and original(shared)
        rows = L.cross_entropy_difference(df, "y", vocabulary=2000, bigrams=3000).collect()
    finally:
        L._score = original
    m = models["m"]
    size = len(m.vocabulary) + 2
    assert len(m.vocabulary) <= 2000 and len(m.keys) <= 3000 and len(rows) == documents.count()
    for h in (0, 5, size - 2, size - 1):
        ids = np.arange(size)
        for loss in m.losses(np.full(size, h), ids):
            assert np.exp(-loss).sum() == pytest.approx(1, abs=1e-3)


def test_prefers_the_target(spark):
    rows = [(i, "red green blue red green blue red green", True) for i in range(20)]
    rows += [(100 + i, "one two three one two three one two", False) for i in range(20)]
    rows += [(1000, "red green blue", None), (1001, "one two three", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, y boolean")
    score = {r.doc_id: r.score for r in L.cross_entropy_difference(df, "y").collect()}
    assert score[1000] < 0 < score[1001]


def test_edges(edge_docs, empty_docs):
    flagged = edge_docs.withColumn("y", F.col("doc_id") > 7)
    rows = L.cross_entropy_difference(flagged, "y").collect()
    assert len(rows) == edge_docs.count()
    assert all((r.n_tokens, r.target_loss, r.score) == (0, 0.0, 0.0) for r in rows if r.doc_id in (1, 2, 3))
    assert all(math.isfinite(r.score) for r in rows)
    assert L.cross_entropy_difference(empty_docs.withColumn("y", F.lit(True)), "y").collect() == []
    assert len(L.cross_entropy_difference(edge_docs.withColumn("y", F.lit(False)), "y").collect()) == len(rows)


def test_every_word_is_in_the_vocabulary(spark):
    rows = [(1, " ".join(f"w{k}" for k in range(70_000)), True), (2, "w5 x", False)]
    df = spark.createDataFrame(rows, "doc_id long, text string, y boolean")
    got = {r.doc_id: r for r in L.cross_entropy_difference(df, "y").collect()}
    size = 70_001 + 2
    assert got[2].target_loss == pytest.approx((-math.log(2 / (70_000 + size)) - math.log(1 / (70_000 + size))) / 2, abs=1e-9)
    assert got[2].background_loss == pytest.approx(-math.log(2 / (2 + size)), abs=1e-9)


@pytest.mark.parametrize("held", [0, 1, 3])
def test_what_is_held_does_not_change_the_losses(spark, monkeypatch, held):
    monkeypatch.setattr(L, "HELD_WORDS", held)
    monkeypatch.setattr(L, "HELD_PAIRS", held)
    rows = ROWS + [(9, "the cat sat buy now buy now the the the", True), (None, "the cat sat", False)]
    df = spark.createDataFrame(rows, "doc_id long, text string, y boolean").repartition(3)
    order = lambda r: (r[0] is not None, r)
    got = sorted((tuple(r) for r in L.cross_entropy_difference(df, "y").collect()), key=order)
    for a, b in zip(got, sorted(brute(rows), key=order), strict=True):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], abs=1e-6)


def test_places_of_held_costs():
    import pandas as pd
    rng = np.random.default_rng(3)
    near = np.arange(1000, dtype=np.uint64) + np.uint64(1 << 63)  # many keys of equal leading bits
    for keys in (rng.integers(0, 1 << 64, 5000, dtype=np.uint64), near, np.array([0, (1 << 64) - 1], np.uint64), np.zeros(0, np.uint64)):
        keys = np.unique(keys)
        rows = pd.DataFrame({"key": keys.view(np.int64), **{k: np.zeros(len(keys)) for k in ("wt", "wb", "ht", "hb")}})
        costs = L.Costs(rows, rows.iloc[:0], (0.0, 0.0), None)
        wanted = np.concatenate([keys, keys + np.uint64(1), rng.integers(0, 1 << 64, 3000, dtype=np.uint64)])
        at, there = costs.find("words", wanted)
        assert (there == np.isin(wanted, keys)).all()
        assert (keys[at[there]] == wanted[there]).all()


def test_sieve_grows_with_the_listed_keys(spark):
    rng = np.random.default_rng(4)
    keys = rng.integers(-(1 << 63), 1 << 63, 3000)
    bits, dropped = L._sieve(spark.createDataFrame([(int(k),) for k in keys], "key long"), 3000)
    assert dropped == 44 and len(bits) == (1 << 20) // 8
    at = keys.view(np.uint64) >> np.uint64(dropped)
    assert (np.unpackbits(bits)[at.astype(np.int64)] == 1).all() and np.unpackbits(bits).sum() == len(np.unique(at))
