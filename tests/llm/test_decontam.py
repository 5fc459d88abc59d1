import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from recsql.llm import decontam as D


def shingles(t):
    w = re.findall("[a-z0-9\x80-\U0010ffff]+", (t or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(docs, items, num=80):
    sets = {i: shingles(t) for i, t in items}
    out = set()
    for d, t in docs:
        have = shingles(t)
        for i, s in sets.items():
            if s and 100 * len(s & have) >= num * len(s):
                out.add((i, d, len(s), len(s & have)))
    return out


def got(docs, items, **kw):
    rows = D.contained_items(docs, items, **kw).collect()
    assert all(r.containment == r.shared_shingles / r.item_shingles for r in rows)
    out = Counter((r.item_id, r.doc_id, r.item_shingles, r.shared_shingles) for r in rows)
    assert not out or max(out.values()) == 1
    return set(out)


def test_documents(spark, documents, sf):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert want and got(documents, items) == want


@pytest.mark.parametrize(("seed", "most"), [(8, 500_000), (64, 500_000), (3, 0)])
def test_short_items_in_long_documents(spark, seed, most, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_ROWS", most)  # 0: shuffle joins
    rng = random.Random(seed)
    items = [(i, " ".join(f"i{i}w{k}" for k in range(n))) for i, n in enumerate((3, 4, 5, 9, 20, 60, 140, 400, 900))]
    docs = []
    for d in range(60):
        words = [f"d{d}_{k}" for k in range(rng.choice((0, 30, 4000)))]
        for i, t in rng.sample(items, 3):
            part = t.split()
            if d % 3 == 1:  # a run of words is lost
                part = part[int(len(part) * rng.choice((0.1, 0.3))):]
            if d % 3 == 2:
                part = [w.upper() + "," for w in part]
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        docs.append((d, "\n".join(words)))
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert len(want) > 40 and got(a, b) == want


def test_edges(spark, edge_docs, empty_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "too few words"), (4, "The same ROW twice, over and over!"),
                                   (4, "The same ROW twice, over and over!"), (5, "word1 of the long text number 1")],
                                  "item_id long, text string").selectExpr("*", "1 AS h", "2 AS q", "'w' AS w")
    found = {(i, d) for i, d, _, _ in got(edge_docs, items)}
    assert found == {(4, 8), (4, 12), (5, 6)}
    assert got(empty_docs, items) == set() and got(edge_docs, items.filter("false")) == set()


def test_sketches_prune_the_given_items(spark, documents, sf):
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", D.plain_words(F.col("text")).alias("w"))
    texts = documents.select("doc_id", D.plain_words(F.col("text")).alias("w"))
    index = D.sketches(items, 80, 100).cache()
    every = D._rows(items, "item_id", values=D._hashes(F.col("w")), name="h").distinct()
    assert index.count() < 0.5 * every.count() and index.filter("needed < 1").count() == 0
    hits = D._rows(texts, "doc_id", values=D._hashes(F.col("w")), name="h").distinct()
    sharing = hits.join(every, "h").select("doc_id", "item_id").distinct()
    near = D.candidates(texts, index)
    assert near.join(sharing, ["doc_id", "item_id"], "left_anti").count() == 0
    assert near.count() <= sharing.count()
    # Values sent to the join, against all values of the documents.
    cut = index.agg(F.max("h")).first()[0]
    assert hits.filter(F.col("h") <= cut).count() < 0.8 * hits.count()


def test_sketches_tell_items_of_one_passage_apart(spark):
    """Items that share a third of their shingles with a text are no candidates."""
    items = [(i, " ".join(["the same opening words in every item here and now"] + [f"i{i}w{k}" for k in range(20)])) for i in range(40)]
    a = spark.createDataFrame([(1, items[0][1])], "doc_id long, text string").select("doc_id", D.plain_words(F.col("text")).alias("w"))
    b = spark.createDataFrame(items, "item_id long, text string").select("item_id", D.plain_words(F.col("text")).alias("w"))
    assert D.candidates(a, D.sketches(b, 80, 100)).count() < 40


def test_rows_without_an_id_and_no_python(spark):
    text = "a benchmark item of a few more than nine words stands here"
    docs = spark.createDataFrame([(None, text), (None, "nothing"), (1, "x " + text)], "doc_id long, text string")
    items = spark.createDataFrame([(7, text), (None, text)], "item_id long, text string")
    assert {d for _, d, _, _ in got(docs, items)} == {None, 1}
    plan = D.candidates(docs.select("doc_id", D.plain_words(F.col("text")).alias("w")), D.sketches(
        items.select("item_id", D.plain_words(F.col("text")).alias("w")), 80, 100))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
