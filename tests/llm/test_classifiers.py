"""Quality (held-out accuracy), toxicity (held-out accuracy), their edges."""

import math

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from recsql.llm import quality as Q
from recsql.llm import toxicity as T
from recsql.llm.queries import held_out
from recsql.llm.scratch import Scratch

LARGER = "/root/testdata/sf0.01"


def auc(scores, labels):
    scores, labels = np.asarray(scores), np.asarray(labels)
    return np.mean([[(p > n) + 0.5 * (p == n) for n in scores[labels == 0]] for p in scores[labels == 1]])


def judged(spark, fit, label, divisor, remainder):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    scores = fit(docs, labels.filter(~held_out(divisor, remainder)))
    rows = scores.join(labels.filter(held_out(divisor, remainder)), "doc_id").collect()
    assert scores.count() == docs.count()
    return [r.score for r in rows], [r[label] for r in rows]


def test_quality_of_held_out_documents(spark):
    scores, labels = judged(spark, Q.score_quality, "quality", 4, 2)
    assert min(scores) >= 0 and max(scores) <= 1
    assert auc(scores, labels) > 0.95
    assert np.mean((np.asarray(scores) >= 0.7) == np.asarray(labels)) > 0.92


def test_toxicity_of_held_out_documents(spark):
    scores, labels = judged(spark, T.score_toxicity, "toxic", 5, 0)
    assert min(scores) >= 0 and max(scores) <= 1
    assert auc(scores, labels) > 0.75  # 45 toxic documents to learn from here
    assert np.mean((np.asarray(scores) >= 0.5) == np.asarray(labels)) > 0.92


@pytest.mark.parametrize(("fit", "label"), [(Q.score_quality, "quality"), (T.score_toxicity, "toxic")])
def test_edges(spark, edge_docs, empty_docs, fit, label):
    labels = spark.createDataFrame(
        [(1, 0), (2, 1), (4, 1), (5, 0), (6, 1), (7, 0), (8, 1), (8, 1), (10, 0), (11, 1), (12, 0), (None, 1), (3, None), (99, 1)],
        f"doc_id long, {label} int")
    rows = fit(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in edge_docs.collect())
    assert len({r.score for r in rows if r.doc_id == 8}) == 1  # repeated rows
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1  # null and empty
    assert fit(empty_docs, labels).collect() == []
    none = fit(edge_docs, labels.filter("false")).collect()
    assert {r.score for r in none} == {0.5} and len(none) == len(rows)
    one_kind = fit(edge_docs, labels.filter(F.col(label) == 1)).collect()
    assert {r.score for r in one_kind} == {1.0}


def test_runs_of_bytes():
    tokens, first = Q._runs(pa.array(["The end!!", None, "", "é9 9\n\nTHE end", "The end!!"]))
    lens = np.diff(first).tolist()
    assert lens == [4, 0, 0, 6, 4] and tokens[:4].tolist() == tokens[-4:].tolist()
    assert tokens[2] == tokens[first[3] + 5]  # "end" in both
    assert tokens[first[3] + 1] == tokens[first[3] + 2] == 4


def test_contexts_count_neighbours():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["aa bb cc", "aa"])], names=["doc_id", "text"])
    (table,) = list(Q._contexts()(iter([batch])))
    place, sign = Q.index_vectors()
    tokens, _ = Q._runs(batch.column(1))
    a, b, c = tokens[:3]
    got = {w: np.asarray([table.column(d + 1)[i].as_py() for d in range(Q.DIMS)]) for i, w in enumerate(table.column(0).to_pylist())}
    for word, others in ((a, (b, c)), (b, (a, c)), (c, (a, b))):
        want = np.zeros(Q.DIMS)
        for o in others:
            np.add.at(want, place[o], sign[o])
        assert (got.get(int(word), np.zeros(Q.DIMS)) == want).all()


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 5))
    y = (rng.random(4000) < Q._sigmoid(2 * x[:, 0] - x[:, 1])).astype(float)
    p = Q.Network().fit(x, y).score(x)
    for lo in (0.1, 0.4, 0.7):
        inside = (p >= lo) & (p < lo + 0.2)
        assert abs(p[inside].mean() - y[inside].mean()) < 0.08


def test_windows_and_saved_bytes():
    assert T.windows(None) == T.windows("") == T.windows(" \n") == []
    assert len(T.windows("w " * 25)) == 3
    base, toxic = T.train_dictionaries([b" a calm and friendly text here "] * 50, [
        f" {w} horridword sits {w}{w} in here ".encode() for w in ("alpha", "beta", "gamma", "delta", "epsi")] * 4)
    distance = T.Distance(base, toxic)
    assert distance.features("you horridword sits there")[0] > 3
    assert distance.features("a calm and friendly text")[0] <= 0


@pytest.mark.parametrize("times", [1, 20])
def test_toxic_wording_that_ordinary_windows_also_have(times):
    ordinary = [f" calm text {k} {'reeuword' if k % 100 == 0 else 'friendly'} here ".encode() for k in range(500)] * times
    toxic = [f" {w} reeuword sits here ".encode() for w in ("alpha", "beta", "gamma", "delta", "epsi")] * 20 * times
    base, content = T.train_dictionaries(ordinary, toxic)
    assert content.endswith(base) and b"reeuword" in content[:len(content) - len(base)]
    assert b"here" not in content[:len(content) - len(base)]


def test_toxicity_scores_by_brute_force(spark):
    """Every score again from the dictionaries: one plain compressor a window."""
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").filter(~held_out(5, 0))
    shared, calibration = T.fit_toxicity(docs, labels, Scratch(spark))
    got = {r.doc_id: r.score for r in T.score_toxicity(docs, labels).collect()}
    params = zstandard.ZstdCompressionParameters(
        window_log=16, hash_log=15, chain_log=15, search_log=4, min_match=4, strategy=zstandard.STRATEGY_LAZY2,
        write_checksum=False, write_content_size=False, write_dict_id=False)
    rows = docs.orderBy("doc_id").collect()[::90]

    def size(content: bytes, window: bytes) -> int:
        raw = zstandard.ZstdCompressionDict(b" " * (T.BASE_BYTES + T.TOXIC_BYTES - len(content)) + content,
                                            dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(compression_params=params, dict_data=raw).compress(window))

    for r in rows:
        words = r.text.lower().split() if r.text else []
        parts = [(" " + " ".join(words[i:i + 10]) + " ").encode() for i in range(0, len(words), 10)]
        saved = sorted((size(shared.value[0], w) - size(shared.value[1], w) for w in parts), reverse=True)
        x = [max(-4, min(24, s)) for s in saved[:3]] + [0] * max(0, 3 - len(saved))
        hits = [sum(s >= t for s in saved) for t in (1, 2, 3, 4, 6)]
        x += [math.log(1 + h) for h in hits] + [h / max(1, len(saved)) for h in hits] + [math.log(1 + len(saved))]
        z = sum(w * (v - m) / s for w, v, m, s in zip(calibration.w, x, calibration.mean, calibration.scale)) + calibration.w[-1]
        assert got[r.doc_id] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), abs=1e-9)
