import math
import re
from collections import Counter

from recsql.llm import rules as R


def base(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
    count, covered = Counter(grams), set()
    for k, g in enumerate(grams):
        if count[g] > 1:
            covered.update(range(k, k + 5))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def measured(df):
    return Counter((r.doc_id, tuple(r[m] for m in R.MEASURES)) for r in R.measures(df).collect())


def test_measures(spark, documents, edge_docs):
    odd = ["a b c d e a b c d e", "x x x x x x", "a b c d e f a b c d e g a b c d e", "l\nl\n\n \nl \nm", "#<>|&% $*# a|b",
           "a b c d e b c d e a b c d e", "one two three four five six one two three four five"]
    tricky = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    for docs in (documents, edge_docs, tricky):
        assert measured(docs) == Counter((r.doc_id, base(r.text)) for r in docs.collect())


def em(patterns):
    prior, good, bad = R.START_PRIOR, [R.START_GOOD] * len(R.RULES), [R.START_BAD] * len(R.RULES)
    clip = lambda p: min(max(p, 0.002), 0.998)

    def posterior(v):
        z = math.log(prior / (1 - prior))
        z += sum(math.log(good[j] / (1 - bad[j])) if x == 1 else math.log((1 - good[j]) / bad[j])
                 for j, x in enumerate(v) if x >= 0)
        return 1 / (1 + math.exp(-z))

    for _ in range(R.ROUNDS):
        q = {v: posterior(v) for v in patterns}
        mass = lambda j, vote, w: sum(n * w(q[v]) for v, n in patterns.items() if (v[j] >= 0 if vote is None else v[j] == vote))
        prior = clip(sum(n * q[v] for v, n in patterns.items()) / sum(patterns.values()))
        one, zero = (lambda x: x), (lambda x: 1 - x)
        good = [clip((mass(j, 1, one) + R.START_GOOD) / (mass(j, None, one) + 1)) for j in range(len(R.RULES))]
        bad = [clip((mass(j, 0, zero) + R.START_BAD) / (mass(j, None, zero) + 1)) for j in range(len(R.RULES))]
    return {v: posterior(v) for v in patterns}


def test_expectation_maximisation(documents):
    rows = R.judge(documents).collect()
    want = em(Counter(tuple(r.votes) for r in rows))
    for r in rows:
        assert abs(r.posterior - want[tuple(r.votes)]) < 1e-9
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed and r.posterior >= 0.5)


def test_keeps_clean_documents(spark, documents, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = R.judge(documents).join(labels, "doc_id").collect()
    assert all(r.kept for r in rows if r.quality == 1 and not r.base_failed)
    assert not any(r.kept for r in rows if r.quality == 0)


def test_edges(edge_docs, empty_docs):
    rows = R.judge(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert not any(r.kept for r in rows if r.doc_id in (1, 2, 3)) and all(r.base_failed for r in rows if r.doc_id in (1, 2, 3))
    assert len({r.posterior for r in rows if r.doc_id == 8}) == 1
    assert R.judge(empty_docs).collect() == []


def test_runs_no_python(documents):
    plan = R.measures(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
