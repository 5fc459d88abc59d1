import numpy as np

from recsql.llm import language as L
from recsql.llm.queries import held_out


def plain_grams(text):
    """n-grams of a text, letters in lower case, one gap at either end at most."""
    low = [" "] + [(c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text] + [" "]
    return [tuple(low[i:i + n]) for i in range(len(low)) for n in L.LENGTHS if i + n <= len(low) and " " not in low[i + 1:i + n - 1]]


def test_ngrams_match_plain_ones(monkeypatch):
    texts = ["Das Haus, d'une ÉTÉ 12 a", None, "", "...", "x", "漢字 ab", "one two three four " * 40]
    for chunk in (1 << 19, 16):
        monkeypatch.setattr(L, "_CHUNK", chunk)
        got: dict = {}
        for h, row in L.ngrams(texts):
            for x, r in zip(h.tolist(), row.tolist(), strict=True):
                got.setdefault(r, []).append(x)
        number: dict = {}
        for r, t in enumerate(texts):
            want = plain_grams(t) if t else []
            assert len(got.get(r, [])) == len(want)
            for gram, code in zip(sorted(want), [None] * len(want), strict=True):
                number.setdefault(gram, code)
            assert len(set(got.get(r, []))) == len(set(want))  # equal n-grams have equal hashes
        assert len({x for xs in got.values() for x in xs}) == len(number)


def test_filter_equals_exact_sets(spark, documents):
    """Popcounts agree with sets of n-grams but for chance hits, which the correction removes."""
    train = documents.filter(~held_out(4, 2)).limit(60)
    from recsql.llm.scratch import Scratch
    langs, masks = L.learn_filter(train, "text", "lang", 1e-5, 1 << 22, Scratch(spark))
    count = {x: {} for x in langs}
    for r in train.collect():
        for g in plain_grams(r.text or ""):
            count[r.lang][g] = count[r.lang].get(g, 0) + 1
    share = {x: {g: n / sum(c.values()) for g, n in c.items() if n >= 2 and n >= 1e-5 * sum(c.values())} for x, c in count.items()}
    most: dict = {}
    for c in share.values():
        for g, s in c.items():
            most[g] = max(most.get(g, 0), s)
    held = {x: {g for g, s in c.items() if s * L.RATIO >= most[g]} for x, c in share.items()}
    text = documents.filter("length(text) > 500").orderBy("doc_id").first().text
    grams = plain_grams(text)
    hashes = np.concatenate([h for h, _ in L.ngrams([text])])
    one, two = L._places(hashes, 1 << 22)
    found = masks[one] & masks[two]
    for k, x in enumerate(langs):
        exact = sum(g in held[x] for g in grams)
        got = int(((found[:, k // 8] >> (k % 8)) & 1).sum())
        assert exact <= got <= exact + 0.01 * len(grams)


def test_held_out_documents(spark, sf, documents):
    got = L.identify_languages(documents, documents.filter(~held_out(4, 2))).withColumnRenamed("doc_id", "d")
    rows = got.join(documents, got.d == documents.doc_id).filter(held_out(4, 2)).select("lang", "lang_pred", "score").collect()
    assert len(rows) > 30 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_edge_rows(spark, edge_docs, empty_docs, documents):
    train = documents.select("text", "lang").unionByName(spark.createDataFrame([(None, "en"), ("x", None), ("", "fr")], "text string, lang string"))
    got = [(r.doc_id, r.lang_pred, r.score) for r in L.identify_languages(edge_docs, train).collect()]
    assert len(got) == edge_docs.count()
    assert {x[0]: x[1:] for x in got if x[0] in (1, 2, 3)} == {1: ("und", 0.0), 2: ("und", 0.0), 3: ("und", 0.0)}
    assert all(x[1] in ("de", "en", "es", "fr") for x in got if x[0] not in (1, 2, 3))
    assert L.identify_languages(empty_docs, train).collect() == []
    assert {(r.lang_pred, r.score) for r in L.identify_languages(edge_docs, train.filter("false")).collect()} == {("und", 0.0)}


def test_many_languages(spark):
    """More than one byte of languages; each told by its own letters."""
    rows = [(k, " ".join(chr(0x4E00 + 40 * k + j) * 3 for j in range(6)), f"l{k:02d}") for k in range(20)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert all(r.lang_pred == f"l{r.doc_id:02d}" for r in L.identify_languages(docs, docs).collect())
