import re
from collections import Counter

from recsql.llm.collocations import mine_collocations


def brute(rows, most=3, least=10, top=2000):
    f = Counter()
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda x: x[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, most + 1):
                f.update((lang or "und", tuple(w[i:i + m])) for i in range(len(w) - m + 1))
    n = Counter()
    for (lang, w), a in f.items():
        n[lang] += a if len(w) == 1 else 0
    cands = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    hidden = set()
    for (lang, w), a in cands.items():
        for m in range(2, len(w)):
            hidden.update((lang, w[s:s + m]) for s in range(len(w) - m + 1) if 100 * a >= 50 * cands[lang, w[s:s + m]])
    out = {}
    for (lang, w), a in cands.items():
        if (lang, w) not in hidden:
            score, _, l, r = min((1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                                 for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return {(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0])
            for lang, found in out.items() for i, x in enumerate(sorted(found)[:top])}


def check(docs, **params):
    got = [tuple(r) for r in mine_collocations(docs, **params).collect()]
    want = brute([(r.text, r.lang) for r in docs.select("text", "lang").collect()],
                 params.get("max_words", 3), params.get("min_count", 10), params.get("top", 2000))
    assert len(got) == len(set(got)) and set(got) == want
    return got


def test_against_brute_force(documents):
    assert check(documents)
    assert check(documents, max_words=4, min_count=3, top=50, turns=3)


def test_edge_rows(edge_docs, empty_docs):
    check(edge_docs)
    assert mine_collocations(empty_docs).collect() == []


def test_pieces_languages_and_ties(spark):
    rows = [("A b. a B, a\tb c!\rx y\x0bx y", "en")] * 4 + [("a b", None)] * 12 + [(None, "en"), ("a b", "und"), ("é ñ É ñ é", "fr")] * 5
    got = check(spark.createDataFrame(rows, "text string, lang string"))
    assert ("und", 1, "a b", 17, 17, 17, 34, 1000000) in got
