"""DuckDB SQL for queries whose results SQL can express, written independently
of the operators: self-joins, windows and recursion over whole texts."""

from __future__ import annotations

from .rules import ROUNDS, RULES, START_BAD, START_GOOD, START_PRIOR
from .secrets import ACCESS, ASSIGN, HEX, MIXED, SPREAD, VARIED, WIDELY

WORDS = r"list_filter(regexp_split_to_array({t}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

JACCARD = r"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS r, doc_id, """ + WORDS.format(
    t="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')") + r""" AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT r, array_to_string(w[k:k + 2], ' ') AS s
     FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 2))) AS k FROM t WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
l AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM s a JOIN s b ON a.s = b.s AND a.r < b.r JOIN n na ON na.r = a.r JOIN n nb ON nb.r = b.r
     GROUP BY a.r, b.r, na.n, nb.n HAVING 100 * count(*) >= 90 * (na.n + nb.n - count(*))),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(a, b) AS (SELECT r, r FROM n UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
low AS (SELECT reach.a AS r, min(t.doc_id) AS component_id FROM reach JOIN t ON t.r = reach.b GROUP BY reach.a)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(low.component_id, t.doc_id) AS component_id
FROM t LEFT JOIN n ON n.r = t.r LEFT JOIN low ON low.r = t.r
"""


def rules() -> str:
    votes = ", ".join(f"CASE WHEN {good} THEN 1 WHEN {bad} THEN 0 ELSE -1 END" for _, good, bad in RULES)
    k = len(RULES)

    def share(j: int, vote: int, weight: str, start: float) -> str:
        hit = f"sum(CASE WHEN votes[{j}] = {vote} THEN n * {weight} ELSE 0 END)"
        seen = f"sum(CASE WHEN votes[{j}] >= 0 THEN n * {weight} ELSE 0 END)"
        return f"least(greatest(({hit} + {start}) / ({seen} + 1), 0.002), 0.998)"

    good = "[" + ", ".join(share(j, 1, "q", START_GOOD) for j in range(1, k + 1)) + "]"
    bad = "[" + ", ".join(share(j, 0, "(1 - q)", START_BAD) for j in range(1, k + 1)) + "]"
    post = (f"1 / (1 + exp(-(ln(prior / (1 - prior)) + list_sum(list_transform(range(1, {k + 1}), lambda j: CASE WHEN votes[j] = 1 "
            "THEN ln(good[j] / (1 - bad[j])) WHEN votes[j] = 0 THEN ln((1 - good[j]) / bad[j]) ELSE 0 END)))))")
    return r"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
p AS MATERIALIZED (SELECT r, doc_id, t, """ + WORDS.format(t="t") + r""" AS w,
     list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
g AS (SELECT r, k, array_to_string(w[k:k + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS k FROM p WHERE len(w) >= 5)),
twice AS (SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT k + d) AS n FROM twice CROSS JOIN (SELECT unnest(range(0, 5)) AS d) GROUP BY r),
m AS MATERIALIZED (SELECT p.r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
     length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
     coalesce(rep.n, 0) AS n_repeat_words, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals, len(list_distinct(w)) AS n_distinct,
     length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclaims, length(regexp_replace(t, '[\p{L}\x20\x09-\x0D]', '', 'g')) AS n_others
     FROM p LEFT JOIN rep ON rep.r = p.r),
v AS MATERIALIZED (SELECT *, [""" + votes + r"""] AS votes FROM m),
pats AS MATERIALIZED (SELECT votes, CAST(count(*) AS DOUBLE) AS n FROM v GROUP BY votes),
em(it, prior, good, bad) AS (
  SELECT 0, CAST(""" + f"{START_PRIOR} AS DOUBLE), list_transform(range(0, {k}), lambda x: CAST({START_GOOD} AS DOUBLE)), " \
        f"list_transform(range(0, {k}), lambda x: CAST({START_BAD} AS DOUBLE))" + r"""
  UNION ALL SELECT it + 1, least(greatest(sum(n * q) / sum(n), 0.002), 0.998), """ + good + ", " + bad + r"""
  FROM (SELECT it, votes, n, """ + post + f" AS q FROM em CROSS JOIN pats WHERE it < {ROUNDS}) GROUP BY it)," + r"""
fit AS (SELECT votes, """ + post + f" AS posterior FROM em CROSS JOIN pats WHERE it = {ROUNDS})" + r"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND posterior >= 0.5 AS kept
FROM v JOIN fit ON fit.votes = v.votes
"""


def secrets() -> str:
    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    def located(pattern: str) -> str:
        p = quoted(pattern)
        found, gaps = f"regexp_extract_all(t, {p})", f"regexp_split_to_array(t, {p})"
        return (f"list_transform(range(1, len({found}) + 1), lambda i: {{'s': list_sum(list_transform({gaps}[1:i], lambda x: length(x))) "
                f"+ coalesce(list_sum(list_transform({found}[1:i - 1], lambda x: length(x))), 0), 'm': {found}[i]}})")

    token = f"[A-Za-z0-9+/_=-]{{{MIXED},}}"
    return r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner,
                  coalesce(source, '') || chr(0) || coalesce(lang, '') AS repo FROM documents),
f AS (SELECT r, doc_id, owner, repo, 0 AS kind, unnest(""" + located(ASSIGN) + r""") AS x FROM t
      UNION ALL SELECT r, doc_id, owner, repo, 1, unnest(""" + located(ACCESS) + r""") FROM t
      UNION ALL SELECT r, doc_id, owner, repo, 2, unnest(""" + located(HEX) + r""") FROM t
      UNION ALL SELECT r, doc_id, owner, repo, 3, unnest(""" + located(token) + r""") FROM t),
h AS (SELECT r, owner, repo, kind, CAST(x.s AS BIGINT) AS s, CAST(x.s + length(x.m) AS BIGINT) AS e,
             CASE WHEN kind = 0 THEN regexp_extract(x.m, """ + quoted(ASSIGN) + r""", 2) ELSE x.m END AS v FROM f),
k AS MATERIALIZED (SELECT * FROM h WHERE (kind <> 0 OR length(v) >= 8)
      AND (kind <> 3 OR (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')))),
verdict AS (SELECT v, count(DISTINCT repo) AS n_repos, count(DISTINCT owner) >= """ + f"{WIDELY} OR count(DISTINCT repo) >= {SPREAD} AS example, NOT example " + r"""
      AND len(list_distinct(string_split(v, ''))) >= """ + f"{VARIED}" + r""" AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AS live
      FROM k GROUP BY v),
b AS (SELECT * FROM k WHERE kind < 3),
o AS (SELECT k.* FROM k JOIN verdict USING (v) WHERE kind = 3 AND live
      AND NOT EXISTS (SELECT 1 FROM b WHERE b.r = k.r AND b.s < k.e AND k.s < b.e)),
a AS (SELECT DISTINCT r, s, kind, e FROM (SELECT * FROM b UNION ALL SELECT * FROM o)),
names AS (SELECT r, s, kind, e, ['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || s || ':' || e AS span FROM a),
spans AS (SELECT r, string_agg(span, ',' ORDER BY s, kind) AS spans, string_agg(CASE WHEN kind < 3 THEN span END, ',' ORDER BY s, kind) AS base
          FROM names GROUP BY r),
counts AS (SELECT r, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2,
           count(*) FILTER (example) AS n_examples, count(*) FILTER (live) AS n_live, max(n_repos) AS max_repos FROM b JOIN verdict USING (v) GROUP BY r)
SELECT t.doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_examples, 0) AS n_examples, coalesce(n_live, 0) AS n_live, coalesce(max_repos, 0) AS max_repos
FROM t LEFT JOIN spans ON spans.r = t.r LEFT JOIN counts ON counts.r = t.r
"""


COLLOCATIONS = r"""
WITH t AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM t),
w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
u AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS k FROM w),
g AS (SELECT lang, m, array_to_string(w[k:k + m - 1], ' ') AS phrase, any_value(w[k:k + m - 1]) AS w, count(*) AS a
      FROM u CROSS JOIN (VALUES (1), (2), (3)) AS x(m) WHERE k + m - 1 <= len(w) GROUP BY ALL),
f AS MATERIALIZED (SELECT *, lang || chr(10) || phrase AS key FROM g),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT * FROM f WHERE m > 1 AND a >= 10),
parts AS MATERIALIZED (SELECT lang, phrase, m, a, k, lang || chr(10) || array_to_string(w[1:k], ' ') AS head,
                 lang || chr(10) || array_to_string(w[k + 1:], ' ') AS rest
          FROM c CROSS JOIN (VALUES (1), (2)) AS v(k) WHERE k < m),
cuts AS (SELECT p.lang, p.phrase, p.m, p.a, x.a AS l, y.a AS r, k,
                (1000000::HUGEINT * p.a * p.a) // (x.a::HUGEINT * y.a) AS score
         FROM parts p JOIN f x ON x.key = p.head JOIN f y ON y.key = p.rest),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (SELECT lang, phrase, max(a) AS around FROM (
             SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM c WHERE m = 3
             UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM c WHERE m = 3) GROUP BY lang, phrase),
kept AS (SELECT b.* FROM best b LEFT JOIN around o ON b.m = 2 AND o.lang = b.lang AND o.phrase = b.phrase
         WHERE o.around IS NULL OR 100 * o.around < 50 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a, l, r, n, CAST(score AS BIGINT) AS score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""

TERMS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
        r"'[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"

SEARCH = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, """ + TERMS + r""" AS w FROM documents),
s AS (SELECT count(*) AS n_docs, CAST(coalesce(sum(len(w)), 0) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
q AS MATERIALIZED (SELECT DISTINCT item_id, unnest(""" + TERMS + r""") AS term FROM benchmark),
v AS (SELECT DISTINCT term FROM q),
t AS MATERIALIZED (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
      FROM (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM d) SEMI JOIN v USING (term) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM t CROSS JOIN s GROUP BY term, n_docs),
x AS MATERIALIZED (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))) AS x
      FROM t JOIN w USING (term) CROSS JOIN s),
found AS (SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(x) AS BIGINT) AS score FROM q JOIN x USING (term) GROUP BY item_id, r)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
FROM found WHERE score > 0 QUALIFY rank <= 50
"""
