"""Shared SQL (DuckDB dialect) for the oracle: the same views the Spark side
builds from the driver tables, as CTEs. Ratios are multiplied as DOUBLE so
``floor(n * ratio)`` rounds exactly like the Python/Spark side."""

RATINGS_RAW = """
ratings_raw AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST(LEAST(5, 1 + FLOOR((l_quantity - 1) / 10)) AS INTEGER) AS rating,
         CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 86400 AS "timestamp",
         l_orderkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

RATINGS = RATINGS_RAW + """,
ratings AS (
  SELECT user_id, item_id, rating, "timestamp" FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, item_id
       ORDER BY "timestamp" DESC, l_orderkey DESC, l_linenumber DESC, rating DESC) AS rn_ FROM ratings_raw)
  WHERE rn_ = 1)"""

ITEMS = """
items_base AS (
  SELECT p_partkey AS item_id, concat(p_name, ' (', CAST(1950 + p_size AS VARCHAR), ')') AS title,
         replace(p_name, ' ', '|') AS genres FROM part),
cache AS (
  SELECT p_partkey AS item_id, concat('tt', lpad(CAST(p_partkey AS VARCHAR), 7, '0')) AS tconst,
         concat(p_type, ',', split_part(p_name, ' ', -1)) AS imdb_genres,
         CAST(p_size AS VARCHAR) AS runtime, p_name AS orig_title FROM part),
items AS (
  SELECT b.item_id, b.title,
         CASE WHEN len(fz) > 0 THEN array_to_string(fz, '|') ELSE coalesce(b.genres, '') END AS genres,
         TRY_CAST(NULLIF(regexp_extract(b.title, '\\((\\d{4})\\)', 1), '') AS INTEGER) AS release_year,
         coalesce(c.imdb_genres, '') AS imdb_genres,
         CASE WHEN regexp_full_match(coalesce(c.runtime, ''), '[0-9]+') THEN TRY_CAST(c.runtime AS INTEGER) END AS runtime
  FROM (SELECT b.*, c.imdb_genres AS ig_,
          list_sort(list_distinct(list_concat(
            list_filter(list_transform(string_split(coalesce(b.genres, ''), '|'), lambda x: trim(x)), lambda x: x <> ''),
            list_filter(list_transform(string_split(coalesce(c.imdb_genres, ''), ','), lambda x: trim(x)), lambda x: x <> '')))) AS fz
        FROM items_base b LEFT JOIN cache c ON b.item_id = c.item_id) b
  LEFT JOIN cache c ON b.item_id = c.item_id)"""

USERS = """
users AS (
  SELECT c_custkey AS user_id, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         CASE CAST(c_custkey % 7 AS INTEGER) WHEN 0 THEN 1 WHEN 1 THEN 18 WHEN 2 THEN 25 WHEN 3 THEN 35
              WHEN 4 THEN 45 WHEN 5 THEN 50 ELSE 56 END AS age,
         c_nationkey AS occupation, right(c_name, 5) AS zip_code FROM customer)"""


def time_fold(src: str, ratio: float = 0.2) -> str:
    return f"""SELECT user_id, item_id, rating, "timestamp",
       CASE WHEN rn_ > n_ - GREATEST(1, CAST(FLOOR(n_ * CAST({ratio} AS DOUBLE)) AS BIGINT)) THEN 'test' ELSE 'train' END AS fold
     FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", item_id) AS rn_,
                  count(*) OVER (PARTITION BY user_id) AS n_ FROM {src})"""


SPLIT = RATINGS + """,
ulist_ AS (
  SELECT user_id, row_number() OVER (ORDER BY md5(concat('42|', CAST(user_id AS VARCHAR))), user_id) AS pos_,
         count(*) OVER () AS n_ FROM (SELECT DISTINCT user_id FROM ratings)),
cold_users AS (SELECT user_id FROM ulist_ WHERE pos_ <= GREATEST(1, FLOOR(n_ * CAST(0.1 AS DOUBLE)))),
warm_ AS (SELECT * FROM ratings WHERE user_id NOT IN (SELECT user_id FROM cold_users)),
split AS (""" + time_fold("warm_") + """
  UNION ALL SELECT user_id, item_id, rating, "timestamp", 'cold' FROM ratings
  WHERE user_id IN (SELECT user_id FROM cold_users)),
train AS (SELECT user_id, item_id, rating, "timestamp" FROM split WHERE fold = 'train'),
test AS (SELECT user_id, item_id, rating, "timestamp" FROM split WHERE fold = 'test'),
cold AS (SELECT user_id, item_id, rating, "timestamp" FROM split WHERE fold = 'cold'),
mu AS (SELECT AVG(CAST(rating AS DOUBLE)) AS mu FROM train)"""

POP = """,
pop AS (
  SELECT item_id, COUNT(*) AS n, AVG(CAST(rating AS DOUBLE)) AS mean,
         (COUNT(*) * AVG(CAST(rating AS DOUBLE)) + 5 * ANY_VALUE(mu)) / (COUNT(*) + 5) AS score
  FROM train CROSS JOIN mu GROUP BY item_id)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip().lstrip(",").strip() for p in parts if p.strip())


def ranking_ctes(recs: str, truth: str, k: int = 10, p: str = "") -> str:
    """Per-user E2-E6 over users with relevant items and a non-empty list."""
    return f""",
{p}rel_ AS (SELECT DISTINCT user_id, item_id FROM {truth} WHERE rating >= 4),
{p}nrel_ AS (SELECT user_id, count(*) AS n_rel FROM {p}rel_ GROUP BY 1),
{p}er_ AS (SELECT user_id, rank, item_id FROM {recs} WHERE rank <= {k} AND user_id IN (SELECT user_id FROM {p}nrel_)),
{p}hits_ AS (SELECT e.user_id, e.rank, e.item_id, CASE WHEN x.item_id IS NOT NULL THEN 1 ELSE 0 END AS hit
          FROM {p}er_ e LEFT JOIN {p}rel_ x ON e.user_id = x.user_id AND e.item_id = x.item_id),
{p}cum_ AS (SELECT *, sum(hit) OVER (PARTITION BY user_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ch
         FROM {p}hits_),
{p}per_ AS (SELECT c.user_id, n.n_rel, CAST(sum(hit) AS DOUBLE) AS hits, sum(hit / log2(rank + 1)) AS dcg,
                sum(CASE WHEN hit = 1 THEN ch / rank ELSE 0 END) AS ap
         FROM {p}cum_ c JOIN {p}nrel_ n ON c.user_id = n.user_id GROUP BY c.user_id, n.n_rel),
{p}pm_ AS (SELECT user_id, n_rel, hits, hits / {k} AS precision, hits / n_rel AS recall,
               CASE WHEN hits > 0 THEN 1.0 ELSE 0.0 END AS hitrate,
               dcg / list_sum(list_transform(range(1, LEAST(n_rel, {k}) + 1), lambda i: 1 / log2(i + 1))) AS ndcg,
               ap / LEAST(n_rel, {k}) AS map FROM {p}per_)"""


def eval_ctes(preds: str, recs: str, k: int = 10, p: str = "") -> str:
    """E1 as a long (metric, value) CTE named ``{p}metrics_``."""
    rk = "\n".join(f"  UNION ALL SELECT '{m}@{k}', coalesce(round(avg({m}), 5), 0) FROM {p}pm_"
                   for m in ("precision", "recall", "hitrate", "ndcg", "map"))
    return ranking_ctes(recs, "test", k, p) + f""",
{p}g_ AS (SELECT item_id, list_distinct(string_split(coalesce(genres, ''), '|')) AS g FROM items),
{p}pairs_ AS (
  SELECT 1 - CASE WHEN len(list_distinct(list_concat(ga_, gb_))) > 0
                  THEN len(list_intersect(ga_, gb_)) / len(list_distinct(list_concat(ga_, gb_))) ELSE 0 END AS d
  FROM (SELECT coalesce(ga.g, []) AS ga_, coalesce(gb.g, []) AS gb_
        FROM {p}er_ a JOIN {p}er_ b ON a.user_id = b.user_id AND a.rank < b.rank
        LEFT JOIN {p}g_ ga ON a.item_id = ga.item_id LEFT JOIN {p}g_ gb ON b.item_id = gb.item_id)),
{p}ip_ AS (SELECT item_id, count(*) AS pop FROM train GROUP BY 1),
{p}metrics_ AS (
  SELECT 'rmse' AS metric, round(sqrt(avg((rating - prediction) * (rating - prediction))), 5) AS value FROM {preds}
  UNION ALL SELECT 'mae', round(avg(abs(rating - prediction)), 5) FROM {preds}
{rk}
  UNION ALL SELECT 'coverage', round((SELECT count(DISTINCT item_id) FROM {p}er_) / (SELECT count(DISTINCT item_id) FROM items), 5)
  UNION ALL SELECT 'diversity', round(coalesce((SELECT avg(d) FROM {p}pairs_), 0), 5)
  UNION ALL SELECT 'novelty', round(coalesce((SELECT avg(-log2(coalesce(q.pop, 1) / (SELECT count(DISTINCT user_id) FROM train)))
                                              FROM {p}er_ e LEFT JOIN {p}ip_ q ON e.item_id = q.item_id), 0), 5)
  UNION ALL SELECT 'eval_users', (SELECT count(*) FROM {p}pm_)
  UNION ALL SELECT 'eval_empty_rec', (SELECT count(*) FROM {p}nrel_) - (SELECT count(*) FROM {p}pm_)
  UNION ALL SELECT 'eval_user_coverage', CASE WHEN (SELECT count(*) FROM {p}nrel_) > 0
       THEN round((SELECT count(*) FROM {p}pm_) / (SELECT count(*) FROM {p}nrel_), 5) ELSE 0 END
  UNION ALL SELECT 'eval_rel_size_mean', coalesce(round((SELECT avg(n_rel) FROM {p}pm_), 3), 0))"""


def cold_eval_ctes(recs: str, k: int = 10) -> str:
    rk = "\n".join(f"  UNION ALL SELECT 'cold_{m}@{k}', coalesce(round(avg({m}), 5), 0) FROM c_pm_"
                   for m in ("precision", "recall", "hitrate", "ndcg", "map"))
    return ranking_ctes(recs, "cold", k, "c_") + f""",
cmetrics_ AS (
  SELECT 'cold_users' AS metric, CAST((SELECT count(*) FROM c_nrel_) AS DOUBLE) AS value
{rk}
  UNION ALL SELECT 'cold_eval_users', (SELECT count(*) FROM c_pm_)
  UNION ALL SELECT 'cold_empty_rec', (SELECT count(*) FROM c_nrel_) - (SELECT count(*) FROM c_pm_)
  UNION ALL SELECT 'cold_serve_rate', CASE WHEN (SELECT count(*) FROM c_nrel_) > 0
       THEN round((SELECT count(*) FROM c_pm_) / (SELECT count(*) FROM c_nrel_), 5) ELSE 0 END)"""


CONTENT = """,
docs_ AS (SELECT item_id, regexp_extract_all(lower(coalesce(genres, '')), '[a-z0-9]+') AS toks FROM items),
ndocs_ AS (SELECT count(*) AS n_docs FROM docs_),
tf_ AS (SELECT item_id, term, count(*) AS c, any_value(len_) AS len_
        FROM (SELECT item_id, len(toks) AS len_, unnest(toks) AS term FROM docs_) GROUP BY item_id, term),
idf_ AS (SELECT term, ln((1 + any_value(n_docs)) / (1 + count(*))) + 1 AS idf FROM tf_ CROSS JOIN ndocs_ GROUP BY term),
w_ AS (SELECT item_id, term, c / len_ * idf AS w FROM tf_ JOIN idf_ USING (term)),
ivec_ AS (SELECT item_id, term, w / (sqrt(sum(w * w) OVER (PARTITION BY item_id)) + 1e-9) AS weight FROM w_),
hl_ AS (SELECT user_id, max(CASE WHEN rating >= 4 THEN 1 ELSE 0 END) AS hl FROM train GROUP BY 1),
used_ AS (SELECT t.user_id, t.item_id, CAST(t.rating AS DOUBLE) AS r FROM train t JOIN hl_ ON t.user_id = hl_.user_id
          WHERE (t.rating >= 4 OR hl_.hl = 0) AND t.item_id IN (SELECT item_id FROM docs_)),
wsum_ AS (SELECT user_id, sum(r) AS w_sum FROM used_ GROUP BY 1),
avg_ AS (SELECT u.user_id, v.term, sum(u.r * v.weight) / any_value(ws.w_sum) AS a
         FROM used_ u JOIN ivec_ v ON u.item_id = v.item_id JOIN wsum_ ws ON u.user_id = ws.user_id GROUP BY u.user_id, v.term),
prof_ AS (SELECT user_id, term, a / (sqrt(sum(a * a) OVER (PARTITION BY user_id)) + 1e-9) AS weight FROM avg_),
cscore_ AS (SELECT p.user_id, v.item_id, sum(p.weight * v.weight) AS score FROM prof_ p JOIN ivec_ v ON p.term = v.term GROUP BY 1, 2)"""


def content_recs(users: str, name: str = "content_recs", k: int = 10) -> str:
    return f""",
{name}_cand AS (SELECT u.user_id, d.item_id, coalesce(s.score, 0) AS score
  FROM (SELECT user_id FROM wsum_ WHERE user_id IN (SELECT user_id FROM {users})) u CROSS JOIN docs_ d
  LEFT JOIN cscore_ s ON s.user_id = u.user_id AND s.item_id = d.item_id
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = d.item_id)),
{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank
  FROM {name}_cand) WHERE rank <= {k})"""


CONTENT_PREDS = """,
ccos_ AS (SELECT t.user_id, t.item_id, sum(v.weight * p.weight) AS cos FROM test t JOIN ivec_ v ON t.item_id = v.item_id
          JOIN prof_ p ON p.user_id = t.user_id AND p.term = v.term GROUP BY 1, 2),
content_preds_ AS (SELECT t.user_id, t.item_id, t.rating,
  CASE WHEN t.user_id IN (SELECT user_id FROM wsum_) AND t.item_id IN (SELECT item_id FROM docs_)
       THEN LEAST(5, GREATEST(1, mu.mu + coalesce(c.cos, 0))) ELSE mu.mu END AS prediction
  FROM test t LEFT JOIN ccos_ c ON t.user_id = c.user_id AND t.item_id = c.item_id CROSS JOIN mu)"""


def itemcf(n: int = 50) -> str:
    return f""",
inorm_ AS (SELECT item_id, sqrt(sum(CAST(rating AS DOUBLE) * rating)) + 1e-9 AS nrm FROM train GROUP BY 1),
dots_ AS (SELECT a.item_id AS i, b.item_id AS j, sum(CAST(a.rating AS DOUBLE) * b.rating) AS d
          FROM train a JOIN train b ON a.user_id = b.user_id AND a.item_id <> b.item_id GROUP BY 1, 2),
sim_ AS (SELECT i, j, d / (ni.nrm * nj.nrm) AS sim FROM dots_ JOIN inorm_ ni ON ni.item_id = i JOIN inorm_ nj ON nj.item_id = j),
nbr_ AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY round(sim, 9) DESC, j) AS nrank
         FROM sim_ WHERE sim > 0) WHERE nrank <= {n})"""


ITEMCF_PREDS = """,
icf_p_ AS (SELECT t.user_id, t.item_id, sum(n.sim * tr.rating) AS num, sum(n.sim) AS den FROM test t
           JOIN nbr_ n ON n.i = t.item_id JOIN train tr ON tr.user_id = t.user_id AND tr.item_id = n.j GROUP BY 1, 2),
icf_preds_ AS (SELECT t.user_id, t.item_id, t.rating,
  CASE WHEN p.den IS NOT NULL THEN p.num / (p.den + 1e-9) ELSE mu.mu END AS prediction
  FROM test t LEFT JOIN icf_p_ p ON t.user_id = p.user_id AND t.item_id = p.item_id CROSS JOIN mu)"""


def itemcf_recs(users: str, name: str = "icf_recs", k: int = 10) -> str:
    return f""",
{name}_s AS (SELECT tr.user_id, n.i AS item_id, sum(n.sim * tr.rating) AS score FROM train tr JOIN nbr_ n ON n.j = tr.item_id
             WHERE tr.user_id IN (SELECT user_id FROM {users}) GROUP BY 1, 2),
{name}_c AS (SELECT u.user_id, ti.item_id, coalesce(s.score, 0) AS score
  FROM (SELECT DISTINCT user_id FROM train WHERE user_id IN (SELECT user_id FROM {users})) u
  CROSS JOIN (SELECT DISTINCT item_id FROM train) ti
  LEFT JOIN {name}_s s ON s.user_id = u.user_id AND s.item_id = ti.item_id
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = ti.item_id)),
{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank
  FROM {name}_c) WHERE rank <= {k})"""
