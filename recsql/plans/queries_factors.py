"""Registered queries: factor models (MF by DSGD, biased ALS, pyspark.ml ALS,
hybrid) at the reference's default parameters. A full fit is not
SQL-expressible (rows-only checks); the ``*_exact`` queries fit the same code
with two factors and two epochs, which SQL can unroll, and compare factors,
predictions and rankings value by value."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..models import als, hybrid, mf
from ..operators import evaluate as EV
from . import oracle_base as B
from .queries_content import CBASE
from .queries_models import K, RECS_OUT, _recs_out
from .registry import _round_doubles, query

MF_FULL = dict(n_factors=50, n_epochs=20, lr=0.005, reg=0.02, seed=42)
ALS_FULL = dict(n_factors=50, n_epochs=15, reg=0.1, seed=42)
HYB_FULL = dict(alpha=0.6, cf_params=MF_FULL)


def _hyb(c):
    return c.model("hybrid", **HYB_FULL)


def _factors(m):
    norm = F.sqrt(F.aggregate(F.col("vec"), F.lit(0.0), lambda a, x: a + x * x))
    u = m.users.select(F.lit("user").alias("side"), F.col("user_id").alias("id"), "bias", norm.alias("vec_norm"))
    i = m.items.select(F.lit("item").alias("side"), F.col("item_id").alias("id"), "bias", norm.alias("vec_norm"))
    return _round_doubles(u.unionByName(i))


def _preds(mod, m, c):
    return _round_doubles(mod.predict(m, c.test.select("user_id", "item_id", F.col("rating").cast("bigint"))))


@query("m5_mf_factors")
def m5_mf_factors(c):
    return _factors(c.model("svd", **MF_FULL))


@query("m6_mf_predict")
def m6_mf_predict(c):
    return _preds(mf, c.model("svd", **MF_FULL), c)


@query("m6_mf_recommend")
def m6_mf_recommend(c):
    return _recs_out(mf.recommend(c.model("svd", **MF_FULL), c.ratings.select("user_id").distinct(), K))


@query("e1_evaluate_mf")
def e1_evaluate_mf(c):
    return _round_doubles(EV.evaluate(mf, c.model("svd", **MF_FULL), c.train, c.test, c.items, K))


@query("m7_als_factors")
def m7_als_factors(c):
    return _factors(c.model("als", **ALS_FULL))


@query("m8_als_predict")
def m8_als_predict(c):
    return _preds(als, c.model("als", **ALS_FULL), c)


@query("m8_als_recommend")
def m8_als_recommend(c):
    return _recs_out(als.recommend(c.model("als", **ALS_FULL), c.ratings.select("user_id").distinct(), K))


@query("e1_evaluate_als")
def e1_evaluate_als(c):
    return _round_doubles(EV.evaluate(als, c.model("als", **ALS_FULL), c.train, c.test, c.items, K))


@query("m7_als_ml_recommend")
def m7_als_ml_recommend(c):
    key = ("als_ml", tuple(sorted(ALS_FULL.items())))
    if key not in c.models:
        c.models[key] = als.fit_ml(c.train, c.items, **ALS_FULL)
    return _recs_out(als.recommend(c.models[key], c.ratings.select("user_id").distinct(), K))


@query("m11_hybrid_predict")
def m11_hybrid_predict(c):
    return _preds(hybrid, _hyb(c), c)


@query("m11_hybrid_recommend")
def m11_hybrid_recommend(c):
    return _recs_out(hybrid.recommend(_hyb(c), c.ratings.select("user_id").distinct(), K))


@query("e1_evaluate_hybrid")
def e1_evaluate_hybrid(c):
    return _round_doubles(EV.evaluate(hybrid, _hyb(c), c.train, c.test, c.items, K))


@query("e7_cold_eval_hybrid")
def e7_cold_eval_hybrid(c):
    return _round_doubles(EV.evaluate_cold(hybrid, _hyb(c), c.cold, K))


# Two factors, two epochs, two strata, a block pair's ratings as one batch.
MF_EXACT = dict(n_factors=2, n_epochs=2, n_strata=2, batch_size=None, init="md5")
ALS_EXACT = dict(n_factors=2, n_epochs=2, init="md5")


def _uniform(key: str, side: int, j: int, half: str) -> str:
    return f"(CAST(('0x' || substr(md5('42|{side}|' || {key} || '|{j}|{half}'), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0"


def _start(name: str, key: str, side: int) -> str:
    def normal(j):
        return (f"0.1 * sqrt(-2.0 * ln({_uniform(key, side, j, 'a')})) * cos(2 * pi() * {_uniform(key, side, j, 'b')})")
    return (f"{name} AS MATERIALIZED (SELECT {key}, {normal(1)} AS p1, {normal(2)} AS p2, CAST(0 AS DOUBLE) AS b "
            f"FROM (SELECT DISTINCT {key} FROM train))")


def _mf_ctes(lr: float = 0.005, reg: float = 0.02) -> str:
    block = "CAST(('0x' || substr(md5('b|' || {k}), 1, 13)) AS BIGINT) % 2"
    parts = ["mfmu_ AS MATERIALIZED (SELECT avg(CAST(rating AS DOUBLE)) AS mu FROM train)",
             f"mfr_ AS MATERIALIZED (SELECT user_id, item_id, CAST(rating AS DOUBLE) AS r, ({block.format(k='item_id')} - "
             f"{block.format(k='user_id')} + 2) % 2 AS s FROM train)", _start("u0_", "user_id", 1), _start("i0_", "item_id", 2)]
    for t in range(4):
        parts.append(f"""e{t}_ AS MATERIALIZED (SELECT x.user_id, x.item_id, u.p1 AS u1, u.p2 AS u2, u.b AS ub, i.p1 AS i1, i.p2 AS i2, i.b AS ib,
  x.r - mu - u.b - i.b - (u.p1 * i.p1 + u.p2 * i.p2) AS e FROM mfr_ x JOIN u{t}_ u ON u.user_id = x.user_id
  JOIN i{t}_ i ON i.item_id = x.item_id CROSS JOIN mfmu_ WHERE x.s = {t % 2})""")
        for name, key, own, other in (("u", "user_id", "u", "i"), ("i", "item_id", "i", "u")):
            parts.append(f"""{name}{t + 1}_ AS MATERIALIZED (SELECT o.{key}, o.p1 + coalesce(g.g1, 0) AS p1, o.p2 + coalesce(g.g2, 0) AS p2,
  o.b + coalesce(g.gb, 0) AS b FROM {name}{t}_ o LEFT JOIN (SELECT {key}, {lr} * sum(e * {other}1 - {reg} * {own}1) AS g1,
  {lr} * sum(e * {other}2 - {reg} * {own}2) AS g2, {lr} * sum(e - {reg} * {own}b) AS gb FROM e{t}_ GROUP BY 1) g ON g.{key} = o.{key})""")
    return ",\n" + ",\n".join(parts) + ",\nuf_ AS (SELECT * FROM u4_), if_ AS (SELECT * FROM i4_)"


def _als_ctes(reg: float = 0.1) -> str:
    parts = ["mfmu_ AS MATERIALIZED (SELECT avg(CAST(rating AS DOUBLE)) AS mu FROM train)", _start("ai0_", "item_id", 2)]
    fixed = "ai0_"
    for t in range(4):
        own, other = ("user_id", "item_id") if t % 2 == 0 else ("item_id", "user_id")
        name = f"a{'u' if t % 2 == 0 else 'i'}{t + 1}_"
        parts.append(f"""{name} AS MATERIALIZED (SELECT {own}, p1, p2, (st - s1 * p1 - s2 * p2) / n AS b FROM (
  SELECT *, (a22 * c1 - a12 * c2) / (a11 * a22 - a12 * a12) AS p1, (a11 * c2 - a12 * c1) / (a11 * a22 - a12 * a12) AS p2 FROM (
  SELECT {own}, sum(q1 * q1) + {reg} AS a11, sum(q1 * q2) AS a12, sum(q2 * q2) + {reg} AS a22, sum(q1 * t) AS c1, sum(q2 * t) AS c2,
         sum(t) AS st, sum(q1) AS s1, sum(q2) AS s2, count(*) AS n FROM (
  SELECT x.{own}, f.p1 AS q1, f.p2 AS q2, CAST(x.rating AS DOUBLE) - mu - f.b AS t
  FROM train x JOIN {fixed} f ON f.{other} = x.{other} CROSS JOIN mfmu_) GROUP BY 1)))""")
        fixed = name
    return ",\n" + ",\n".join(parts) + ",\nuf_ AS (SELECT * FROM au3_), if_ AS (SELECT * FROM ai4_)"


FACTORS_SQL = """
SELECT 'user' AS side, user_id AS id, round(p1, 6) AS v1, round(p2, 6) AS v2, round(b, 6) AS bias FROM uf_
UNION ALL SELECT 'item', item_id, round(p1, 6), round(p2, 6), round(b, 6) FROM if_"""

FPREDS = """,
fpreds_ AS (SELECT t.user_id, t.item_id, CAST(t.rating AS BIGINT) AS rating,
  CASE WHEN u.user_id IS NULL AND i.item_id IS NULL THEN mu ELSE LEAST(5.0, GREATEST(1.0, mu + coalesce(u.b, 0) + coalesce(i.b, 0)
       + coalesce(u.p1 * i.p1 + u.p2 * i.p2, 0))) END AS prediction
  FROM test t LEFT JOIN uf_ u ON u.user_id = t.user_id LEFT JOIN if_ i ON i.item_id = t.item_id CROSS JOIN mfmu_)"""
FPREDS_SQL = FPREDS + "\nSELECT user_id, item_id, rating, round(prediction, 6) AS prediction FROM fpreds_"

FRECS_SQL = """,
frecs_ AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM (
  SELECT u.user_id, i.item_id, mu + u.b + i.b + (u.p1 * i.p1 + u.p2 * i.p2) AS score FROM uf_ u CROSS JOIN if_ i CROSS JOIN mfmu_
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = i.item_id)))
""" + RECS_OUT + " FROM frecs_ WHERE rank <= 10"


def _factor_values(m):
    one = [F.round(F.get("vec", j), 6).alias(f"v{j + 1}") for j in (0, 1)]
    u = m.users.select(F.lit("user").alias("side"), F.col("user_id").alias("id"), *one, "bias")
    i = m.items.select(F.lit("item").alias("side"), F.col("item_id").alias("id"), *one, "bias")
    return _round_doubles(u.unionByName(i))


@query("m5_mf_factors_exact", B.with_(B.SPLIT) + _mf_ctes() + FACTORS_SQL)
def m5_mf_factors_exact(c):
    return _factor_values(c.model("svd", **MF_EXACT))


@query("m6_mf_predict_exact", B.with_(B.SPLIT) + _mf_ctes() + FPREDS_SQL)
def m6_mf_predict_exact(c):
    return _preds(mf, c.model("svd", **MF_EXACT), c)


@query("m6_mf_recommend_exact", B.with_(B.SPLIT) + _mf_ctes() + FRECS_SQL)
def m6_mf_recommend_exact(c):
    return _recs_out(mf.recommend(c.model("svd", **MF_EXACT), c.ratings.select("user_id").distinct(), K))


@query("m7_als_factors_exact", B.with_(B.SPLIT) + _als_ctes() + FACTORS_SQL)
def m7_als_factors_exact(c):
    return _factor_values(c.model("als", **ALS_EXACT))


@query("m8_als_predict_exact", B.with_(B.SPLIT) + _als_ctes() + FPREDS_SQL)
def m8_als_predict_exact(c):
    return _preds(als, c.model("als", **ALS_EXACT), c)


@query("m8_als_recommend_exact", B.with_(B.SPLIT) + _als_ctes() + FRECS_SQL)
def m8_als_recommend_exact(c):
    return _recs_out(als.recommend(c.model("als", **ALS_EXACT), c.ratings.select("user_id").distinct(), K))


@query("m11_hybrid_predict_exact", CBASE + _mf_ctes() + B.CONTENT_PREDS + FPREDS + """
SELECT f.user_id, f.item_id, f.rating, round(0.6 * f.prediction + 0.4 * p.prediction, 6) AS prediction
FROM fpreds_ f JOIN content_preds_ p ON p.user_id = f.user_id AND p.item_id = f.item_id""")
def m11_hybrid_predict_exact(c):
    return _preds(hybrid, c.model("hybrid", alpha=0.6, cf_params=MF_EXACT), c)
