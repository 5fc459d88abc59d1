"""Train/test splits (W2-W4) as one ratings table with a ``fold`` column.

A user's test ratings are the last ones by (timestamp, item), so all that is
needed is each user's boundary; nothing is sorted globally. Users of at most
``HEAVY_USER`` ratings are ranked in a window of their own. For the others the
boundary is found by counting: their ratings are counted per (user, time
bucket), combined before the shuffle, the bucket that holds the boundary is cut
into buckets again, and so on (then by item, inside one timestamp), until at
most ``HEAVY_USER`` ratings lie in it; only these are ranked. Sampling uses a
portable hash rank instead of an RNG, so the same users/items are chosen
under any partitioning (and by the SQL oracle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.ranking import broadcast_if_small, global_positions
from ..schemas import ITEM, TS, USER
from ..session import materialize

HEAVY_USER = 100_000  # ratings of one user that a window may rank
BUCKETS = 1024        # buckets a round of counting cuts a user's interval into
_NULL = -(1 << 61)    # nulls come first, as in an ascending order


def _key(name: str) -> Column:
    return F.coalesce(F.col(name).cast("bigint"), F.lit(_NULL))


def _n_test(n: str, ratio: float) -> Column:
    return F.greatest(F.lit(1), F.floor(F.col(n) * F.lit(ratio)).cast("bigint"))


def _last(rows: DataFrame, limit: Column) -> DataFrame:
    """``fold``: "test" for a user's last rows, as many as ``limit`` says."""
    order = Window.partitionBy(USER).orderBy(F.col(TS).desc(), F.col(ITEM).desc())
    return (rows.withColumn("_rn", F.row_number().over(order))
            .withColumn("fold", F.when(F.col("_rn") <= limit, "test").otherwise("train")).drop("_rn"))


# A heavy user's state: the intervals [_lo, _hi) of timestamps and of items that
# hold the boundary, the ratings inside, and how many of them are test.
def _inside() -> Column:
    return (_key(TS).between(F.col("_tlo"), F.col("_thi") - 1)
            & _key(ITEM).between(F.col("_ilo"), F.col("_ihi") - 1))


def _above() -> Column:
    return (_key(TS) >= F.col("_thi")) | ((_key(TS) >= F.col("_tlo")) & (_key(ITEM) >= F.col("_ihi")))


def _with_state(ratings: DataFrame, states: DataFrame) -> DataFrame:
    return ratings.join(broadcast_if_small(states, states.count()), USER)


def _narrow(ratings: DataFrame, states: DataFrame, name: str, lo: str, hi: str) -> DataFrame:
    """Cut every wide interval of ``name`` down to the bucket with the boundary,
    until at most ``HEAVY_USER`` ratings or one value are left in it."""
    wide = (F.col("_inside") > HEAVY_USER) & (F.col(hi) - F.col(lo) > 1)
    step = F.expr(f"({hi} - {lo} + {BUCKETS - 1}) div {BUCKETS}")
    while not (todo := states.filter(wide)).isEmpty():
        bucket = F.expr(f"(_v - {lo}) div _step").alias("_b")
        counts = (_with_state(ratings.select(USER, TS, ITEM), todo).filter(_inside())
                  .withColumn("_v", _key(name)).withColumn("_step", step)
                  .groupBy(*todo.columns, "_step", bucket).agg(F.count(F.lit(1)).alias("_c")))
        down = Window.partitionBy(USER).orderBy(F.col("_b").desc())  # at most BUCKETS rows a user
        found = (counts.withColumn("_upto", F.sum("_c").over(down))
                 .filter((F.col("_upto") >= F.col("_rest")) & (F.col("_upto") - F.col("_c") < F.col("_rest"))))
        start = F.col(lo) + F.col("_b") * F.col("_step")
        new = {lo: start, hi: F.least(F.col(hi), start + F.col("_step")), "_inside": F.col("_c"),
               "_rest": F.col("_rest") - (F.col("_upto") - F.col("_c"))}
        found = found.select(*[new.get(c, F.col(c)).alias(c) for c in states.columns])
        states = materialize(states.filter(~wide).unionByName(found))
    return states


def _time_fold(ratings: DataFrame, ratio: float) -> DataFrame:
    stats = ratings.groupBy(USER).agg(
        F.count(F.lit(1)).alias("_inside"), F.min(_key(TS)).alias("_tlo"), (F.max(_key(TS)) + 1).alias("_thi"),
        F.min(_key(ITEM)).alias("_ilo"), (F.max(_key(ITEM)) + 1).alias("_ihi"))
    heavy = materialize(stats.filter(F.col("_inside") > HEAVY_USER).withColumn("_rest", _n_test("_inside", ratio)))
    n_heavy = heavy.count()
    light = ratings
    if n_heavy:
        light = ratings.join(broadcast_if_small(heavy.select(USER), n_heavy), USER, "left_anti")
    size = F.count(F.lit(1)).over(Window.partitionBy(USER))
    folds = _last(light.withColumn("_n", size), _n_test("_n", ratio)).select(*ratings.columns, "fold")
    if not n_heavy:
        return folds
    states = _narrow(ratings, _narrow(ratings, heavy, TS, "_tlo", "_thi"), ITEM, "_ilo", "_ihi")
    rows = _with_state(ratings, states)
    edge = _last(rows.filter(_inside()), F.col("_rest"))
    rest = rows.filter(~_inside()).withColumn("fold", F.when(_above(), "test").otherwise("train"))
    return (folds.unionByName(edge.select(*ratings.columns, "fold"))
            .unionByName(rest.select(*ratings.columns, "fold")))


def split_by_time(ratings: DataFrame, ratio: float = 0.2) -> DataFrame:
    """Each user's last ``max(1, floor(n*ratio))`` ratings by (timestamp, item) -> test."""
    return _time_fold(ratings, ratio)


def _hash_sample(keys: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Exact-size sample: the first ``max(1, floor(n*fraction))`` keys by md5(seed|key)."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))
    pos = global_positions(keys.select(key).distinct().withColumn("_h", h), [F.col("_h").asc(), F.col(key).asc()])
    n = pos.agg(F.count(F.lit(1)).alias("_cnt"))
    keep = F.greatest(F.lit(1), F.floor(F.col("_cnt") * F.lit(fraction)).cast("bigint"))
    return pos.crossJoin(F.broadcast(n)).filter(F.col("pos") <= keep).select(key)  # 1-row side


def split_cold_users(ratings: DataFrame, ratio: float = 0.2, cold_ratio: float = 0.1, seed: int = 42) -> DataFrame:
    """All ratings of a hash-sampled set of users -> ``cold``; the rest by time."""
    cold = _hash_sample(ratings, USER, cold_ratio, seed)
    warm = ratings.join(cold, USER, "left_anti")
    cold_rows = ratings.join(cold, USER, "left_semi").withColumn("fold", F.lit("cold"))
    return _time_fold(warm, ratio).unionByName(cold_rows)


def split_cold_items(ratings: DataFrame, ratio: float = 0.2, cold_ratio: float = 0.05,
                     max_count: int = 5, seed: int = 42) -> DataFrame:
    """Items with <= max_count ratings (all items if none) are sampled; their
    ratings -> ``cold_item``, the rest by time."""
    counts = ratings.groupBy(ITEM).agg(F.count(F.lit(1)).alias("_n"))
    n_cand = counts.agg(F.count_if(F.col("_n") <= max_count).alias("_nc"))
    pool = (counts.crossJoin(F.broadcast(n_cand))  # 1-row side
            .filter((F.col("_n") <= max_count) | (F.col("_nc") == 0)).select(ITEM))
    cold = _hash_sample(pool, ITEM, cold_ratio, seed)
    warm = ratings.join(cold, ITEM, "left_anti")
    cold_rows = ratings.join(cold, ITEM, "left_semi").withColumn("fold", F.lit("cold_item"))
    return _time_fold(warm, ratio).unionByName(cold_rows)


def fold(split: DataFrame, name: str) -> DataFrame:
    return split.filter(F.col("fold") == name).drop("fold")
