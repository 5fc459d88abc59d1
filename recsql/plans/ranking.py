"""Deterministic ranking and top-k plans.

Every ranking uses a total order ``round(score, 9) DESC, id ASC`` so that
different partitionings and the SQL oracle agree.

* ``global_positions``: 1-based position in a total order without an
  unpartitioned window: a range-partitioned sort (hot keys are split across
  ranges), per-partition row numbers, and per-partition offsets (one row per
  partition, broadcast).
* ``rank_in_group``: position within a group = global position minus the
  group's first position; no window over a group, so a group holding a third
  of all rows is still spread over many tasks.
* ``topk``: ``row_number() <= k`` per group; Catalyst plans a partial
  WindowGroupLimit before the shuffle, so each map task forwards at most k rows
  per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_LOW_BITS = 1 << 33  # monotonically_increasing_id = partition_id << 33 | row number


class ScoreOrder(list):
    """``round(score, 9) DESC, key ASC``, with the names of its columns."""

    def __init__(self, score: str, key: str):
        super().__init__([F.round(F.col(score), 9).desc(), F.col(key).asc()])
        self.score, self.key = score, key


def score_order(score: str = "score", key: str = "item_id") -> list[Column]:
    return ScoreOrder(score, key)


def _rounded_once(df: DataFrame, order: list[Column]) -> tuple[DataFrame, list[Column]]:
    """A sort evaluates its expressions at every comparison; a rounded score is
    a column of its own instead (``_r9``)."""
    if not isinstance(order, ScoreOrder):
        return df, order
    return df.withColumn("_r9", F.round(F.col(order.score), 9)), [F.col("_r9").desc(), F.col(order.key).asc()]


def global_positions(df: DataFrame, order: list[Column], pos_col: str = "pos") -> DataFrame:
    df, order = _rounded_once(df, order)
    tagged = (df.orderBy(*order).drop("_r9")
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    # Freeze partition ids and row numbers so a recomputation after executor
    # loss cannot renumber rows.
    tagged = materialize(tagged)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.col("_pid").cast("bigint") * F.lit(_LOW_BITS)
    return (tagged.join(F.broadcast(offsets), "_pid")  # one row per partition
            .withColumn(pos_col, (F.col("_off") + local + 1).cast("bigint"))
            .drop("_pid", "_mid", "_off"))


def rank_in_group(df: DataFrame, group: list[str], order: list[Column],
                  rank_col: str = "rn", size_col: str = "n") -> DataFrame:
    """Adds the 1-based rank within ``group`` under ``order`` and the group size."""
    pos = global_positions(df, [F.col(g).asc() for g in group] + order, "_gpos")
    bounds = pos.groupBy(*group).agg(F.min("_gpos").alias("_start"), F.count(F.lit(1)).alias(size_col))
    return (pos.join(bounds, group)
            .withColumn(rank_col, (F.col("_gpos") - F.col("_start") + 1).cast("int"))
            .drop("_gpos", "_start"))


def topk(df: DataFrame, k: int, by: str | list[str] = "user_id", order: list[Column] | None = None,
         rank_col: str = "rank") -> DataFrame:
    """First k rows per group under a total order (partial limit pre-shuffle)."""
    df, order = _rounded_once(df, order or score_order())
    w = Window.partitionBy(*([by] if isinstance(by, str) else by)).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k).drop("_r9")


def exclude_seen(cands: DataFrame, seen: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Drop candidates the user already interacted with (anti join)."""
    return cands.join(seen.select(user, item), [user, item], "left_anti")


def broadcast_if_small(df: DataFrame, n_rows: int, row_bytes: int = 64,
                       limit_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast only behind a size check; otherwise leave the join to a shuffle
    (AQE may still convert it at runtime)."""
    return F.broadcast(df) if n_rows * row_bytes <= limit_bytes else df


def topk_unseen_from_ranking(ranked: DataFrame, users: DataFrame, seen: DataFrame, k: int,
                             n_ranked: int | None = None) -> DataFrame:
    """Top-k unseen items per user from one global item ranking.

    ``ranked`` = (item_id, score, pos). A user's first k unseen items lie within
    positions 1..k + |seen|, so each user is expanded over blocks of k positions
    up to that bound and joined to the ranking on the block id: candidates grow
    with |seen| + 2k per user, never with the catalogue."""
    b = max(1, int(k))
    nseen = seen.groupBy("user_id").agg(F.count(F.lit(1)).alias("_ns"))
    need = (F.lit(k) + F.coalesce(F.col("_ns"), F.lit(0))).cast("bigint")
    u = (users.select("user_id").distinct().join(nseen, "user_id", "left")
         .select("user_id", need.alias("_need"))
         .withColumn("_blk", F.explode(F.sequence(F.lit(1).cast("bigint"),
                                                   F.ceil(F.col("_need") / b).cast("bigint")))))
    items = ranked.select("item_id", "score", "pos", F.ceil(F.col("pos") / b).cast("bigint").alias("_blk"))
    if n_ranked is None:
        n_ranked = ranked.count()
    cands = (u.join(broadcast_if_small(items, n_ranked), "_blk")
             .filter(F.col("pos") <= F.col("_need")))
    unseen = exclude_seen(cands, seen)
    return (topk(unseen, k, order=[F.col("pos").asc()])
            .select("user_id", F.col("rank").cast("int"), "item_id", "score"))
