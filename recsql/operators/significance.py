"""Significance tests on per-user metric values.

Inputs are (user_id, value) tables. All heavy parts are aggregations; only the
final one-row arithmetic calls the ``erf`` UDF. The bootstrap never
materialises users x replicates: users are counted per distinct value, and each
task folds its values into B partial sums with Poisson(users) weights that
depend on (seed, value, replicate) alone, so the result does not depend on
partitioning."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import t_cdf, t_crit_975
from ..schemas import USER


def paired(a: DataFrame, b: DataFrame) -> DataFrame:
    """Common users with both values."""
    return a.select(USER, F.col("value").alias("a")).join(b.select(USER, F.col("value").alias("b")), USER)


def ttest_stats(a: DataFrame, b: DataFrame) -> DataFrame:
    """E12 statistics: pairs, mean/sd/se of the differences, t, degrees of freedom."""
    d = paired(a, b).select((F.col("a") - F.col("b")).alias("d"))
    s = d.agg(F.count(F.lit(1)).alias("n"), F.avg("d").alias("m"), F.stddev_samp("d").alias("sd"))
    se = F.col("sd") / F.sqrt(F.col("n"))
    ok = F.col("n") >= 2
    return s.select(
        F.col("n").cast("bigint").alias("n_pairs"),
        F.when(ok, F.col("m")).otherwise(0.0).alias("mean_diff"),
        F.when(ok, F.col("sd")).otherwise(0.0).alias("std_diff"),
        F.when(ok, se).otherwise(0.0).alias("se"),
        F.when(ok & (se > 1e-9), F.col("m") / se).otherwise(0.0).alias("t_statistic"),
        (F.col("n") - 1).cast("bigint").alias("dof"))


def paired_ttest(a: DataFrame, b: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Adds the two-sided p-value (approximate t CDF), significance and 95% CI."""
    s = ttest_stats(a, b)
    p = F.when(F.col("n_pairs") >= 2,
               F.lit(2.0) * (F.lit(1.0) - t_cdf(F.abs("t_statistic"), F.col("dof").cast("double")))).otherwise(1.0)
    crit = t_crit_975(F.col("n_pairs"))
    return (s.withColumn("p_value", F.round(p, 6)).withColumn("significant", F.col("p_value") < alpha)
            .withColumn("alpha", F.lit(alpha))
            .withColumn("ci_lower", F.when(F.col("n_pairs") >= 2, F.col("mean_diff") - crit * F.col("se")).otherwise(0.0))
            .withColumn("ci_upper", F.when(F.col("n_pairs") >= 2, F.col("mean_diff") + crit * F.col("se")).otherwise(0.0))
            .withColumn("t_statistic", F.round("t_statistic", 4)))


def cohens_d(a: DataFrame, b: DataFrame) -> DataFrame:
    """|mean_a - mean_b| / pooled sd, with the magnitude label."""
    s = paired(a, b).agg(F.count(F.lit(1)).alias("n"), F.avg("a").alias("ma"), F.avg("b").alias("mb"),
                         F.var_samp("a").alias("va"), F.var_samp("b").alias("vb"))
    sp = F.sqrt(((F.col("n") - 1) * F.col("va") + (F.col("n") - 1) * F.col("vb")) / (F.lit(2) * F.col("n") - 2))
    ok = F.col("n") >= 2
    d = F.when(ok & (sp > 1e-9), F.abs(F.col("ma") - F.col("mb")) / sp).otherwise(0.0)
    mag = (F.when(~F.col("_ok"), "—").when(F.col("d") < 0.2, "negligible").when(F.col("d") < 0.5, "small")
           .when(F.col("d") < 0.8, "medium").otherwise("large"))
    return (s.select(F.col("n").cast("bigint").alias("n_pairs"), d.alias("d"),
                     F.when(ok, F.col("ma") - F.col("mb")).otherwise(0.0).alias("mean_diff"), ok.alias("_ok"))
            .select("n_pairs", F.round("d", 4).alias("cohens_d"), mag.alias("magnitude"), "mean_diff"))


def _value_weights(value_hash: int, users: int, seed: int, draws: int) -> np.ndarray:
    """How often each draw takes the users of one value: Poisson(1) weights add
    up, so that is one Poisson(users) number a draw, fixed by (seed, value)."""
    return np.random.default_rng([seed, value_hash & 0xFFFFFFFFFFFFFFFF]).poisson(users, draws).astype(np.float64)


def bootstrap_ci(vals: DataFrame, n_bootstrap: int = 10000, ci_level: float = 0.95, seed: int = 42) -> DataFrame:
    """Poisson bootstrap percentile CI of the mean (statistical, not
    numerical, parity with index resampling). Users are counted per value
    first, so the cost is distinct values x draws; null values are left out."""
    B = int(n_bootstrap)
    counts = vals.filter(F.col("value").isNotNull()).groupBy(F.col("value").cast("double").alias("value")).agg(
        F.count(F.lit(1)).alias("users"))
    # A value is a few bytes but B draws of work: a fixed number of partitions,
    # which adaptive coalescing (by bytes) leaves alone.
    counts = counts.repartition(int(vals.sparkSession.conf.get("spark.sql.shuffle.partitions")), "value")

    def partial(batches):
        sx, sw = np.zeros(B), np.zeros(B)
        for pdf in batches:
            for h, x, m in zip(pdf["h"].to_numpy(np.int64), pdf["value"].to_numpy(np.float64),
                               pdf["users"].to_numpy(np.int64), strict=True):
                w = _value_weights(int(h), int(m), seed, B)
                sx += x * w
                sw += w
        yield pd.DataFrame({"b": np.arange(B, dtype=np.int64), "sx": sx, "sw": sw})

    reps = (counts.select(F.xxhash64("value").alias("h"), "value", "users").mapInPandas(partial, "b long, sx double, sw double")
            .groupBy("b").agg(F.sum("sx").alias("sx"), F.sum("sw").alias("sw"))
            .filter(F.col("sw") > 0)  # a replicate that drew no one is skipped
            .select((F.col("sx") / F.col("sw")).alias("m")))
    alpha = 1 - ci_level
    q = reps.agg(F.percentile("m", [alpha / 2, 1 - alpha / 2]).alias("_q"))
    s = vals.agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    return s.crossJoin(q).select(  # single-row aggregates
        F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"),
        F.round(F.col("_q")[0], 6).alias("ci_lower"), F.round(F.col("_q")[1], 6).alias("ci_upper"),
        F.lit(ci_level).alias("ci_level"), F.lit(B).cast("bigint").alias("n_bootstrap"))


def compare_per_user(a: DataFrame, b: DataFrame, alpha: float = 0.05, n_bootstrap: int = 10000) -> DataFrame:
    """T-test, Cohen's d and both bootstrap CIs on the common users, one row."""
    pa = paired(a, b)
    va = pa.select(USER, F.col("a").alias("value"))
    vb = pa.select(USER, F.col("b").alias("value"))
    t = paired_ttest(a, b, alpha).select("n_pairs", "t_statistic", "p_value", "significant", "mean_diff",
                                         "ci_lower", "ci_upper")
    d = cohens_d(a, b).select("cohens_d", "magnitude")
    ba = bootstrap_ci(va, n_bootstrap).select(*[F.col(c).alias(f"a_{c}") for c in ("mean", "ci_lower", "ci_upper")])
    bb = bootstrap_ci(vb, n_bootstrap).select(*[F.col(c).alias(f"b_{c}") for c in ("mean", "ci_lower", "ci_upper")])
    return t.crossJoin(d).crossJoin(ba).crossJoin(bb)  # single-row results
