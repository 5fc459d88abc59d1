"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(x: Column, lo: float = 1.0, hi: float = 5.0) -> Column:
    """Clip a prediction to the rating range."""
    return F.least(F.lit(hi), F.greatest(F.lit(lo), x))


def score_percent(score: Column, scale: float = 5.0) -> Column:
    """F16: score as a percentage of the rating scale."""
    return score / F.lit(scale) * F.lit(100.0)


def r6(x: Column) -> Column:
    """Output rounding shared with the SQL oracle (6 decimals, double)."""
    return F.round(x.cast("double"), 6)
