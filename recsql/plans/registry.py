"""Registered queries: one Spark dataflow per operator of the inventory, each
paired (where SQL can express it) with an equivalent DuckDB query used as the
oracle. Doubles are rounded to 6 decimals in the output on both sides and
integer columns are BIGINT, so names, types and values compare directly."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import r6
from . import oracle_base as B
from .context import Context, context

REGISTRY: dict[str, tuple[Callable[[Context], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, _f=fn: _f(context(spark, sf_dir))) for name, (fn, _) in REGISTRY.items()}


def oracle_queries() -> dict[str, str]:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql}


def _round_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[r6(F.col(f.name)).alias(f.name) if f.dataType.typeName() in ("double", "float")
                       else F.col(f.name) for f in df.schema.fields])


# Importing the query modules fills REGISTRY.
from . import queries_app, queries_content, queries_data, queries_eval, queries_factors, queries_itemcf, queries_models  # noqa: E402,F401,I001
