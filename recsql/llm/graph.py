"""Connected components of a link table, as DataFrame joins.

Alternating large-star and small-star steps (Kiveris et al. 2014): each step
links the neighbours of a node to the smallest of them. Every step is a
grouped minimum (combined before the shuffle) and an equi-join that adaptive
execution can split, so a hub with very many links is never one task's group.
The state is written to the shared folder after each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def components(links: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links`` (long ids); ``root`` is the
    smallest node reachable. Self-links and repeated links do no harm."""
    edges = scratch.write(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    mark = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edges = scratch.write(small)
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
    return tuple(row)
