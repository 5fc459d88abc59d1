"""Benchmark decontamination: size-partitioned MinHash containment search,
verified by exact shingle containment. DataFrame functions only.

A test item of a few dozen words inside a document of many thousands has a
Jaccard similarity near zero, so the search is for containment. Items are
partitioned by size: class c holds items of 2^c to 2^(c+1)-1 distinct five-word
shingles. An item's sketch is its smallest MinHash values, as many as the
largest item of the class may lack in a leak and one more. A leak of an item of
q shingles lacks at most q - ceil(containment * q), so the document holds all
but that many of the sketch: candidates hold at least the rest, and none is
missed, whatever the sizes. At 80 % a sketch is about a fifth to two fifths of
an item. A class's values all lie below its cut, so documents send only values
below the largest cut.

Candidates are verified on the shingles' text: the share of the item's distinct
shingles that the document holds must reach ``containment``.

Words are runs of lower-cased ASCII letters, digits and non-ASCII characters,
so case, ASCII punctuation and line breaks do not hide a leak. The item side is
broadcast only after its rows and bytes are checked; a larger one takes a
shuffle join.

Defined results: null or empty texts and items of fewer than five words hold
no shingle and match nothing; repeated rows of an item or a document count
once; rows that share a doc_id are one document, and so are rows without one
(their doc_id is null in the result); items without an id match nothing; empty tables give no rows;
other columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch, checked_broadcast

WORDS = 5
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 32 << 20


def plain_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z0-9\x{80}-\x{10FFFF}]+"), "")


def _each(words: Column, shingle) -> Column:
    return F.when(F.size(words) >= WORDS, F.transform(
        F.sequence(F.lit(0), F.size(words) - WORDS),
        lambda i: shingle([F.get(words, i + k) for k in range(WORDS)])))


def _rows(df: DataFrame, *keys: str, values: Column, name: str) -> DataFrame:
    """One row per array entry. The outer form keeps the optimizer from testing
    the array's size below, which would compute its words once per entry."""
    return df.select(*keys, F.explode_outer(values).alias(name)).filter(F.col(name).isNotNull())


def _hashes(words: Column) -> Column:
    return _each(words, lambda w: F.xxhash64(*w))


def _texts(words: Column) -> Column:
    return _each(words, lambda w: F.concat_ws(" ", *w))


def _may_lack(shingles: Column, num: int, den: int) -> Column:
    """Of so many shingles, the most that a leak may lack."""
    return F.floor(shingles * F.lit(den - num) / F.lit(den)).cast("long")


def sketches(items: DataFrame, num: int, den: int) -> DataFrame:
    """(item_id, h, needed): the kept values of each item, and how many of them
    a leak holds at least."""
    full = _rows(items, "item_id", values=_hashes(F.col("w")), name="h").distinct()
    size = full.groupBy("item_id").agg(F.count("*").alias("q"))
    top = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin("q"))) - 1  # largest item of the class
    size = size.select("item_id", (_may_lack(top, num, den) + 1).alias("keep"), _may_lack(F.col("q"), num, den).alias("lack"))
    ranked = full.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy("h")))
    return (ranked.join(size, "item_id").filter("rank <= keep")
            .withColumn("needed", F.count("*").over(Window.partitionBy("item_id")) - F.col("lack"))
            .select("item_id", "h", "needed"))


def candidates(docs: DataFrame, index: DataFrame) -> DataFrame:
    """(doc_id, item_id) whose sketch a document (doc_id, w) holds as far as a
    leak does. Documents' values above the largest kept one are not sent."""
    cut = index.agg(F.max("h").alias("cut"))  # one row
    held = (docs.select("doc_id", _hashes(F.col("w")).alias("g")).crossJoin(F.broadcast(cut))
            .select("doc_id", F.filter("g", lambda h: h <= F.col("cut")).alias("g")))
    hits = _rows(held, "doc_id", values=F.col("g"), name="h").join(_bounded(index), "h")
    return (hits.distinct().groupBy("doc_id", "item_id").agg(F.count("*").alias("n"), F.first("needed").alias("needed"))
            .filter("n >= needed").select("doc_id", "item_id"))


def _bounded(df: DataFrame) -> DataFrame:
    return checked_broadcast(df, BROADCAST_ROWS, BROADCAST_BYTES)


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    containment: tuple[int, int] = (80, 100)) -> DataFrame:
    """(item_id, doc_id, item_shingles, shared_shingles, containment) of every
    document that holds at least the given share (numerator, denominator) of
    an item's shingles. ``items`` has item_id and text."""
    num, den = containment
    scratch = Scratch(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), plain_words(F.col(text_col)).alias("w"))
    tests = scratch.write(items.select(F.col("item_id").cast("long").alias("item_id"), plain_words(F.col("text")).alias("w")))
    index = scratch.write(sketches(tests, num, den))
    near = scratch.write(candidates(src, index))

    asked = _rows(tests, "item_id", values=_texts(F.col("w")), name="s").distinct()
    wanted = _bounded(near.select(F.col("doc_id").alias("_id")).distinct())
    read = src.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    found = (_rows(read, "doc_id", values=_texts(F.col("w")), name="s")
             .join(_bounded(asked), "s").select("doc_id", "item_id", "s").distinct()
             .groupBy("doc_id", "item_id").agg(F.count("*").alias("shared_shingles")))
    pairs = near.select(F.col("doc_id").alias("_id"), F.col("item_id").alias("_item"))
    return scratch.finish(
        found.join(pairs, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("item_id") == F.col("_item")), "left_semi")
        .join(asked.groupBy("item_id").agg(F.count("*").alias("item_shingles")), "item_id")
        .filter(F.col("shared_shingles") * den >= F.col("item_shingles") * num)
        .select("item_id", "doc_id", "item_shingles", "shared_shingles",
                (F.col("shared_shingles") / F.col("item_shingles")).alias("containment")))
