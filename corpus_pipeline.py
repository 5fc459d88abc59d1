"""From raw documents to packed training sequences.

``STAGES`` are applied in order; each gets what the stage before kept, written
as parquet and read again. All but the last return the columns of documents.

1. ``quality``: documents that the classifier scores below 0.7 go; it learns
   from the labels of its input.
2. ``near_duplicates``: of documents linked by a Jaccard similarity of at least
   0.8 on five-word shingles, the one with the smallest id stays, and one row
   of repeated rows.
3. ``decontaminate``: documents that hold at least 0.8 of a benchmark item's
   shingles go.
4. ``secrets``: the text under every span, base kinds and owner-specific
   tokens, becomes ``MASK``; no document goes. ``n_chars`` follows the text.
5. ``pack``: sequences of at most 4096 tokens.

Defined results: documents with null or empty texts are scored, never linked,
never contaminated, and packed as their closing id; rows that share a doc_id
are kept or dropped together; rows without an id are told apart by the hash of
all their columns, so each is judged like any other (equal ones together), and
of linked documents one with an id stays; empty tables pass through."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsql.llm.decontam import contained_items
from recsql.llm.jaccard import jaccard_classes
from recsql.llm.packing import pack_documents
from recsql.llm.quality import score_quality
from recsql.llm.scratch import checked_broadcast
from recsql.llm.secrets import masked_texts
from recsql.session import delete_path, ensure_checkpoint_dir

MASK = "[SECRET]"
KEEP_QUALITY = 0.7


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


NO_ID = "_pipeline_no_id"


def _identified(docs: DataFrame) -> DataFrame:
    """Rows without an id get one above 2^62 from the hash of all columns, and
    ``NO_ID`` true; ``_restored`` takes both away again. Rows that get the same
    one are equal but for a 64-bit hash collision."""
    own = F.shiftrightunsigned(F.xxhash64(*docs.columns), 2) + F.lit(1 << 62)
    return docs.withColumn(NO_ID, F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", own))


def _restored(docs: DataFrame) -> DataFrame:
    return docs.withColumn("doc_id", F.when(~F.col(NO_ID), F.col("doc_id"))).drop(NO_ID)


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose doc_id is not among ``ids``."""
    return docs.join(checked_broadcast(ids.select("doc_id").distinct(), 1_000_000), "doc_id", "left_anti").select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _identified(docs)
    scores = score_quality(docs, _table(spark, sf_dir, "labels"))
    # A document with several rows stays if its best row does.
    rejected = scores.groupBy("doc_id").agg(F.max("score").alias("score")).filter(F.col("score") < KEEP_QUALITY)
    return _restored(_without(docs, rejected))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _identified(docs)
    classes = jaccard_classes(docs, n=5, num=80, den=100)
    kept = _without(docs, classes.filter("component_id <> doc_id"))
    again = classes.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    if again.isEmpty():
        return _restored(kept)
    once = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*docs.columns)
    return _restored(_without(kept, again).unionByName(once))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _identified(docs)
    return _restored(_without(docs, contained_items(docs, _table(spark, sf_dir, "benchmark"))))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return masked_texts(docs, MASK)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("secrets", secrets), ("pack", pack)]
ORACLE_SQL = None  # a trained classifier and a tokenizer: tested stage by stage instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents table. A stage's table
    goes when the next one is written."""
    docs = _table(spark, sf_dir, "documents")
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    before = None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return docs
