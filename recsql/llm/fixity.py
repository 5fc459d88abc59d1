"""Merkle fixity audit of WARC replicas. DataFrame functions only.

``warc_records`` renders pages as WARC response records and lays them out in
files of ``FILE_RECORDS`` records, ordered by page id, with byte offsets: the
manifest. A record's hash is the SHA-256 of its bytes. ``RANGE_RECORDS``
records that follow each other in a file form an offset range, hashed over the
offsets, lengths and hashes of its records in order; ``FANOUT`` neighbouring
nodes form the node above, through files (two levels above the ranges) up to
one root over all files. Every group has a fixed size, so no key of the data
can make one large.

``audit`` builds both replicas' trees side by side, compares the roots and then
only the children of nodes that differ, level by level, down to the ranges and
their records. Each level is written once; the nodes it compares are those
under a mismatch, not the table.

Defined results: null url, html or id are empty strings; an empty or very long
page is one record; repeated rows are records of their own; empty tables give
no rows; a record that one side lacks is reported as missing or extra; other
columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.ranking import global_positions
from .scratch import Scratch, checked_broadcast

RANGE_RECORDS = 16
FANOUT = 8
FILE_RECORDS = RANGE_RECORDS * FANOUT * FANOUT


def record_text(page_id: Column, url: Column, html: Column) -> Column:
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def warc_records(pages: DataFrame) -> DataFrame:
    """(place, page_id, url, record) of (page_id, url, html): ``record`` is the
    text of the WARC record."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"),
                        record_text(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))


def manifest(records: DataFrame) -> DataFrame:
    """(place, file_id, offset, length, hash, page_id, url) of records laid out
    in order of page id, url and hash."""
    rows = records.select("page_id", "url", F.sha2("record", 256).alias("hash"), F.octet_length("record").cast("long").alias("length"))
    laid = global_positions(rows, [F.col("page_id").asc_nulls_first(), F.col("url").asc_nulls_first(), F.col("hash").asc()], "_pos")
    before = Window.partitionBy("file_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)  # FILE_RECORDS rows at most
    return (laid.withColumn("place", F.col("_pos") - 1)
            .withColumn("file_id", F.expr(f"place div {FILE_RECORDS}"))
            .withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
            .select("place", "file_id", "offset", "length", "hash", "page_id", "url"))


def _level(nodes: DataFrame) -> DataFrame:
    """The nodes above: hash of the children in order."""
    return nodes.groupBy("side", F.expr(f"node div {FANOUT}").alias("node")).agg(
        F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(  # FANOUT children at most
            F.col("node").alias("n"), "hash"))), lambda x: F.concat_ws(":", x["n"].cast("string"), x["hash"])), ";"), 256).alias("hash"))


def _ranges(records: DataFrame) -> DataFrame:
    return records.groupBy("side", F.expr(f"place div {RANGE_RECORDS}").alias("node")).agg(
        F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "offset", "length", "hash"))),  # RANGE_RECORDS
                                        lambda x: F.concat_ws(":", x["offset"].cast("string"), x["length"].cast("string"), x["hash"])),
                            ";"), 256).alias("hash"))


def _differing(nodes: DataFrame) -> DataFrame:
    one = F.max(F.when(F.col("side") == 0, F.col("hash")))
    two = F.max(F.when(F.col("side") == 1, F.col("hash")))
    return nodes.groupBy("node").agg(one.alias("a"), two.alias("b")).filter("NOT (a <=> b)").select("node")


def audit(expected: DataFrame, replica: DataFrame) -> DataFrame:
    """Records that differ between two copies, each (place, file_id, offset,
    length, hash): place, file_id, offset, expected and found length and hash,
    status (changed, missing, extra)."""
    scratch = Scratch(expected.sparkSession)
    cols = ("place", "file_id", "offset", "length", "hash")
    both = scratch.write(expected.select(F.lit(0).alias("side"), *cols).unionByName(
        replica.select(F.lit(1).alias("side"), *cols)))
    levels = [scratch.write(_ranges(both))]
    top = levels[0].agg(F.max("node").alias("n")).first()["n"]
    while top:  # until one root is left
        levels.append(scratch.write(_level(levels[-1])))
        top //= FANOUT
    bad = _differing(levels[-1])
    for nodes in levels[-2::-1]:
        under = nodes.withColumn("up", F.expr(f"node div {FANOUT}"))
        bad = scratch.write(_differing(under.join(checked_broadcast(bad.withColumnRenamed("node", "up")), "up", "left_semi")))
    suspects = both.withColumn("node", F.expr(f"place div {RANGE_RECORDS}")).join(checked_broadcast(bad), "node", "left_semi")

    def only(side: int, name: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(name)))

    found = suspects.groupBy("place", "file_id", "offset").agg(
        only(0, "length").alias("expected_length"), only(1, "length").alias("found_length"),
        only(0, "hash").alias("expected_hash"), only(1, "hash").alias("found_hash"))
    return scratch.finish(found.filter("NOT (expected_hash <=> found_hash AND expected_length <=> found_length)").withColumn(
        "status", F.when(F.col("found_hash").isNull(), "missing").when(F.col("expected_hash").isNull(), "extra").otherwise("changed")))
