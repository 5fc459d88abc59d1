import hashlib

from pyspark.sql import functions as F

from recsql.llm import fixity as X


def laid(spark, n):
    pages = spark.createDataFrame([(i, f"http://h/{i % 7}", f"<p>{i * 31}</p>" * (i % 5)) for i in range(n)],
                                  "page_id long, url string, html string")
    return X.manifest(X.warc_records(pages))


def test_records_and_offsets(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = X.manifest(X.warc_records(pages)).orderBy("place").collect()
    at, file_id = 0, 0
    texts = {r.page_id: r for r in pages.collect()}
    for k, r in enumerate(rows):
        if r.file_id != file_id:
            at, file_id = 0, r.file_id
        body = texts[r.page_id].html.encode()
        raw = (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{r.page_id}>\r\nWARC-Target-URI: "
               f"{texts[r.page_id].url}\r\nContent-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"
        assert (r.place, r.offset, r.length, r.hash) == (k, at, len(raw), hashlib.sha256(raw).hexdigest())
        at += r.length
    assert len(rows) == len(texts)


def test_finds_damage_and_nothing_else(spark):
    whole = laid(spark, 2600).cache()  # three files
    assert X.audit(whole, whole).collect() == []
    lost, changed, moved = [0, 17, 1024, 2599], [5, 6, 1700], [2000]
    bad = (whole.filter(~F.col("place").isin(lost))
           .withColumn("hash", F.when(F.col("place").isin(changed), F.lit("0")).otherwise(F.col("hash")))
           .withColumn("length", F.when(F.col("place").isin(moved), F.col("length") + 1).otherwise(F.col("length"))))
    found = {r.place: r.status for r in X.audit(whole, bad).collect()}
    assert found == {**dict.fromkeys(lost, "missing"), **dict.fromkeys(changed + moved, "changed")}
    assert {r.place: r.status for r in X.audit(bad, whole).collect()} == {
        **dict.fromkeys(lost, "extra"), **dict.fromkeys(changed + moved, "changed")}


def test_descends_only_mismatching_branches(spark):
    whole = laid(spark, 2600).withColumn("side", F.lit(0))
    bad = whole.withColumn("side", F.lit(1)).withColumn("hash", F.when(F.col("place") == 1500, F.lit("0")).otherwise(F.col("hash")))
    nodes = X._ranges(whole.unionByName(bad))
    while True:
        differing = [r.node for r in X._differing(nodes).collect()]
        assert len(differing) == 1  # one branch on every level
        if nodes.agg(F.max("node")).first()[0] == 0:
            break
        nodes = X._level(nodes)


def test_edges(spark):
    pages = spark.createDataFrame([(1, None, None), (1, None, None), (None, "u", ""), (2, "v", "y" * 300_000), (3, "", "é")],
                                  "page_id long, url string, html string").selectExpr("*", "1 AS place", "'z' AS hash", "2 AS node")
    rows = X.manifest(X.warc_records(pages)).collect()
    assert sorted(r.place for r in rows) == [0, 1, 2, 3, 4]
    kept = X.manifest(X.warc_records(pages))
    none = kept.filter("false")
    assert X.audit(none, none).collect() == []
    assert {r.status for r in X.audit(kept, none).collect()} == {"missing"}
    assert X.audit(none, kept).count() == 5


def test_every_record_of_the_replica_is_read(spark):
    from pyspark.sql import functions as F

    from recsql.llm import fixity, queries
    pages = spark.createDataFrame([(k, f"http://h/{k}", f"<p>{k}") for k in range(40)] + [(3, "http://h/3", "<p>3")],
                                  "page_id long, url string, html string")
    records = fixity.warc_records(pages)
    kept = fixity.manifest(records)
    read = F.concat(F.col("record"), F.lit("!"))
    rows = fixity.audit(kept, queries.replica(kept, records, read, F.col("page_id") == 7)).collect()
    assert len(rows) == 41 and sum(r.status == "missing" for r in rows) == 1
    assert all(r.found_length == r.expected_length + 1 for r in rows if r.status == "changed")
