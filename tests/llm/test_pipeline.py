import corpus_pipeline as P
from recsql.llm.jaccard import jaccard_classes

from .test_decontam import brute as leaks
from .test_jaccard import brute as classes
from .test_secrets import base_spans


def test_stage_list():
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "decontaminate", "secrets", "pack"]


def test_quality_keeps_clean_documents(spark, sf):
    larger = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    kept = {r.doc_id for r in P.quality(spark, docs, larger).select("doc_id").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    assert sum(i not in kept for i, q in labels.items() if q == 1) <= 5
    assert sum(i in kept for i, q in labels.items() if q == 0) <= 5


def test_near_duplicates_keep_one_of_each_class(spark, documents, sf):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    kept = sorted(r.doc_id for r in P.near_duplicates(spark, documents, sf).collect())
    assert kept == sorted({c for _, _, c in classes(rows, 5, 80, 100)})
    assert jaccard_classes(documents, n=5, num=80).filter("component_id = doc_id").count() == len(kept)


def test_decontaminate_drops_leaks_only(spark, documents, sf):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    bad = {d for _, d, _, _ in leaks(rows, items)}
    kept = {r.doc_id for r in P.decontaminate(spark, documents, sf).collect()}
    assert bad and kept == {d for d, _ in rows} - bad


def test_secrets_are_masked(spark, documents, sf):
    before = {r.doc_id: r.text for r in documents.collect()}
    after = P.secrets(spark, documents, sf)
    assert after.columns == documents.columns
    for r in after.collect():
        found = base_spans(before[r.doc_id])
        assert (r.text == before[r.doc_id]) == (not found) and not base_spans(r.text)
        assert r.n_chars == len(r.text)


def test_run_and_edges(spark, sf, edge_docs, empty_docs):
    assert P.run(spark, sf).count() > 50
    for name, stage in P.STAGES:
        for docs in (edge_docs, empty_docs):
            out = stage(spark, docs, sf)
            rows = out.collect()
            if name != "pack":
                assert out.columns == docs.columns and len(rows) <= docs.count()
    once = P.near_duplicates(spark, edge_docs, sf).collect()
    assert [r.doc_id for r in once].count(8) == 1 and [r.doc_id for r in once].count(9) == 2
    assert {1, 2, 3} <= {r.doc_id for r in once}


def test_rows_without_an_id(spark, sf):
    """They are rejected, deduplicated, decontaminated and masked like any other."""
    rows = spark.read.parquet(f"{sf}/documents.parquet").filter("text is not null and length(text) > 400").orderBy("doc_id")
    text = rows.first().text
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first().text
    secret = "password = 'abcdefgh1234' and more words"
    make = lambda data: spark.createDataFrame(data, rows.schema)

    copies = make([(None, text, "en", "a", 1), (None, text, "en", "a", 1), (None, text, "fr", "b", 1), (7, text, "en", "c", 1),
                   (None, "alone here", "en", "a", 1), (None, "alone here", "en", "b", 1)])
    kept = P.near_duplicates(spark, copies, sf)
    assert kept.columns == copies.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("7", text), ("None", "alone here")]

    leaks_ = make([(None, f"before {item} after", "en", "a", 1), (None, text, "en", "a", 1), (8, item, "en", "a", 1)])
    assert [(r.doc_id, r.text) for r in P.decontaminate(spark, leaks_, sf).collect()] == [(None, text)]

    hidden = P.secrets(spark, make([(None, secret, "en", "a", 1)]), sf).collect()
    assert P.MASK in hidden[0].text and hidden[0].doc_id is None

    larger = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    bad = {r.doc_id for r in spark.read.parquet(f"{larger}/labels.parquet").filter("quality = 0").collect()}
    worst = docs.filter(docs.doc_id.isin(sorted(bad)[:5]))
    nameless = worst.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text", "lang", "source", "n_chars")
    out = P.quality(spark, docs.unionByName(nameless), larger)
    assert out.filter("doc_id IS NULL").count() <= 1


def test_run_leaves_only_its_last_table(spark, sf):
    import os
    root = P.ensure_checkpoint_dir(spark).removeprefix("file:")
    before = {d for d in os.listdir(root) if d.startswith("pipeline-")}
    P.run(spark, sf).count()
    new = [d for d in os.listdir(root) if d.startswith("pipeline-") and d not in before]
    assert len(new) == 1 and os.listdir(f"{root}/{new[0]}") == ["4-pack"]
