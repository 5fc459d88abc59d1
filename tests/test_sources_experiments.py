"""File sources (S1-S7, S10) and experiment helpers."""

import gzip
import os
import tempfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from recsql.operators import catalog, enrich, experiments
from recsql.sources import files


@pytest.fixture(scope="module")
def data_dir():
    d = tempfile.mkdtemp(prefix="recsql-dat-")
    with open(os.path.join(d, "ratings.dat"), "w", encoding="latin-1") as f:
        f.write("1::1193::5::978300760\n1::661::3::978302109\n2::1193::4::978298413\n")
    with open(os.path.join(d, "movies.dat"), "w", encoding="latin-1") as f:
        f.write("1193::One Flew Over the Cuckoo's Nest (1975)::Drama\n661::James and the Giant Peach (1996)::"
                "Animation|Children's|Musical\n10::Amélie (2001)::Comedy|Romance\n")
    with open(os.path.join(d, "users.dat"), "w", encoding="latin-1") as f:
        f.write("1::F::1::10::48067\n2::M::56::16::70072\n")
    with gzip.open(os.path.join(d, "basics.tsv.gz"), "wt", encoding="utf-8") as f:
        f.write("tconst\ttitleType\tprimaryTitle\toriginalTitle\tstartYear\truntimeMinutes\tgenres\n")
        f.write("tt0073486\tmovie\tOne Flew Over the Cuckoo's Nest\tOne Flew Over the Cuckoo's Nest\t1975\t133\tDrama\n")
        f.write("tt0116683\tmovie\tJames and the Giant Peach\tJames and the Giant Peach\t1996\t79\tAdventure,Animation\n")
        f.write("tt0000001\tshort\tAmélie\tAmélie\t2001\t\\N\tComedy\n")
        f.write("tt0211915\tmovie\tAmélie\tLe fabuleux destin\t\\N\t122\t\\N\n")
    return d


def test_dat_sources(spark, data_dir):
    ds = files.dataset_from_files(spark, data_dir)
    assert ds.ratings.count() == 3 and ds.users.count() == 2
    m = {r.item_id: r for r in ds.items.collect()}
    assert m[10].title == "Amélie (2001)" and m[10].release_year == 2001
    assert m[10].imdb_genres == "" and m[10].runtime is None  # no cache at all


def test_missing_source_raises(spark):
    with pytest.raises(AnalysisException):
        files.read_ratings(spark, "/nonexistent/ratings.dat").count()


def test_imdb_build_and_cache(spark, data_dir):
    basics = files.read_imdb_basics(spark, os.path.join(data_dir, "basics.tsv.gz"), partitions=2)
    assert basics.filter(F.col("runtimeMinutes").isNull()).count() == 1
    movies = files.read_movies(spark, os.path.join(data_dir, "movies.dat"))
    cache = {r.item_id: r for r in enrich.build_enrichment(movies, basics).collect()}
    assert cache[1193].match_tier == "title_year" and cache[1193].runtime == "133"
    assert cache[661].imdb_genres == "Adventure,Animation"
    assert cache[10].match_tier == "title" and cache[10].tconst == "tt0211915"  # short filtered, no year -> title only
    out = os.path.join(tempfile.mkdtemp(prefix="recsql-cache-"), "cache")
    files.write_enrichment(enrich.build_enrichment(movies, basics), out)
    back = files.read_enrichment(spark, out)
    assert back.count() == 3
    assert files.read_enrichment(spark, "/nonexistent/cache").count() == 0
    enriched = {r.item_id: r for r in enrich.enrich_items(movies, back).collect()}
    assert enriched[661].genres == "Adventure|Animation|Children's|Musical"


def test_compare_and_grid_helpers(spark):
    a = spark.createDataFrame([("rmse", 1.0), ("recall@10", 0.1), ("eval_users", 10.0), ("coverage", 0.0)],
                              "metric string, value double")
    b = spark.createDataFrame([("rmse", 0.9), ("recall@10", 0.1), ("eval_users", 12.0), ("novelty", 3.0)],
                              "metric string, value double")
    got = {r.metric: r for r in experiments.compare_runs(a, b).collect()}
    assert got["rmse"].judgment == "↑ better" and got["rmse"].delta == pytest.approx(-0.1)
    assert got["rmse"].delta_pct == pytest.approx(-10.0)
    assert got["recall@10"].judgment == "→ tie"
    assert got["eval_users"].judgment == "(diagnostic)"
    assert got["coverage"].judgment == "—" and got["novelty"].judgment == "—"
    many = experiments.compare_many([("a", a), ("b", b), ("c", a)])
    assert many.select("run").distinct().count() == 2
    assert experiments.drop_diagnostics(a).count() == 3
    assert experiments.param_grid({"x": [1, 2], "y": ["a"]}) == [{"x": 1, "y": "a"}, {"x": 2, "y": "a"}]
    assert experiments.param_grid_df(spark, {"x": [1, 2], "y": [0.1, 0.2]}).count() == 4
    assert experiments.refine_grid({"n": [10, 50, 100], "lr": [0.001, 0.01], "m": ["a", "b"]},
                                   {"n": 50, "lr": 0.01, "m": "b"}) == {
        "n": [10, 30, 50, 75, 100], "lr": [0.001, 0.0055, 0.01], "m": ["b"]}


def test_presets(spark):
    p = catalog.preset_preferences(spark)
    assert p.select("profile_id").distinct().count() == 5 and p.count() == 15
