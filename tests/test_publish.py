"""Replacing the enrichment table under its readers, and damaged tables."""

import os
import warnings

import numpy as np
import pytest

from recsql import schemas as S
from recsql.operators import significance
from recsql.sources import files, publish


def _cache(spark, *ids):
    return spark.createDataFrame([(i, f"tt{i}", "Drama", "90", None) for i in ids], S.ENRICHMENT)


def _ids(df):
    return sorted(r.item_id for r in df.collect())


def test_a_reader_keeps_its_version_while_a_newer_one_is_written(spark, tmp_path):
    path = str(tmp_path / "cache")
    files.write_enrichment(_cache(spark, 1, 2), path)
    held = files.read_enrichment(spark, path)
    files.write_enrichment(held.filter("item_id = 2").unionByName(_cache(spark, 3)), path)  # from the table itself
    assert _ids(held) == [1, 2] and _ids(files.read_enrichment(spark, path)) == [2, 3]
    assert publish.drop_older(spark, path) == 1 and publish.drop_older(spark, path) == 0
    assert _ids(files.read_enrichment(spark, path)) == [2, 3]


def test_a_write_that_dies_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "cache")
    files.write_enrichment(_cache(spark, 1), path)
    broken = _cache(spark, 5).selectExpr("item_id", "raise_error('stop') AS tconst", "imdb_genres", "runtime", "orig_title")
    with pytest.raises(Exception, match="stop"):
        files.write_enrichment(broken, path)
    assert _ids(files.read_enrichment(spark, path)) == [1]


def test_plain_tables_are_read_and_absent_ones_are_empty_without_a_warning(spark, tmp_path):
    plain = str(tmp_path / "plain")
    _cache(spark, 7).write.parquet(plain)
    os.mkdir(tmp_path / "nothing")
    with warnings.catch_warnings():
        warnings.simplefilter("error", files.DamagedTable)
        assert _ids(files.read_enrichment(spark, plain)) == [7]
        assert _ids(files.read_enrichment(spark, str(tmp_path / "absent"))) == []
        assert _ids(files.read_enrichment(spark, str(tmp_path / "nothing"))) == []
        assert _ids(files.read_enrichment(spark, None)) == []


def test_one_damaged_file_or_another_layout_is_reported(spark, tmp_path):
    path = str(tmp_path / "cache")
    files.write_enrichment(_cache(spark, *range(20)).repartition(4), path)
    folder = publish.current(spark, path)
    name = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))[-1]
    with open(os.path.join(folder, name), "wb") as f:
        f.write(b"not a table at all")
    crc = os.path.join(folder, f".{name}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    with pytest.warns(files.DamagedTable):
        assert files.read_enrichment(spark, path).count() == 0
    other = str(tmp_path / "other")
    spark.range(3).write.parquet(other)
    with pytest.warns(files.DamagedTable, match="item_id"):
        assert files.read_enrichment(spark, other).count() == 0


def test_value_weights_have_the_mean_and_variance_of_summed_poisson_draws():
    for users in (1, 4, 5000):
        w = significance._value_weights(-7, users, 42, 40_000)
        assert w.mean() == pytest.approx(users, rel=0.02) and w.var() == pytest.approx(users, rel=0.04)
    assert np.array_equal(significance._value_weights(3, 9, 1, 50), significance._value_weights(3, 9, 1, 50))


def test_bootstrap_of_few_values_in_many_rows_and_nulls(spark):
    df = spark.range(20_000).selectExpr("id AS user_id", "IF(id % 3 = 0, 0D, IF(id % 1000 = 1, NULL, id % 5 / 5)) AS value")
    a, b = (significance.bootstrap_ci(df.repartition(n), n_bootstrap=2000).first() for n in (1, 6))
    assert tuple(a) == tuple(b)
    n = df.filter("value IS NOT NULL").count()
    half = 1.96 * a["std"] / n ** 0.5
    assert a["mean"] - a.ci_lower == pytest.approx(half, rel=0.12) and a.ci_upper - a["mean"] == pytest.approx(half, rel=0.12)
    none = significance.bootstrap_ci(df.limit(0), n_bootstrap=10).first()
    assert none["mean"] is None and none.ci_lower is None
