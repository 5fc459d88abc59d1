"""Content lists, questionnaire and genre counts: what is ranked, joined and counted only once."""

from pyspark.sql import functions as F

from recsql.models import coldstart, content, hybrid, popularity
from recsql.operators import catalog, metrics
from recsql.plans import blocked
from recsql.plans.context import Context

RATINGS = "user_id long, item_id long, rating int, timestamp long"
ITEMS = "item_id long, title string, genres string"


def _tables(spark):
    genres = ["a|b", "a|b", "c", "c|d", "c|d", "", "b"]
    items = spark.createDataFrame([(i, f"t{i}", genres[i % 7]) for i in range(1, 29)], ITEMS)
    ratings = spark.createDataFrame([(u, 1 + (3 * u + 5 * j) % 28, 1 + (u + j) % 5, j) for u in range(1, 13) for j in range(6)], RATINGS)
    return ratings, items


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_genre_counts_are_dealt_out_by_ratings(spark, monkeypatch):
    ratings, items = _tables(spark)
    history = ratings.unionByName(spark.createDataFrame([(None, 1, 3, 1), (1, None, 3, 1), (99, 1000, 3, 1)], RATINGS))
    catalogue = items.unionByName(items.filter("item_id = 2"))  # a repeated row counts twice
    monkeypatch.setattr(catalog, "RATINGS_COUNTED", 3)
    out = catalog.user_genre_counts(history, catalogue)
    assert out.rdd.getNumPartitions() == 25  # 75 ratings
    want = (history.join(catalogue, "item_id").select("user_id", F.explode(F.filter(F.split("genres", r"\|"), lambda g: g != "")).alias("genre"))
            .groupBy("user_id", "genre").count())
    assert {tuple(r) for r in out.collect()} == {tuple(r) for r in want.collect()}
    assert len(catalog.user_top_genres(history, catalogue, 1).collect()) == want.select("user_id").distinct().count()


def test_equal_preferences_are_ranked_once(spark, monkeypatch):
    ratings, items = _tables(spark)
    m = content.fit(ratings, items)
    bundles = [["a", "b"], ["c"], ["b", "a"], ["c"], ["zz"]]
    prefs = spark.createDataFrame([(p, g) for p in range(20) for g in bundles[p % 5]], "profile_id long, genre string")
    ranked, real = [], content.rank_catalogue

    def counted(model, uv, seen, k):
        ranked.append(uv.count())
        return real(model, uv, seen, k)

    monkeypatch.setattr(content, "rank_catalogue", counted)
    out = content.recommend_for_preferences(m, prefs, k=5)
    got = _rows(out, "profile_id", "rank", "item_id", "score")
    assert ranked == [2]
    monkeypatch.undo()
    each = content.recommend_for_preferences(m, prefs, k=5, exclude=spark.createDataFrame([], "profile_id long, item_id long"))
    want = _rows(each, "profile_id", "rank", "item_id", "score")
    assert [r[:3] for r in got] == [r[:3] for r in want] and len(got) == 16 * 5
    assert all(abs(a[3] - b[3]) < 1e-12 for a, b in zip(got, want, strict=True))


def test_cover_says_what_was_seen(spark):
    uv = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 1.0])], "user_id long, vec array<double>")
    groups = spark.createDataFrame([(10, [0.0, 1.0], 5), (20, [1.0, 1.0], 4)], "group_id long, vec array<double>, size long")
    seen = spark.createDataFrame([(1, 10, 2), (2, 20, 4)], "user_id long, group_id long, n_seen long")
    rows = {(r.user_id, r.group_id): (r.unseen, r.n_seen) for r in blocked.blocked_group_cover(uv, groups, seen, 6).collect()}
    assert rows == {(1, 10): (3, 2), (1, 20): (4, 0), (2, 10): (5, 0)}


def test_cold_start_lists_popularity_for_the_rest_only(spark):
    from .conftest import SF_SMALL
    ctx = Context(spark, SF_SMALL)
    got = _rows(ctx.recs("coldstart"), "user_id", "rank", "item_id", "score")
    assert ("recs", "popularity", 20, "[]") not in ctx.models
    users = ctx.ratings.select("user_id").distinct()
    want = coldstart.route(ctx.recs("content"), popularity.recommend(ctx.model("popularity"), users, 20), users)
    assert got == _rows(want, "user_id", "rank", "item_id", "score")
    assert {r[0] for r in got} == {r.user_id for r in users.collect()}


def test_profiles_are_means_of_liked_items(spark):
    ratings, items = _tables(spark)
    m = content.fit(ratings, items)
    vec = {}
    for r in m.item_vecs.collect():
        vec.setdefault(r.item_id, {})[r.term] = r.weight
    by_user = {}
    for r in ratings.collect():
        by_user.setdefault(r.user_id, []).append((r.item_id, r.rating))
    want = {}
    for u, rs in by_user.items():
        used = [x for x in rs if x[1] >= 4] or rs
        sums = {}
        for i, r in used:
            for t, w in vec.get(i, {}).items():
                sums[t] = sums.get(t, 0.0) + r * w / sum(x[1] for x in used)
        norm = sum(a * a for a in sums.values()) ** 0.5 + content.EPS
        want.update({(u, t): a / norm for t, a in sums.items()})
    got = {(r.user_id, r.term): r.weight for r in m.profiles.collect()}
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-9 for x in want)


def test_cut_offs_of_one_list(spark):
    recs = spark.createDataFrame([(u, r, 100 * u + r) for u in (1, 2, 3) for r in range(1, 7)], "user_id long, rank int, item_id long")
    rel = spark.createDataFrame([(1, 101), (1, 105), (2, 299), (4, 101)], "user_id long, item_id long")
    rows = {r.k: (r.recall, r.hitrate) for r in metrics.multik(recs, rel, (2, 5)).collect()}
    assert rows == {2: (0.25, 0.5), 5: (0.5, 0.5)}


def test_hybrid_bounds_are_computed_once(spark, monkeypatch):
    ratings, items = _tables(spark)
    m = hybrid.fit(ratings, items, cf_params=dict(n_factors=3, n_epochs=1))
    users = ratings.select("user_id").distinct()
    computed, real = spark.sparkContext.accumulator(0), hybrid.blocked_user_stats

    def counted(*args, **kwargs):
        st = real(*args, **kwargs)

        def fn(batches):
            for batch in batches:
                computed.add(batch.num_rows)
                yield batch
        return st.mapInArrow(fn, st.schema)

    monkeypatch.setattr(hybrid, "blocked_user_stats", counted)
    out = hybrid.recommend(m, users, 5).collect()
    assert len(out) == 12 * 5 and computed.value == 12


def test_content_model_is_fitted_once(spark):
    ratings, items = _tables(spark)
    ctx = Context(spark, "no folder")
    ctx.__dict__.update(ratings=ratings, items=items, train=ratings)
    m = ctx.model("content")
    assert ctx.model("content", like_threshold=4.0) is m and ctx.model("coldstart").content is m
    assert ctx.model("content", like_threshold=3.0) is not m
