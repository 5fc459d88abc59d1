"""TF-IDF content model over item genre text.

Long sparse tables (item, term, weight) and (user, term, weight) are built with
joins and aggregations; predictions join pairs to both on the term; ranking
the whole catalogue for every user goes through the blocked scorer with sparse
vectors, so the vocabulary may have any size."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clip
from ..functions.text import tokens
from pyspark.sql import Window

from ..plans.blocked import blocked_group_cover, blocked_topk, entries_to_vec, no_null_id, sparse_dot, sparse_rows, sparse_vectors
from ..plans.ranking import broadcast_if_small, exclude_seen, global_positions, rank_in_group, topk
from ..schemas import ITEM, RATING, USER
from ..session import materialize, stored
from .popularity import global_mean, seen_pairs

EPS = 1e-9  # fixed value: norm guard of the reference formulas


@dataclass
class ContentModel:
    mu: DataFrame            # one row: mu
    idf: DataFrame           # term, idx, idf
    item_vecs: DataFrame     # item_id, term, weight
    catalogue: DataFrame     # item_id (every catalogue item, even without terms)
    profiles: DataFrame      # user_id, term, weight
    profile_users: DataFrame  # user_id
    seen: DataFrame          # user_id, item_id
    dim: int
    n_items: int


def item_text(items: DataFrame) -> DataFrame:
    """(item_id, genres text), one row per item; of repeated items the
    greatest text stays, in any partitioning."""
    return items.groupBy(ITEM).agg(F.max(F.coalesce(F.col("genres"), F.lit(""))).alias("text"))


def tfidf(items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A11 + F11: vocabulary with IDF over all catalogue items, and L2-normalised
    TF-IDF item vectors. Returns (idf, item_vecs, catalogue)."""
    docs = item_text(items).select(ITEM, tokens(F.col("text")).alias("toks"))
    n_docs = docs.agg(F.count(F.lit(1)).alias("_N"))
    tf = (docs.select(ITEM, F.size("toks").alias("_len"), F.explode("toks").alias("term"))
          .groupBy(ITEM, "term").agg(F.count(F.lit(1)).alias("_c"), F.first("_len").alias("_len")))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = df.crossJoin(F.broadcast(n_docs)).select(  # one-row side
        "term", (F.log((F.lit(1) + F.col("_N")) / (F.lit(1) + F.col("df"))) + F.lit(1.0)).alias("idf"))
    idf = global_positions(idf, [F.col("term").asc()]).select("term", (F.col("pos") - 1).alias("idx"), "idf")
    # The vocabulary size is data-dependent: no broadcast hint, AQE picks the side.
    w = tf.join(idf, "term").select(ITEM, "term", "idx", (F.col("_c") / F.col("_len") * F.col("idf")).alias("w"))
    norm = w.groupBy(ITEM).agg((F.sqrt(F.sum(F.col("w") * F.col("w"))) + F.lit(EPS)).alias("_n"))
    vecs = w.join(norm, ITEM).select(ITEM, "term", "idx", (F.col("w") / F.col("_n")).alias("weight"))
    return idf, vecs, docs.select(ITEM)


def user_profiles(train: DataFrame, item_vecs: DataFrame, catalogue: DataFrame,
                  like_threshold: float = 4.0) -> tuple[DataFrame, DataFrame]:
    """Rating-weighted mean of liked item vectors (all history when nothing
    is liked), L2-normalised. Returns (profiles, profile_users). The used ratings and
    the sums are tables: a task holds one join or aggregation at a time."""
    has_liked = train.groupBy(USER).agg(F.max((F.col(RATING) >= like_threshold).cast("int")).alias("_hl"))
    used = stored(train.join(has_liked, USER)
                  .filter((F.col(RATING) >= like_threshold) | (F.col("_hl") == 0))
                  .join(catalogue, ITEM, "left_semi")
                  .select(USER, ITEM, F.col(RATING).cast("double").alias("r")))
    wsum = stored(used.groupBy(USER).agg(F.sum("r").alias("_W")))
    sums = stored(used.join(item_vecs, ITEM).groupBy(USER, "term", "idx").agg(F.sum(F.col("r") * F.col("weight")).alias("s")))
    avg = sums.join(wsum, USER).select(USER, "term", "idx", (F.col("s") / F.col("_W")).alias("a"))
    square = F.sum(F.col("a") * F.col("a")).over(Window.partitionBy(USER))  # over a user's terms
    prof = avg.withColumn("_n", F.sqrt(square) + F.lit(EPS)).select(USER, "term", "idx", (F.col("a") / F.col("_n")).alias("weight"))
    return prof, wsum.select(USER)


def fit(train: DataFrame, items: DataFrame, like_threshold: float = 4.0, **_params) -> ContentModel:
    idf, vecs, catalogue = tfidf(items)
    idf, vecs, catalogue = materialize(idf), stored(vecs), stored(catalogue)
    prof, pusers = user_profiles(train, vecs, catalogue, like_threshold)
    prof, pusers = stored(prof), stored(pusers)
    dim = idf.count()
    n_items = catalogue.count()
    return ContentModel(materialize(global_mean(train)), idf, vecs, catalogue, prof, pusers,
                        stored(seen_pairs(train)), dim, n_items)


def cosine(m: ContentModel, pairs: DataFrame) -> DataFrame:
    """(user_id, item_id) -> cos over shared terms (0 when none)."""
    p = pairs.select(USER, ITEM).distinct()
    dots = (p.join(m.item_vecs.select(ITEM, "term", F.col("weight").alias("wi")), ITEM)
            .join(m.profiles.select(USER, "term", F.col("weight").alias("wu")), [USER, "term"])
            .groupBy(USER, ITEM).agg(F.sum(F.col("wi") * F.col("wu")).alias("cos")))
    return p.join(dots, [USER, ITEM], "left").withColumn("cos", F.coalesce("cos", F.lit(0.0)))


def predict(m: ContentModel, pairs: DataFrame) -> DataFrame:
    """clip(mu + cos) when the user has a profile and the item is catalogued, else mu."""
    known = (pairs.select(USER, ITEM).distinct()
             .join(m.profile_users, USER, "left_semi").join(m.catalogue, ITEM, "left_semi"))
    cos = cosine(m, known).withColumn("_k", F.lit(1))
    out = pairs.join(cos, [USER, ITEM], "left").crossJoin(F.broadcast(m.mu))  # one-row side
    pred = F.when(F.col("_k") == 1, clip(F.col("mu") + F.col("cos"))).otherwise(F.col("mu"))
    return out.withColumn("prediction", pred).drop("cos", "_k", "mu")


def item_vectors(m: ContentModel) -> DataFrame:
    """(item_id, vec) of every catalogue item; without terms an empty vector."""
    v = sparse_vectors(m.item_vecs, ITEM)
    return m.catalogue.join(v, ITEM, "left").select(ITEM, F.coalesce(F.col("vec"), _no_entries()).alias("vec"))


def user_vectors(m: ContentModel, users: DataFrame | None = None) -> DataFrame:
    pu = m.profile_users if users is None else m.profile_users.join(users.select(USER).distinct(), USER, "left_semi")
    v = sparse_vectors(m.profiles, USER)
    return pu.join(v, USER, "left").select(USER, F.coalesce(F.col("vec"), _no_entries()).alias("vec"))


def _no_entries():
    return F.array().cast("array<double>")


SIGNATURE_RATIO = 0.5  # use signatures when they collapse the catalogue at least 2x


def signatures(m: ContentModel) -> tuple[DataFrame, DataFrame, int]:
    """Items with identical TF-IDF vectors share every cosine. Returns
    (item_sig: item_id, group_id, pos, size; sig_vecs: group_id, vec, size; n_sigs).
    ``pos`` is the item's 1-based position by id inside its signature.
    Computed once per fitted model (cached on it, not persisted with it)."""
    cached = getattr(m, "_signatures", None)
    if cached is not None:
        return cached
    key = m.item_vecs.groupBy(ITEM).agg(F.array_sort(F.collect_list(
        F.struct(F.col("idx").alias("i"), F.col("weight").alias("w")))).alias("entries"))
    key = m.catalogue.join(key, ITEM, "left").select(ITEM, F.coalesce(entries_to_vec("entries"), _no_entries()).alias("key"))
    sig = key.groupBy("key").agg(F.min(ITEM).alias("group_id"), F.count(F.lit(1)).alias("size"))
    item_sig = materialize(rank_in_group(key.join(sig, "key").select(ITEM, "group_id", "size"),
                                         ["group_id"], [F.col(ITEM).asc()], rank_col="pos", size_col="_n").drop("_n"))
    sig_vecs = materialize(sig.select("group_id", F.col("key").alias("vec"), "size"))
    m._signatures = (item_sig, sig_vecs, sig_vecs.count())
    return m._signatures


def recommend(m: ContentModel, users: DataFrame, k: int = 10) -> DataFrame:
    """All catalogue items minus seen, ranked by cosine; no profile -> no rows.

    Scores users x distinct item vectors (signatures) when those collapse the
    catalogue, then expands only the first unseen items of the signatures a
    user needs; otherwise scores users x items in blocks."""
    return rank_catalogue(m, user_vectors(m, users), m.seen, k)


def rank_catalogue(m: ContentModel, uv: DataFrame, seen: DataFrame, k: int) -> DataFrame:
    """Top-k catalogue items per (user_id, vec) row by cosine, minus ``seen``."""
    item_sig, sig_vecs, n_sigs = signatures(m)
    uv = stored(uv)  # counted, joined and scored below
    if n_sigs > SIGNATURE_RATIO * m.n_items:
        return blocked_topk(uv, item_vectors(m), seen, k, score_fn=sparse_dot, n_items=m.n_items, pack=sparse_rows())
    seen_sig = seen.join(uv.select(USER), USER, "left_semi").join(item_sig.select(ITEM, "group_id"), ITEM)
    seen_counts = seen_sig.groupBy(USER, "group_id").agg(F.count(F.lit(1)).alias("n_seen"))
    cand = stored(blocked_group_cover(uv, sig_vecs, seen_counts, k, n_groups=n_sigs))
    # Global cover: best signatures until k unseen items, plus every tie of the last one.
    r9 = F.round("score", 9)
    before = Window.partitionBy(USER).orderBy(r9.desc(), F.col("group_id")).rowsBetween(Window.unboundedPreceding, -1)
    c = cand.withColumn("_cb", F.coalesce(F.sum("unseen").over(before), F.lit(0.0)))
    c = c.withColumn("_thr", F.min(F.when(F.col("_cb") < k, r9)).over(Window.partitionBy(USER)))
    kept = c.filter(r9 >= F.col("_thr")).select(USER, "group_id", "score", (F.lit(k) + F.col("n_seen")).alias("_need"))
    # Expand each kept signature over its first k + seen items (blocks of k positions).
    b = max(1, int(k))
    ex = kept.withColumn("_blk", F.explode(F.sequence(F.lit(1).cast("bigint"), F.ceil(F.col("_need") / b).cast("bigint"))))
    pos = item_sig.select(ITEM, "group_id", "pos", F.ceil(F.col("pos") / b).cast("bigint").alias("_blk"))
    items = ex.join(pos, ["group_id", "_blk"]).filter(F.col("pos") <= F.col("_need"))
    out = topk(exclude_seen(items.select(USER, ITEM, "score"), seen), k)
    return out.select(USER, F.col("rank").cast("int"), ITEM, "score")


def preference_vectors(m: ContentModel, prefs: DataFrame) -> DataFrame:
    """(profile_id, genre) -> L2-normalised sum of IDF per token occurrence.
    Profiles whose vector is empty or ~0 are absent (popularity fallback)."""
    toks = prefs.select("profile_id", F.explode(tokens(F.col("genre"))).alias("term"))
    v = (toks.join(broadcast_if_small(m.idf, m.dim), "term").groupBy("profile_id", "idx")
         .agg(F.sum("idf").alias("a")))
    norm = v.groupBy("profile_id").agg(F.sqrt(F.sum(F.col("a") * F.col("a"))).alias("_n"))
    return (v.join(norm.filter(F.col("_n") >= EPS), "profile_id")
            .select("profile_id", "idx", (F.col("a") / F.col("_n")).alias("weight")))


def _rank_once(m: ContentModel, uv: DataFrame, k: int) -> DataFrame:
    """``rank_catalogue`` without seen items: profiles of equal vectors have equal
    lists, so each distinct vector is ranked once, for its smallest profile."""
    uv = stored(uv.withColumn(USER, no_null_id(USER)))
    same = uv.groupBy("vec").agg(F.min(USER).alias("_first"))
    member = stored(uv.join(same, "vec").select(USER, "_first", "vec"))
    none = uv.sparkSession.createDataFrame([], f"{USER} long, {ITEM} long")
    lists = rank_catalogue(m, member.filter(F.col(USER) == F.col("_first")).select(USER, "vec"), none, k)
    return (member.select(USER, "_first").join(lists.withColumnRenamed(USER, "_first"), "_first")
            .select(USER, "rank", ITEM, "score"))


def recommend_for_preferences(m: ContentModel, prefs: DataFrame, k: int = 10,
                              exclude: DataFrame | None = None, fallback: DataFrame | None = None) -> DataFrame:
    """M13 for a batch of preference profiles: cosine top-k minus ``exclude``
    (profile_id, item_id); profiles without a usable vector get ``fallback``
    (a global (rank, item_id, score) list, e.g. popularity)."""
    prefs = stored(prefs)
    pv = preference_vectors(m, prefs)
    uv = sparse_vectors(pv.withColumnRenamed("profile_id", USER), USER)
    if exclude is None:
        recs = _rank_once(m, uv, k)
    else:
        recs = rank_catalogue(m, uv, exclude.select(F.col("profile_id").alias(USER), ITEM), k)
    recs = stored(recs).withColumnRenamed(USER, "profile_id")
    if fallback is None:
        return recs
    missing = prefs.select("profile_id").distinct().join(recs.select("profile_id").distinct(), "profile_id", "left_anti")
    fb = missing.crossJoin(F.broadcast(fallback.filter(F.col("rank") <= k).select("rank", ITEM, "score")))  # k rows
    return recs.unionByName(fb.select("profile_id", "rank", ITEM, "score"))
