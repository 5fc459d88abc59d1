"""Phrase collocation mining by top-order marginalisation.

Texts are cut at punctuation and line ends into pieces, pieces at blanks into
words; everything is counted per language.

* Windows. Each word leads one window: itself and the words that follow it in
  its piece, up to ``max_words``, padded with 0 at the piece's end. Only these
  longest windows are counted.
* Marginals. ROLLUP over the counted windows sums successively shorter
  prefixes: every occurrence of a shorter phrase is the prefix of exactly one
  window, so no other n-grams are exploded.
* Words that occur fewer than ``min_count`` times end a window, as no phrase
  with them can be a candidate. Tasks know the others from a bit table with
  ``BITS_PER_WORD`` bits for each, which may let some rare words pass but
  misses no frequent one; counts of candidates are the same with or without.
* A window belongs to its leading word, so windows are counted in ``turns``
  turns by that word's hash: the texts are read again for each, and the
  shuffle files of only one turn lie on disk at a time.
* Words are 64-bit hashes that include the language. The dictionary of all
  words is counted first; if two words of it share a hash, another seed is
  taken, so results are exact.
* Cuts. The score of a phrase of count a cut into parts of counts l and r is
  ``floor(1000000 a a / (l r))``, in 38-digit integers; the lowest counts, of
  equal ones the earliest.
* A candidate whose words lie inside a longer candidate with at least
  ``cover`` percent of its count is dropped.

Defined results: a null text has no words, a null language is ``und``; repeated
rows count each; an empty table gives no rows; other columns are ignored. Per
language the first ``top`` by score, count and phrase (UTF-8 order) return."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .scratch import Scratch
from .terms import Terms, byte_set, row_slices, terms_of
from .words import mix

BREAKS = byte_set(*map(ord, ".,;:!?"), range(0x0A, 0x0E))
GAPS = BREAKS | byte_set(0x20, 0x09)
BITS_PER_WORD = 16
_WORD_BITS = 32  # bits of the table in one row on its way to the driver
_U = np.uint64


def _langs(col: pa.Array) -> list[str]:
    return ["und" if x is None else x for x in col.to_pylist()]


def _keys(t: Terms, langs: list[str], seed: int) -> np.ndarray:
    """Hashes of (language, word), never 0."""
    code = {x: xxh64_intdigest(x, seed) for x in set(langs)}
    fold = np.array([code[x] for x in langs], dtype=np.uint64)
    with np.errstate(over="ignore"):
        h = mix(t.hashes + fold[t.rows]) if len(t.rows) else t.hashes
    h[h == 0] = 1
    return h


def _dictionary(seed: int):
    def fn(batches):
        for batch in batches:
            for part in row_slices(batch, 0, 4 << 20):
                t, langs = terms_of(part.column(0), GAPS, BREAKS, seed), _langs(part.column(1))
                h, first, n = np.unique(_keys(t, langs, seed), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array([langs[r] for r in t.rows[first].tolist()], pa.string()),
                     pa.array([t.text(k).decode() for k in first.tolist()], pa.string()), pa.array(n, pa.int64())],
                    names=["h", "lang", "word", "f"])
    return fn


def _windows(seed: int, order: int, known, size: int, turn: int, turns: int):
    def fn(batches):
        bits = np.frombuffer(known.value, np.uint8)
        for batch in batches:
            for part in row_slices(batch, 0):
                t = terms_of(part.column(0), GAPS, BREAKS, seed)
                h = _keys(t, _langs(part.column(1)), seed)
                at = h & _U(size - 1)
                frequent = (bits[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8) & 1).astype(bool)
                cols, go = [h], frequent
                for k in range(1, order):
                    nxt = np.zeros(len(h), np.uint64)
                    ok = np.zeros(len(h), bool)
                    if len(h) > k:
                        ok[:-k] = go[:-k] & frequent[k:] & (t.piece[k:] == t.piece[:-k])
                        nxt[:-k][ok[:-k]] = h[k:][ok[:-k]]
                    cols.append(nxt)
                    go = ok
                lead = frequent & ((h >> _U(32)) % _U(turns) == turn)
                yield pa.RecordBatch.from_arrays([pa.array(c[lead].view(np.int64)) for c in cols],
                                                 names=[f"w{k}" for k in range(1, order + 1)])
    return fn


def _bit_table(hashes: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """A table of 2^20 to 2^28 bits marking the hashes, by their lowest bits."""
    size = 1 << min(28, max(20, (n * BITS_PER_WORD - 1).bit_length()))
    at = F.col("h").bitwiseAND(F.lit(size - 1))
    rows = hashes.groupBy(F.shiftright(at, 5).alias("word")).agg(  # at most size / 32 rows
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(_WORD_BITS)).cast("int"))).alias("mask"))
    got = rows.select(F.col("word").cast("int").alias("word"), "mask").toArrow()
    table = np.zeros(size // _WORD_BITS, dtype=np.uint32)
    table[got.column("word").to_numpy()] = got.column("mask").to_numpy().astype(np.uint32)
    return table.view(np.uint8), size


def _names(first: int, last: int) -> list[str]:
    return [f"w{k}" for k in range(first, last + 1)]


def _scored(level: dict[int, DataFrame], m: int) -> DataFrame:
    """Phrases of m words with the counts and the score of their lowest cut."""
    out = level[m]
    for k in range(1, m):
        left = level[k].select(*_names(1, k), F.col("a").alias(f"l{k}"))
        right = level[m - k].select(*[F.col(f"w{j}").alias(f"w{j + k}") for j in range(1, m - k + 1)], F.col("a").alias(f"r{k}"))
        out = out.join(left, _names(1, k)).join(right, _names(k + 1, m))
    big = "decimal(38,0)"
    cuts = [F.struct(F.expr(f"(CAST(1000000 AS decimal(7,0)) * CAST(a AS decimal(15,0)) * CAST(a AS decimal(15,0))) div "
                            f"CAST(CAST(l{k} AS decimal(19,0)) * CAST(r{k} AS decimal(19,0)) AS {big})").alias("score"),
                     F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, m)]
    return out.withColumn("cut", F.least(*cuts) if len(cuts) > 1 else cuts[0])


def _marginals(counted: DataFrame, cols: list[str], min_count: int) -> DataFrame:
    """Phrases of all lengths and their counts, from the counts of the longest
    windows; a shorter phrase ends in 0."""
    # One condition on the count, so that it stays above the exchange, which both branches then share.
    longest = counted.filter(F.when(F.col(cols[-1]) != 0, F.col("a")).otherwise(0) >= min_count)
    shorter = (counted.rollup(*cols[:-1]).agg(F.sum("a").alias("a"), F.grouping_id().alias("gid"))
               .filter((F.col("a") >= min_count) & F.col(cols[0]).isNotNull()))
    for k in range(1, len(cols)):  # a prefix of k columns has to end in a word
        kept = (1 << (len(cols) - 1 - k)) - 1  # grouping id of that prefix
        shorter = shorter.filter((F.col("gid") != kept) | (F.col(cols[k - 1]) != 0))
    zero = F.lit(0).cast("long")
    return longest.select(*cols, "a").unionByName(
        shorter.select(*[F.coalesce(c, zero).alias(c) for c in cols[:-1]], zero.alias(cols[-1]), "a"))


def mine_collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3,
                      min_count: int = 10, cover: int = 50, top: int = 2000, turns: int = 2) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of
    2 to ``max_words`` words."""
    zero = F.lit(0).cast("long")
    spark = docs.sparkSession
    scratch = Scratch(spark)
    src = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    seed = 0
    while True:
        words = scratch.write(src.mapInArrow(_dictionary(seed), "h long, lang string, word string, f long")
                              .groupBy("h", "lang", "word").agg(F.sum("f").alias("f")))
        if words.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1").isEmpty():
            break
        seed += 1

    frequent = words.filter(F.col("f") >= min_count)
    bits, size = _bit_table(frequent.select("h"), frequent.count())
    known = spark.sparkContext.broadcast(bits.tobytes())
    cols = _names(1, max_words)
    found = None
    for turn in range(turns):
        counted = (src.mapInArrow(_windows(seed, max_words, known, size, turn, turns), ", ".join(f"{c} long" for c in cols))
                   .groupBy(*cols).agg(F.count("*").alias("a")))
        part = scratch.write(_marginals(counted, cols, min_count))
        found = part if found is None else found.unionByName(part)

    level = {}
    for m in range(1, max_words + 1):
        exact = F.col(f"w{m}") != 0
        if m < max_words:
            exact = exact & (F.col(f"w{m + 1}") == 0)
        level[m] = found.filter(exact).select(*_names(1, m), "a")
    ranked = None
    for m in range(2, max_words + 1):
        part = _scored(level, m)
        inside = [level[longer].select(*[F.col(f"w{s + j}").alias(f"w{j}") for j in range(1, m + 1)], F.col("a").alias("around"))
                  for longer in range(m + 1, max_words + 1) for s in range(longer - m + 1)]
        if inside:
            around = inside[0]
            for x in inside[1:]:
                around = around.unionByName(x)
            around = around.groupBy(*_names(1, m)).agg(F.max("around").alias("around"))
            part = part.join(around, _names(1, m), "left").filter(
                F.col("around").isNull() | (100 * F.col("around") < cover * F.col("a")))
        part = part.select(*_names(1, m), *[zero.alias(c) for c in _names(m + 1, max_words)], "a", "cut.l", "cut.r", "cut.score")
        ranked = part if ranked is None else ranked.unionByName(part)

    # The first by score and count, ties of the last one included, then names.
    lead = words.select(F.col("h").alias("w1"), "lang", F.col("word").alias("t1"))
    by = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    first = scratch.write(ranked.join(lead, "w1").withColumn("place", F.rank().over(by)).filter(F.col("place") <= top).drop("place"))
    for k in range(2, max_words + 1):
        first = first.join(words.select(F.col("h").alias(f"w{k}"), F.col("word").alias(f"t{k}")), f"w{k}", "left")
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    phrase = F.concat_ws(" ", *[F.col(f"t{k}") for k in range(1, max_words + 1)])
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    out = (first.withColumn("phrase", phrase).withColumn("rank", F.row_number().over(order).cast("long"))
           .filter(F.col("rank") <= top).join(total, "lang"))
    out = scratch.finish(out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
    known.unpersist()
    return out
