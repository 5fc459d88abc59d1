"""Quality rules under weak supervision, in DataFrame functions only.

Each rule votes that a text is good (1) or bad (0) or abstains (-1).
Expectation-maximisation estimates, without labels, how often a rule is right
on good and on bad texts and how common good texts are; the posterior
probability of good quality replaces all-rules-must-pass filtering.

Texts enter the estimation only through their vote pattern, so it works on at
most 3^10 counted patterns; the counts cover every row and are combined before
the shuffle. All iterations are one higher-order expression over that single
row, and the posterior of each pattern is joined back to the texts.

Measures per text: ``n_words``, ``word_chars`` (code points in words),
``n_symbols`` (characters of ``#*$%&|<>``), ``n_dup_lines`` (lines with a word
equal to an earlier line), ``n_repeat_words`` (words in 5-word windows found at
least twice in the text, first ones included). Words are
``[^\\x20\\x09-\\x0D]+``. Windows are compared by 64-bit hash.

Defined results: a null or empty text has all measures 0, fails the base
conditions and is not kept; repeated rows keep one output row each; an empty
table gives no rows; other columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
ROUNDS = 30
# Where the estimation starts: rules rarely blame good text, and each knows few kinds of bad text.
START_PRIOR, START_GOOD, START_BAD = 0.5, 0.98, 0.3
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# name, condition to vote good, condition to vote bad; neither: abstain. The
# conditions are plain SQL over the measures and read the same in any dialect.
RULES = (
    ("length", "n_words >= 25", "n_words < 12"),
    ("word_size", "2 * word_chars >= 5 * n_words AND word_chars <= 10 * n_words", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    ("symbols", "50 * n_symbols <= n_words", "5 * n_symbols >= n_words"),
    ("lines", "n_lines >= 2 AND n_dup_lines = 0", "n_lines >= 2 AND 10 * n_dup_lines >= 3 * n_lines"),
    ("repeats", "50 * n_repeat_words <= n_words", "10 * n_repeat_words > n_words"),
    ("capitals", "100 * n_capitals <= 20 * word_chars", "100 * n_capitals >= 40 * word_chars"),
    ("variety", "100 * n_distinct >= 30 * n_words", "100 * n_distinct < 18 * n_words"),
    ("shouting", "50 * n_exclaims <= n_words", "5 * n_exclaims >= n_words"),
    ("letters", "100 * n_others <= 7 * word_chars", "100 * n_others >= 11 * word_chars"),
    ("plain_words", "20 * n_others <= 7 * n_words", "10 * n_others >= 6 * n_words"),
)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _windows(words: Column, n: int) -> Column:
    """Hashes of all windows of n words."""
    return F.when(F.size(words) >= n, F.transform(
        F.sequence(F.lit(0), F.size(words) - n),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))).otherwise(F.array().cast("array<bigint>"))


def _repeat_words(windows: Column, n: int) -> Column:
    """Words covered by windows that occur twice or more."""
    def covered(pos: Column) -> Column:  # increasing starts of such windows
        return F.aggregate(F.sequence(F.lit(1), F.size(pos)), F.lit(0).cast("bigint"), lambda acc, k: acc + F.when(
            k < F.size(pos), F.least(F.lit(n).cast("int"), F.get(pos, k) - F.get(pos, k - 1))).otherwise(n))

    def starts(s: Column) -> Column:  # (hash, start) sorted by hash
        at = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: (
            F.coalesce(F.get(s, k - 1)["g"] == F.get(s, k)["g"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["g"] == F.get(s, k)["g"], F.lit(False))))
        return F.array_sort(F.transform(at, lambda k: F.get(s, k)["i"]))

    ordered = F.array_sort(F.transform(windows, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")).otherwise(
        let(let(ordered, starts), covered))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the counts that rules and base conditions use."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    parts = src.select("doc_id", "t", words_of(F.col("t")).alias("w"), F.filter(
        F.split("t", "\n"), lambda line: F.length(F.btrim(line, F.lit(SPACES))) > 0).alias("l"))
    return parts.withColumn("g", _windows(F.col("w"), 5)).select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.octet_length("t") - F.octet_length(_without(F.col("t"), SYMBOLS))).cast("long").alias("n_symbols"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("g"), 5).cast("long").alias("n_repeat_words"),
        F.regexp_count("t", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        (F.octet_length("t") - F.octet_length(_without(F.col("t"), "!"))).cast("long").alias("n_exclaims"),
        F.regexp_count("t", F.lit(r"[^\p{L}\x20\x09-\x0D]")).cast("long").alias("n_others"))


def _sum(items: Column, value) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, x: acc + value(x))


def _posterior(votes: Column, state: Column) -> Column:
    evidence = F.transform(votes, lambda v, j: F.when(v == 1, F.log(F.get(state["good"], j) / (1 - F.get(state["bad"], j))))
                           .when(v == 0, F.log((1 - F.get(state["good"], j)) / F.get(state["bad"], j))).otherwise(0.0))
    return 1 / (1 + F.exp(-(F.log(state["prior"] / (1 - state["prior"])) + _sum(evidence, lambda x: x))))


def _bounded(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(0.002)), F.lit(0.998))


def _em_round(state: Column, patterns: Column) -> Column:
    """One expectation and one maximisation step. The starting value counts as
    one text, which keeps an estimate where a rule always abstains."""
    def update(scored: Column) -> Column:
        total = _sum(scored, lambda p: p["n"])
        rules = F.sequence(F.lit(0), F.lit(len(RULES) - 1))

        def right(j: Column, vote: int, start: float, weight) -> Column:
            hit = _sum(scored, lambda p: F.when(F.get(p["v"], j) == vote, weight(p)).otherwise(0.0))
            any_vote = _sum(scored, lambda p: F.when(F.get(p["v"], j) >= 0, weight(p)).otherwise(0.0))
            return _bounded((hit + start) / (any_vote + 1.0))

        return F.struct(
            _bounded(_sum(scored, lambda p: p["n"] * p["q"]) / total).alias("prior"),
            F.transform(rules, lambda j: right(j, 1, START_GOOD, lambda p: p["n"] * p["q"])).alias("good"),
            F.transform(rules, lambda j: right(j, 0, START_BAD, lambda p: p["n"] * (1 - p["q"]))).alias("bad"))

    return let(F.transform(patterns, lambda p: F.struct(
        p["v"].alias("v"), p["n"].alias("n"), _posterior(p["v"], state).alias("q"))), update)


def estimate(voted: DataFrame) -> DataFrame:
    """One row for each vote pattern with its posterior of good quality."""
    counted = voted.groupBy("votes").agg(F.count("*").cast("double").alias("n"))  # 3^rules patterns at most
    one = counted.agg(F.sort_array(F.collect_list(F.struct(F.col("votes").alias("v"), F.col("n")))).alias("ps"))
    start = F.struct(F.lit(START_PRIOR).alias("prior"), F.array_repeat(F.lit(START_GOOD), len(RULES)).alias("good"),
                     F.array_repeat(F.lit(START_BAD), len(RULES)).alias("bad"))
    fitted = one.select("ps", F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start,
                                          lambda s, _: _em_round(s, F.col("ps"))).alias("state"))
    return fitted.select("state", F.explode("ps").alias("p")).select(
        F.col("p.v").alias("votes"), _posterior(F.col("p.v"), F.col("state")).alias("posterior"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """doc_id, measures, base_failed, votes, posterior and kept for every row."""
    scratch = Scratch(docs.sparkSession)
    voted = scratch.write(measures(docs, id_col, text_col).withColumn("votes", F.array(*[
        F.expr(f"CAST(CASE WHEN {good} THEN 1 WHEN {bad} THEN 0 ELSE -1 END AS INT)") for _, good, bad in RULES])))
    posterior = scratch.write(estimate(voted))
    failed = F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")
    out = voted.join(F.broadcast(posterior), "votes")  # 3^rules rows at most
    return scratch.finish(out.select("doc_id", *MEASURES, failed.alias("base_failed"), "votes", "posterior",
                                     (~failed & (F.col("posterior") >= least)).alias("kept")))
