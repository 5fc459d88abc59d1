"""Secret scan with corpus-wide ownership frequency. DataFrame functions only.

Base kinds, leftmost non-overlapping matches each: ``assign`` (a credential
word, an assignment sign and a value of 8 or more characters), ``access``
(``AKIA`` and upper-case letters or digits, 16 or more in all) and ``hex`` (32
or more lower-case hexadecimal digits).

Ownership. Every value found, and every long mixed token (``[A-Za-z0-9+/_=-]``,
``MIXED`` or more characters with letters and digits), is a candidate. Over the
whole corpus each candidate's hash is counted by distinct repositories and
distinct owners; both are reduced to distinct pairs before and after the
shuffle, so a value copied into a third of all rows costs one row per task and
owner. A candidate held by ``WIDELY`` or more owners, or in ``SPREAD`` or more
repositories of fewer owners (a sample file that one owner copies along), is a
widely copied example. Others are owner-specific, and live-looking when their
characters are varied. Live-looking tokens that no base match covers become spans of kind
``owned``; base spans always stay.

Offsets are code points, end exclusive. A span is kind:start:end.

Defined results: a null or empty text has no span (empty strings, the digest of
the empty string); repeated rows keep one output row each; a null owner or
repository counts as one of its own; a null id is kept; an empty table gives no rows; columns
other than id, text, owner and repository are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch, checked_broadcast

# Fixed patterns of the base kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # the run is taken whole, so 16 or more in all
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "owned")
MIXED = 20
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
WIDELY, SPREAD = 3, 6  # owners, repositories
VARIED = 8  # distinct characters of a live-looking value


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _located(text: Column, pattern: str, found: Column) -> Column:
    """array<struct(s, e, v)> of the matches ``found`` of a pattern: the text
    between matches, and the matches, add up to the offsets."""
    gaps = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,v:string>>").alias("out"))

    def step(acc, i):
        s = acc["at"] + F.length(F.get(gaps_var[0], i))
        e = s + F.length(F.get(found, i))
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(
            F.struct(s.alias("s"), e.alias("e"), F.get(found, i).alias("v")))).alias("out"))

    gaps_var: list[Column] = [gaps]

    def fold(g):
        gaps_var[0] = g
        return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), start, step, lambda acc: acc["out"])

    return F.when(F.size(found) > 0, F.element_at(F.transform(F.array(gaps), fold), 1)).otherwise(
        F.array().cast("array<struct<s:int,e:int,v:string>>"))


def _value(match: Column) -> Column:
    return F.regexp_extract(match, ASSIGN, 2)


def scan(docs: DataFrame) -> DataFrame:
    """Adds ``assign``, ``access``, ``hex`` and ``tokens``: arrays of located
    matches of column ``t``. A token is a long run with letters and digits."""
    raw = docs.select("*", _all(F.col("t"), ASSIGN).alias("_a"), _all(F.col("t"), ACCESS).alias("_k"),
                      _all(F.col("t"), HEX).alias("_h"), _all(F.col("t"), TOKEN).alias("_m"))
    return raw.select(
        *docs.columns,
        F.filter(_located(F.col("t"), ASSIGN, F.col("_a")), lambda x: F.length(_value(x["v"])) >= 8).alias("assign"),
        _located(F.col("t"), ACCESS, F.col("_k")).alias("access"),
        _located(F.col("t"), HEX, F.col("_h")).alias("hex"),
        F.filter(_located(F.col("t"), TOKEN, F.col("_m")),
                 lambda x: x["v"].rlike("[0-9]") & x["v"].rlike("[A-Za-z]")).alias("tokens"))


def _spans(found: Column, kind: int) -> Column:
    return F.transform(found, lambda x: F.struct(x["s"].alias("s"), F.lit(kind).alias("k"), x["e"].alias("e")))


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def ownership(candidates: DataFrame) -> DataFrame:
    """(h, n_owners, n_repos, example, live) for each candidate value of
    (v, owner, repo): counts by distinct owner and repository."""
    pairs = candidates.select(F.sha2("v", 256).alias("h"), "v", "owner", "repo").distinct()
    repos = pairs.groupBy("h").agg(F.count("*").alias("n_repos"), F.min("v").alias("v"))
    owners = pairs.select("h", "owner").distinct().groupBy("h").agg(F.count("*").alias("n_owners"))
    varied = F.size(F.array_distinct(F.split("v", "")))
    copied = (F.col("n_owners") >= WIDELY) | (F.col("n_repos") >= SPREAD)
    return repos.join(owners, "h").select(
        "h", "n_owners", "n_repos", copied.alias("example"),
        (~copied & (varied >= VARIED) & F.col("v").rlike("[0-9]") & F.col("v").rlike("[A-Za-z]")).alias("live"))


def _marked(found: str, is_value: bool) -> Column:
    return F.transform(found, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["v"].alias("v"),
                                                 F.lit(is_value).alias("is_value")))


def _uncovered(each: DataFrame) -> DataFrame:
    """Adds ``free``: a token that overlaps no base match of its text. Two sorted
    sweeps over a text's matches: the furthest end of the base matches that start
    at or before it, the nearest start of those after."""
    up = Window.partitionBy("row").orderBy("s").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy("row").orderBy(F.desc("s")).rangeBetween(Window.unboundedPreceding, -1)
    reach, following = F.max(F.when(F.col("is_value"), F.col("e"))).over(up), F.min(F.when(F.col("is_value"), F.col("s"))).over(down)
    swept = each.withColumn("reach", reach).withColumn("following", following)
    return swept.withColumn("free", ~F.col("is_value") & F.coalesce(F.col("reach") <= F.col("s"), F.lit(True))
                            & F.coalesce(F.col("following") >= F.col("e"), F.lit(True))).drop("reach", "following")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repo_cols: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """doc_id, a hash of the text, counts of the base kinds, base and all spans
    as strings, and per row the number of its values that are widely copied
    examples and that are live-looking, and the most repositories that hold one
    of them."""
    scratch = Scratch(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"),
                      F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
                      F.to_json(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(repo_cols)])).alias("repo"))
    scanned = scan(src)
    base = F.concat(_spans(F.col("assign"), 0), _spans(F.col("access"), 1), _spans(F.col("hex"), 2))
    values = F.concat(F.transform("assign", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), _value(x["v"]).alias("v"))),
                      F.col("access"), F.col("hex"))
    rows = scratch.write(scanned.select(
        "doc_id", F.xxhash64("t").alias("text_hash"), "owner", "repo", F.size("assign").cast("long").alias("n_assign"), F.size("access").cast("long").alias("n_access"),
        F.size("hex").cast("long").alias("n_hex"), base.alias("base"), values.alias("vals"), "tokens")
        .withColumn("row", F.monotonically_increasing_id()))
    found = F.concat(_marked("vals", True), _marked("tokens", False))
    each = scratch.write(_uncovered(rows.filter("size(vals) + size(tokens) > 0").select(
        "row", "owner", "repo", F.explode(found).alias("x")).select("row", "owner", "repo", "x.*")))
    verdicts = scratch.write(ownership(each.select("v", "owner", "repo")))
    judged = each.withColumn("h", F.sha2("v", 256)).join(verdicts, "h")
    more = judged.groupBy("row").agg(
        F.sort_array(F.collect_set(F.when(F.col("free") & F.col("live"), F.struct(
            F.col("s"), F.lit(3).alias("k"), F.col("e"))))).alias("owned"),
        F.max(F.when(F.col("is_value"), F.col("n_repos"))).alias("max_repos"),
        F.sum((F.col("is_value") & F.col("example")).cast("long")).alias("n_examples"),
        F.sum((F.col("is_value") & F.col("live")).cast("long")).alias("n_live"))
    none = F.array().cast("array<struct<s:int,k:int,e:int>>")
    return scratch.finish(rows.join(more, "row", "left").select(
        "doc_id", "text_hash", "n_assign", "n_access", "n_hex", _joined(F.col("base")).alias("base_spans"),
        _joined(F.concat("base", F.coalesce("owned", none))).alias("spans"),
        F.coalesce("n_examples", F.lit(0).cast("long")).alias("n_examples"),
        F.coalesce("n_live", F.lit(0).cast("long")).alias("n_live"),
        F.coalesce("max_repos", F.lit(0).cast("long")).alias("max_repos")))


def masked_texts(docs: DataFrame, mask: str, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars",
                 **scan_params) -> DataFrame:
    """The same rows and columns with every span of the text replaced by
    ``mask`` (overlapping spans by one); ``size_col`` follows where it exists."""
    found = scan_secrets(docs, id_col, text_col, **scan_params).filter("spans <> ''").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("spans").alias("_spans")).distinct()
    text = F.col(text_col)
    cut = F.transform(F.split("_spans", ","), lambda x: F.struct(
        F.element_at(F.split(x, ":"), 2).cast("int").alias("s"), F.element_at(F.split(x, ":"), 3).cast("int").alias("e")))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, x):
        free = F.when(x["s"] >= acc["at"], F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.lit(mask)))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), free.otherwise(acc["out"]).alias("out"))

    masked = F.aggregate(cut, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    kept = docs.columns
    joined = docs.join(checked_broadcast(found, max_bytes=32 << 20), (F.col(id_col).cast("long").eqNullSafe(F.col("_id")))
                       & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("_hash")), "left")
    out = joined.withColumn(text_col, F.when(F.col("_spans").isNotNull(), masked).otherwise(text))
    if size_col in kept:
        kind = docs.schema[size_col].dataType
        out = out.withColumn(size_col, F.when(F.col("_spans").isNotNull(), F.length(text_col).cast(kind)).otherwise(F.col(size_col)))
    return out.select(*kept)
