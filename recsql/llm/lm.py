"""Cross-entropy difference scoring (Moore and Lewis 2010).

Two bigram models, one of the target documents and one of all others, share
one vocabulary, one list of bigrams and one smoothing, so their losses are
comparable token by token; a document's score is its mean loss per token under
the target model minus that under the background model (lower: more like the
target).

Counts cover every word of every document: tasks combine their own counts, the
shuffle adds them up per word and per bigram, and what is shuffled grows with
the input, as packed counts by buckets of keys whose number follows the size of
the texts. The vocabulary holds every word; a bigram is listed if it is seen
twice or more, whatever the size of the input. A bigram not listed backs off to
the word's share, and the probability of unlisted bigrams goes there, so each
history's distribution adds up to one.

The loss of a token is what its history's rest and its word's share cost, less
a correction if its bigram is listed. These costs are Spark tables. The most
frequent words and bigrams (``HELD_WORDS``, ``HELD_PAIRS``) are also sent to
the tasks, which add them up in place; for all others a task gives out one row
per occurrence, joined to the tables and summed per document. A bit table of
the listed bigrams spares most rows of those not listed. Which entries are held
changes the work, not the result, and leaves no hot key to the join.

With ``vocabulary`` and ``bigrams`` the model is limited to that many words
(any other is the unknown word) and listed bigrams; both cut-offs fall between
powers of the count, read off a small histogram.

Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, by 64-bit hash. The first
word follows a start mark.

Defined results: a null or empty text has 0 tokens and losses and score 0;
repeated rows are counted and scored once each; without target documents (or
without others) that model is uniform over the vocabulary; an empty table
gives no rows; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .words import string_buffers, word_hashes

WEIGHT = 0.6  # of a bigram's own frequency, against the word's share
FLUSH = 1 << 22
HELD_WORDS, HELD_PAIRS = 262_144, 1_500_000  # sent to the tasks; the rest is joined
_START, _WORD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)  # start mark; history of a word's own count
BUCKET = 1 << 21  # bytes of text whose bigrams are added up at a time
COUNT_TURNS, SCORE_TURNS = 2, 3  # shares of the bigrams and of the documents, one after the other, to hold less shuffled data at once
SIEVE = 28  # bits of a key, at most, that say whether it may be listed
SIEVE_ROOM = 6  # bits more than the listed keys would need
SLICE = 1 << 21  # bytes of text that a task works on at a time
_HISTOGRAM = 8  # cut-offs per doubling of the count


def _slices(batch: pa.RecordBatch, limit: int = SLICE):
    _, offsets = string_buffers(batch.column(1))
    at = 0
    while at < batch.num_rows:
        to = min(batch.num_rows, max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1))
        yield batch.slice(at, to - at)
        at = to


class _Tally:
    """Counts of 64-bit keys by kind, merged whenever FLUSH keys have come."""

    def __init__(self):
        self.held, self.fresh, self.waiting = None, [], 0

    def add(self, keys: np.ndarray, target: np.ndarray) -> None:
        self.fresh.append((keys, target))
        self.waiting += len(keys)
        if self.waiting >= FLUSH:
            self.merge()

    def merge(self) -> None:
        if self.fresh:
            keys = np.concatenate([k for k, _ in self.fresh])
            target = np.concatenate([t for _, t in self.fresh])
            order = np.argsort(keys, kind="stable")
            keys, target = keys[order], target[order].astype(np.int64)
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
            hits = np.add.reduceat(target, first) if len(first) else target
            total = np.diff(np.append(first, len(keys)))
            parts = [(keys[first], hits, total - hits)] + ([self.held] if self.held else [])
            keys, t, b = (np.concatenate(x) for x in zip(*parts, strict=True))
            if self.held:
                order = np.argsort(keys, kind="stable")
                keys, t, b = keys[order], t[order], b[order]
                first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                keys, t, b = keys[first], np.add.reduceat(t, first), np.add.reduceat(b, first)
            self.held, self.fresh, self.waiting = (keys, t, b), [], 0

    def batches(self):
        self.merge()
        keys, t, b = self.held or (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        for at in range(0, len(keys), 100_000):
            s = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(keys[s].view(np.int64)), pa.array(t[s]), pa.array(b[s])],
                                             names=["k", "t", "b"])


def _kinds(batch: pa.RecordBatch, counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.asarray(batch.column(2).to_pylist(), dtype=bool), counts)


def _count_words(batches):
    tally = _Tally()
    for batch in batches:
        for part in _slices(batch):
            words, first = word_hashes(part.column(1))
            tally.add(words, _kinds(part, np.diff(first)))
    yield from tally.batches()


def _bigrams(part: pa.RecordBatch, vocabulary: np.ndarray):
    """(history id, word id, row's first token) of all tokens; ids are places
    in the sorted vocabulary, then the unknown word, then the start mark."""
    words, first = word_hashes(part.column(1))
    at = np.searchsorted(vocabulary, words)
    ids = np.full(len(words), len(vocabulary), dtype=np.int64)
    if len(vocabulary):
        known = vocabulary[np.minimum(at, len(vocabulary) - 1)] == words
        ids[known] = at[known]
    history = np.empty_like(ids)
    history[1:] = ids[:-1]
    starts = first[:-1][np.diff(first) > 0]
    history[starts] = len(vocabulary) + 1
    return history, ids, first


def _count_bigrams(shared):
    def fn(batches):
        vocabulary = shared.value
        tally = _Tally()
        for batch in batches:
            for part in _slices(batch):
                history, ids, first = _bigrams(part, vocabulary)
                tally.add((history * (len(vocabulary) + 2) + ids).astype(np.uint64), _kinds(part, np.diff(first)))
        yield from tally.batches()
    return fn


def _step():
    return F.floor(F.log2(F.col("t") + F.col("b")) * _HISTOGRAM)


def _cut_off(counts: DataFrame, most: int):
    """(lowest step of the most frequent keys, at most ``most``: None for no
    step; how many keys are left out)."""
    table = sorted(((r["s"], r["n"]) for r in counts.groupBy(_step().alias("s")).agg(F.count("*").alias("n")).collect()),
                   reverse=True)  # a few hundred rows
    cut, have = None, 0
    for s, n in table:
        if have + n > most:
            return cut, sum(n for _, n in table) - have
        cut, have = s, have + n
    return cut, 0


def _largest(counts: DataFrame, most: int) -> DataFrame:
    """The most frequent keys, at most ``most``: all from one cut-off up."""
    cut, _ = _cut_off(counts, most)
    return counts.filter(_step() >= cut) if cut is not None else counts.filter("false")


class Models:
    """Word shares and listed bigram frequencies of both kinds."""

    def __init__(self, vocabulary, words, totals, keys, pairs, histories):
        size = len(vocabulary) + 2
        self.vocabulary, self.keys = vocabulary, keys
        self.share, self.rest, self.bigram = [], [], []
        for kind in (0, 1):
            count = np.zeros(size)
            count[:len(vocabulary)] = words[kind]
            count[-2] = totals[kind] - count.sum()
            self.share.append((count + 1) / (totals[kind] + size))
            before = np.maximum(histories[kind], 1e-9)
            listed = np.bincount(keys // size, weights=pairs[kind], minlength=size) if len(keys) else np.zeros(size)
            self.rest.append(1 - WEIGHT * np.minimum(listed / before, 1))
            self.bigram.append((WEIGHT * pairs[kind] / before[keys // size]).astype(np.float32))

    def losses(self, history: np.ndarray, ids: np.ndarray) -> list[np.ndarray]:
        key = history * (len(self.vocabulary) + 2) + ids
        at = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
        listed = self.keys[at] == key if len(self.keys) else np.zeros(len(key), dtype=bool)
        out = []
        for share, rest, bigram in zip(self.share, self.rest, self.bigram, strict=True):
            p = rest[history] * share[ids]
            p[listed] += bigram[at[listed]]
            out.append(-np.log(p))
        return out


def _score(shared):
    def fn(batches):
        models = shared.value
        for batch in batches:
            for part in _slices(batch):
                history, ids, first = _bigrams(part, models.vocabulary)
                n = np.diff(first)
                mean = []
                for loss in models.losses(history, ids):
                    run = np.concatenate([[0.0], np.cumsum(loss)])
                    mean.append((run[first[1:]] - run[first[:-1]]) / np.maximum(n, 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n.astype(np.int64)), pa.array(mean[0]), pa.array(mean[1]),
                     pa.array(mean[0] - mean[1])],
                    names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"])
    return fn


def _mixed(words: np.ndarray) -> np.ndarray:
    """Scrambled hashes, one to one (the end of splitmix64)."""
    x = words ^ (words >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


START = int(_START.view(np.int64))
START_KEY, WORD_KEY = (int(_mixed(np.array([x]))[0].view(np.int64)) for x in (_START, _WORD))


def _tokens(part: pa.RecordBatch):
    """(word, scrambled history, row's first token) of all tokens."""
    words, first = word_hashes(part.column(1))
    words = words.view(np.uint64)
    history = np.empty_like(words)
    history[1:] = words[:-1]
    history[first[:-1][np.diff(first) > 0]] = _START
    return words, _mixed(history), first


def _summed(keys, history, t, b):
    """Counts per key, in order of the keys."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    if not len(keys):
        return keys, history, t.astype(np.int64), b.astype(np.int64)
    return (keys[first], history[order[first]], np.add.reduceat(t[order].astype(np.int64), first),
            np.add.reduceat(b[order].astype(np.int64), first))


def _packed(fresh: list, buckets: int, turn: int) -> pa.RecordBatch:
    """One row per bucket of keys: the counts of this turn's bigrams and, in turn
    0, of words under the history WORD_KEY; there START counts the begun rows."""
    keys, history, target = (np.concatenate(x) for x in zip(*fresh, strict=True))
    own = keys ^ history
    mine = keys % np.uint64(COUNT_TURNS) == np.uint64(turn)
    keys, before, t, b = _summed(keys[mine], history[mine], target[mine], ~target[mine])
    words = keys ^ before
    if turn == 0:
        begun = target[history == np.uint64(START_KEY % (1 << 64))]
        own, _, own_t, own_b = _summed(own, own, target, ~target)
        words = np.concatenate([words, own, [_START]])
        t, b = np.concatenate([t, own_t, [begun.sum()]]), np.concatenate([b, own_b, [(~begun).sum()]])
        before = np.append(before, np.full(len(own) + 1, np.uint64(WORD_KEY % (1 << 64))))
    history = before
    bucket = (_mixed(history ^ words) % np.uint64(buckets)).astype(np.int64)
    # Numbers of 16 bits are sorted by counting them.
    order = np.argsort(bucket.astype(np.uint16), kind="stable") if buckets <= 1 << 16 else np.argsort(bucket)
    bucket = bucket[order]
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[:len(bucket)])
    ends = np.append(first[1:], len(bucket)) if len(first) else first
    columns = [x[order].astype(kind) for x, kind in ((history, np.uint64), (words, np.uint64), (t, np.uint32), (b, np.uint32))]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[first]), *(pa.array([x[i:j].tobytes() for i, j in zip(first, ends, strict=True)], pa.binary()) for x in columns)],
        names=["bucket", "h", "w", "t", "b"])


def _count(buckets: int, turn: int):
    def fn(batches):
        fresh, waiting = [], 0
        for batch in batches:
            for part in _slices(batch):
                words, history, first = _tokens(part)
                if len(words):
                    fresh.append((history ^ words, history, _kinds(part, np.diff(first))))
                    waiting += len(words)
                if waiting >= FLUSH // 8:
                    yield _packed(fresh, buckets, turn)
                    fresh, waiting = [], 0
        if fresh:
            yield _packed(fresh, buckets, turn)
    return fn


def _unpacked(table: pa.Table) -> pa.Table:
    """The sums of one bucket: words, and bigrams seen twice or more."""
    h, w, t, b = (np.frombuffer(b"".join(table.column(k).to_pylist()), dtype=kind)
                  for k, kind in (("h", np.uint64), ("w", np.uint64), ("t", np.uint32), ("b", np.uint32)))
    keys, h, t, b = _summed(h ^ w, h, t, b)
    kept = (t + b >= 2) | (h == np.uint64(WORD_KEY % (1 << 64)))
    return pa.table({"h": h[kept].view(np.int64), "w": (keys ^ h)[kept].view(np.int64), "t": t[kept], "b": b[kept]})


def _keyed(batches):
    for batch in batches:
        h = _mixed(batch.column(0).to_numpy().view(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(h)], names=["w", "t", "b", "h"])


class Costs:
    """Held costs: of words as tokens and as histories, and corrections of
    bigrams, each for both kinds; rows in order of the keys."""

    def __init__(self, words, pairs, start, sieve):
        self.words, self.as_word, self.as_history = self._sorted(words, ("wt", "wb"), ("ht", "hb"))
        self.pairs, self.correction = self._sorted(pairs, ("wt", "wb"))
        self.places = {"words": self._places(self.words), "pairs": self._places(self.pairs)}
        self.start = start
        self.sieve, self.dropped = sieve or (None, 0)  # bits of all listed pairs that are not held (None: there are
        # none); bits of a key that it leaves out

    @staticmethod
    def _sorted(rows, *names):
        keys = rows["key"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys)
        return keys[order], *([rows[k].to_numpy(np.float64)[order] for k in pair] for pair in names)

    @staticmethod
    def _places(keys: np.ndarray) -> tuple[np.ndarray, np.uint64]:
        """The first place of keys with each leading bits, as many bits as leave about one key."""
        bits = max(1, len(keys).bit_length())
        leading = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
        return np.searchsorted(keys, leading).astype(np.int32), np.uint64(64 - bits)

    def find(self, held: str, wanted: np.ndarray):
        """(place, whether it is there) of each among the held words or pairs: a few steps from the first key with
        its leading bits, for keys are hashes; a binary search beyond that."""
        keys = getattr(self, held)
        if not len(keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), dtype=bool)
        first, shift = self.places[held]
        at = np.minimum(first[wanted >> shift], len(keys) - 1)
        below = np.flatnonzero(keys[at] < wanted)
        for _ in range(6):
            at[below] = np.minimum(at[below] + 1, len(keys) - 1)
            below = below[keys[at[below]] < wanted[below]]
        at[below] = np.minimum(np.searchsorted(keys, wanted[below]), len(keys) - 1)
        return at, keys[at] == wanted


def _sieved(keys: pa.Table) -> pa.Table:
    at = keys.column("at").to_numpy()
    bits = np.zeros(1 << 20, dtype=bool)
    bits[at & ((1 << 20) - 1)] = True
    return pa.table({"block": pa.array([int(at[0]) >> 20], pa.int64()), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})


def _sieve(pairs: DataFrame, many: int) -> tuple[np.ndarray, int]:
    """Bits, by how many keys there are, and how many bits of a key they leave out."""
    bits = min(SIEVE, max(20, many.bit_length() + SIEVE_ROOM))
    at = F.shiftrightunsigned("key", 64 - bits)
    blocks = (pairs.select(at.alias("at"), F.shiftright(at, 20).alias("block")).groupBy("block")
              .applyInArrow(_sieved, "block long, bits binary"))
    out = np.zeros((1 << bits) // 8, dtype=np.uint8).reshape(-1, (1 << 20) // 8)
    for r in blocks.collect():  # 256 rows at most
        out[r["block"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out.reshape(-1), 64 - bits


LOOKED_UP = ("row long, doc_id long, n long, lt double, lb double, is_word boolean, key long, before boolean")


def _losses(shared, whole: bool):
    """Per row: what the held costs add up to; then, unless the ``whole`` tables
    are held, every occurrence of a word or bigram that is not (``before``: the
    word is also a history)."""
    def fn(batches):
        costs = shared.value
        for batch in batches:
            for part in _slices(batch):
                words, history, first = _tokens(part)
                n = np.diff(first)
                begins = first[:-1][n > 0]
                keys = history ^ words
                at, known = costs.find("words", words)
                pair, listed = costs.find("pairs", keys)
                sums = []
                for kind in (0, 1):
                    loss = np.zeros(len(words))
                    if len(costs.words):
                        loss[known] = costs.as_word[kind][at[known]]
                        before = np.where(known, costs.as_history[kind][at], 0.0)
                        loss[1:] += before[:-1]
                        loss[begins[begins > 0]] -= before[begins[begins > 0] - 1]
                    loss[begins] += costs.start[kind]
                    if len(costs.pairs):
                        loss[listed] += costs.correction[kind][pair[listed]]
                    run = np.concatenate([[0.0], np.cumsum(loss)])
                    sums.append(run[first[1:]] - run[first[:-1]])
                nothing = pa.nulls(part.num_rows, pa.bool_())
                yield _looked_up(part.column(2), part.column(0), pa.array(n.astype(np.int64)), pa.array(sums[0]),
                                 pa.array(sums[1]), nothing, part.column(2), nothing)
                if whole:
                    continue
                rows = np.repeat(part.column(2).to_numpy(), n)
                goes_on = np.ones(len(words), dtype=bool)
                goes_on[first[1:][n > 0] - 1] = False
                wanted = np.flatnonzero(~listed) if costs.sieve is not None else np.zeros(0, np.int64)
                if len(wanted):
                    bit = keys[wanted] >> np.uint64(costs.dropped)
                    wanted = wanted[(costs.sieve[bit >> np.uint64(3)] >> (7 - (bit & np.uint64(7))).astype(np.uint8)) & 1 == 1]
                for where, key, is_word in ((np.flatnonzero(~known), words, True), (wanted, keys, False)):
                    many = len(where)
                    yield _looked_up(pa.array(rows[where]), pa.nulls(many, pa.int64()), pa.nulls(many, pa.int64()),
                                     pa.nulls(many, pa.float64()), pa.nulls(many, pa.float64()), pa.array(np.full(many, is_word)),
                                     pa.array(key[where].view(np.int64)), pa.array(goes_on[where]))
    return fn


def _looked_up(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=["row", "doc_id", "n", "lt", "lb", "is_word", "key", "before"])


def _whole(src: DataFrame, scratch: Scratch) -> DataFrame:
    spark = src.sparkSession
    src = src.withColumn("row", F.xxhash64("doc_id", "text"))  # equal rows have equal losses
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    counts = None
    for turn in range(COUNT_TURNS):
        part = scratch.write(src.select("doc_id", "text", "is_target")
                             .mapInArrow(_count(size // BUCKET + 8, turn), "bucket long, h binary, w binary, t binary, b binary")
                             .groupBy("bucket").applyInArrow(_unpacked, "h long, w long, t long, b long"))
        counts = part if counts is None else counts.unionByName(part)
    own, pairs = counts.filter(F.col("h") == WORD_KEY).select("w", "t", "b"), counts.filter(F.col("h") != WORD_KEY)
    total = own.filter(F.col("w") != START).agg(F.count("*").alias("n"), F.sum("t").alias("t"), F.sum("b").alias("b")).first()
    size = total["n"] + 2  # the unknown word and the start mark have a share too
    listed = pairs.groupBy("h").agg(F.sum("t").alias("t_listed"), F.sum("b").alias("b_listed"))
    words = own.mapInArrow(_keyed, "w long, t long, b long, h long").join(listed, "h", "left")
    for k in ("t", "b"):
        words = (words.withColumn(f"before_{k}", F.greatest(F.col(k).cast("double"), F.lit(1e-9)))
                 .withColumn(f"rest_{k}", 1 - WEIGHT * F.least(F.coalesce(f"{k}_listed", F.lit(0)) / F.col(f"before_{k}"), F.lit(1.0)))
                 .withColumn(f"share_{k}", (F.col(k) + 1) / F.lit(float((total[k] or 0) + size))))
    words = scratch.write(words.drop("t_listed", "b_listed"))
    listed = (pairs.join(words.select("h", "before_t", "before_b", "rest_t", "rest_b"), "h")
              .join(words.select("w", "share_t", "share_b"), "w"))
    gain = {k: -F.log1p(WEIGHT * F.col(k) / F.col(f"before_{k}") / (F.col(f"rest_{k}") * F.col(f"share_{k}"))) for k in ("t", "b")}
    nothing = F.lit(0.0)
    pairs = scratch.write(listed.select(F.col("h").bitwiseXOR(F.col("w")).alias("key"), "t", "b", gain["t"].alias("wt"),
                                        gain["b"].alias("wb"), nothing.alias("ht"), nothing.alias("hb")))
    begin = words.filter(F.col("w") == START).select(-F.log("rest_t"), -F.log("rest_b")).first()
    words = words.filter(F.col("w") != START).select(
        F.col("w").alias("key"), "t", "b", *((-F.log(f"{name}_{k}")).alias(f"{short}{k}")
                                             for short, name in (("w", "share"), ("h", "rest")) for k in ("t", "b")))
    held, others, sieve = [], [], None
    for costs, most, is_word in ((words, HELD_WORDS, True), (pairs, HELD_PAIRS, False)):
        cut, left = _cut_off(costs, most)
        above = F.lit(False) if cut is None else _step() >= cut
        used = ("wt", "wb", "ht", "hb") if is_word else ("wt", "wb")
        held.append(costs.filter(above).select("key", *used).toArrow().to_pandas())  # at most ``most`` rows
        if left:
            others.append(costs.filter(~above).drop("t", "b").withColumn("is_word", F.lit(is_word)))
            sieve = sieve if is_word else _sieve(others[-1], left)
    shared = spark.sparkContext.broadcast(Costs(*held, tuple(begin or (0.0, 0.0)), sieve))
    out = None
    for turn in range(SCORE_TURNS if others else 1):
        part = src.filter(F.pmod("row", F.lit(SCORE_TURNS)) == turn) if others else src
        part = scratch.write(_scored(part, shared, others))
        out = part if out is None else out.unionByName(part)
    return scratch.finish(out)


def _scored(src: DataFrame, shared, others: list) -> DataFrame:
    sums = src.select("doc_id", "text", "row").mapInArrow(_losses(shared, not others), LOOKED_UP)
    if others:
        table = others[0] if len(others) == 1 else others[0].unionByName(others[1])
        cost = {k: F.coalesce(f"l{k}", F.col(f"w{k}") + F.when(F.col("before"), F.col(f"h{k}")).otherwise(0.0), F.lit(0.0))
                for k in ("t", "b")}
        # The key first: a sort by it is settled by the key's eight bytes alone.
        sums = (sums.join(table, ["key", "is_word"], "left")
                .select("row", "doc_id", "n", cost["t"].alias("lt"), cost["b"].alias("lb")).groupBy("row")
                .agg(F.max("doc_id").alias("doc_id"), F.max("n").alias("n"), F.sum("lt").alias("lt"), F.sum("lb").alias("lb"),
                     F.count("n").alias("same"))
                .select("doc_id", "n", (F.col("lt") / F.col("same")).alias("lt"), (F.col("lb") / F.col("same")).alias("lb"),
                        F.explode(F.sequence(F.lit(1).cast("long"), F.col("same")))))
    mean = [F.col(k) / F.greatest("n", F.lit(1)) for k in ("lt", "lb")]
    return sums.select("doc_id", F.col("n").alias("n_tokens"), mean[0].alias("target_loss"),
                       mean[1].alias("background_loss"), (mean[0] - mean[1]).alias("score"))


def cross_entropy_difference(docs: DataFrame, target_col: str, id_col: str = "doc_id", text_col: str = "text",
                             vocabulary: int | None = None, bigrams: int | None = None) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) for every row;
    ``target_col`` marks target documents (null: not). ``vocabulary`` and
    ``bigrams``, given together, limit the model."""
    if (vocabulary is None) != (bigrams is None):
        raise ValueError("give both vocabulary and bigrams, or neither")
    spark = docs.sparkSession
    scratch = Scratch(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                      F.coalesce(F.col(target_col), F.lit(False)).alias("is_target"))
    if vocabulary is None:
        return _whole(src, scratch)
    counted = "k long, t long, b long"
    both = (F.sum("t").alias("t"), F.sum("b").alias("b"))
    words = scratch.write(src.mapInArrow(_count_words, counted).groupBy("k").agg(*both))
    totals = words.agg(*both).first()
    totals = (float(totals["t"] or 0), float(totals["b"] or 0))
    top = _largest(words, vocabulary).toArrow().to_pandas()  # at most ``vocabulary`` rows
    hashes = top["k"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    shared = spark.sparkContext.broadcast(hashes[order])

    size = len(hashes) + 2
    pairs = src.mapInArrow(_count_bigrams(shared), counted).groupBy("k").agg(*both)
    pairs = scratch.write(pairs.withColumn("seen", F.col("t") + F.col("b")).filter("seen >= 2").select("k", "t", "b"))
    listed = _largest(pairs, bigrams).toArrow().to_pandas().sort_values("k")  # at most ``bigrams`` rows
    before = np.zeros((2, size))
    for kind, name in enumerate(("t", "b")):  # how often each word is a history
        before[kind, :-2] = top[name].to_numpy(np.float64)[order]
        before[kind, -2] = totals[kind] - before[kind].sum()
    starts = src.filter(F.length(F.btrim("text", F.lit(" \t\n\x0b\x0c\r"))) > 0).groupBy("is_target").agg(F.count("*").alias("n"))
    for r in starts.collect():  # two rows
        before[0 if r["is_target"] else 1, -1] = r["n"]
    models = Models(hashes[order], [top[k].to_numpy(np.float64)[order] for k in ("t", "b")], totals,
                    listed["k"].to_numpy(np.int64), [listed[k].to_numpy(np.float64) for k in ("t", "b")], before)
    return scratch.finish(src.select("doc_id", "text").mapInArrow(
        _score(spark.sparkContext.broadcast(models)),
        "doc_id long, n_tokens long, target_loss double, background_loss double, score double"))
