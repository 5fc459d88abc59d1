"""Toxicity by compression distance.

Two zstandard dictionaries are trained. The ordinary one is trained on windows
of ordinary text. The toxic one holds the same content behind a second
dictionary, trained on those words that are clearly more frequent in toxic
windows than in ordinary ones, so their difference is what toxic wording saves. A text is cut into windows of ``WINDOW_WORDS``
words; each is compressed under both, and the saved bytes of its windows
(largest, second, third, hits over fixed thresholds, number of windows) are
calibrated into a probability by a logistic fit on labelled documents that the
dictionaries did not see.

The fit uses a bounded sample: at most about ``sample_rows`` labelled documents
and ``train_windows`` windows of each kind. Dictionaries of either half of the
sample measure the other half for the calibration; the dictionaries that score
come from both halves. Dictionaries have fixed sizes (``BASE_BYTES``,
``TOXIC_BYTES``): of the toxic wording at most 64 samples a word are trained on,
and as much of it as fits half of ``TOXIC_BYTES`` is also kept in plain, the
most frequent last. Scoring compresses every window of every text.

Defined results: null and empty texts have no window and score as such; a
single very long word is one window; repeated rows get one score each; without
labels of both kinds every score is the share of label 1 (0.5 without labels);
other columns are ignored."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

WINDOW_WORDS = 10
BASE_BYTES, TOXIC_BYTES = 16_384, 8_192
THRESHOLDS = (1, 2, 3, 4, 6)
NEIGHBOURS = 4
# As frequent in toxic windows as in ordinary ones. Of 5, 10, 20, 40 and 80 the
# one of least log loss over four folds of the learning rows (README).
TIMES = 40
SHORTEST = 4  # characters of a word's beginning that can count as wording
FEATURES = 3 + 2 * len(THRESHOLDS) + 1


_WORD = re.compile(r"[^\W\d_]+")


def windows(text: str | None) -> list[bytes]:
    words = (text or "").lower().split()
    return [f" {' '.join(words[i:i + WINDOW_WORDS])} ".encode() for i in range(0, len(words), WINDOW_WORDS)]


def _trained(samples: list[bytes], size: int) -> bytes:
    """Content of a trained dictionary; too few samples are used as they are."""
    import zstandard as zstd
    try:
        return zstd.train_dictionary(size, samples).as_bytes()
    except zstd.ZstdError:
        return b" ".join(dict.fromkeys(samples))[-size:]


def _letters(window: bytes) -> list[str]:
    return _WORD.findall(window.decode())


def _beginnings(word: str):
    return (word[:n] for n in range(min(SHORTEST, len(word)), len(word) + 1))


def train_dictionaries(ordinary: list[bytes], toxic: list[bytes]) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionary contents. Toxic wording is what begins words
    of toxic windows after ``NEIGHBOURS`` different words or more, so a passage
    copied between toxic texts does not count, and begins words in a share of
    toxic windows (smoothed) of at least ``TIMES`` that of ordinary windows; of
    a word, its longest such part. The calibration weighs what it saves."""
    before: dict[str, set] = defaultdict(set)
    words: dict[str, int] = defaultdict(int)
    found: dict[str, list[int]] = {}
    for win in toxic:
        last, here = "", set()
        for w in _letters(win):
            words[w] += 1
            for b in _beginnings(w):
                before[b].add(last)
                here.add(b)
            last = w
        for b in here:
            found.setdefault(b, [0, 0])[0] += 1
    for win in ordinary:
        for b in {b for w in _letters(win) for b in _beginnings(w)}:
            if b in found:
                found[b][1] += 1
    scale = TIMES * (len(toxic) + 1) / (len(ordinary) + 1)
    enough = {b for b, (t, o) in found.items() if len(before[b]) >= NEIGHBOURS and t + 0.5 >= scale * (o + 0.5)}
    wording: dict[str, int] = defaultdict(int)
    for w, n in words.items():
        best = max((b for b in _beginnings(w) if b in enough), key=len, default=None)
        if best:
            wording[best] += n
    samples = [b" " + w.encode() for w, n in sorted(wording.items(), key=lambda x: (x[1], x[0])) for _ in range(min(n, 64))]
    base = _trained(ordinary, BASE_BYTES)
    plain = b"".join(dict.fromkeys(w + b" " for w in samples))[-TOXIC_BYTES // 2:]  # the most frequent wording, whole words, last
    return base, _trained(samples, TOXIC_BYTES // 2) + plain + base


class Distance:
    """Saved bytes per window under the toxic dictionary."""

    def __init__(self, base: bytes, toxic: bytes):
        import zstandard as zstd
        # The same table sizes and search for both, whatever their lengths.
        params = zstd.ZstdCompressionParameters(
            window_log=16, hash_log=15, chain_log=15, search_log=4, min_match=4, strategy=zstd.STRATEGY_LAZY2,
            write_checksum=False, write_content_size=False, write_dict_id=False)
        self.compress = []
        for content in (base, toxic):
            d = zstd.ZstdCompressionDict(content.rjust(BASE_BYTES + TOXIC_BYTES), dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            self.compress.append(zstd.ZstdCompressor(compression_params=params, dict_data=d).compress)

    def features(self, text: str | None) -> np.ndarray:
        base, toxic = self.compress
        saved = np.asarray([len(base(w)) - len(toxic(w)) for w in windows(text)], dtype=np.float64)
        out = np.zeros(FEATURES)
        top = np.sort(saved)[::-1][:3]
        out[:len(top)] = np.clip(top, -4, 24)
        for k, t in enumerate(THRESHOLDS):
            hits = np.count_nonzero(saved >= t)
            out[3 + k] = np.log1p(hits)
            out[3 + len(THRESHOLDS) + k] = hits / max(1, len(saved))
        out[-1] = np.log1p(len(saved))
        return out


def _features(shared):
    def fn(batches):
        distance = Distance(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = [distance.features(t).tobytes() for t in batch.column(1).slice(at, 64).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 64), pa.array(rows, pa.binary())],
                                                 names=["doc_id", "vec"])
    return fn


def _cut(batches):
    for batch in batches:
        for r in range(batch.num_rows):
            wins = windows(batch.column(1)[r].as_py())
            same = [pa.array([batch.column(k)[r].as_py()] * len(wins), t) for k, t in
                    ((0, pa.int64()), (2, pa.int32()), (3, pa.int32()))]
            yield pa.RecordBatch.from_arrays([*same, pa.array(range(len(wins)), pa.int64()), pa.array(wins, pa.binary())],
                                             names=["doc_id", "y", "half", "place", "win"])


class Calibration:
    """Logistic fit by Newton steps with a small ridge; ``weight`` restores the
    shares of the two kinds."""

    def __init__(self, constant: float | None = None):
        self.constant = constant

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Calibration:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        ridge = np.append(np.full(x.shape[1], 0.5), 1e-6)
        self.w = np.zeros(z.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            grad = z.T @ (weight * (p - y)) + ridge * self.w
            hess = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(ridge)
            step = np.linalg.solve(hess, grad)
            self.w -= np.clip(step, -4, 4)
            if np.abs(step).max() < 1e-8:
                break
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        return 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))


def _scored(dictionaries, calibration):
    def fn(batches):
        fit = calibration.value
        for batch in _features(dictionaries)(batches):
            x = np.frombuffer(b"".join(batch.column(1).to_pylist())).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fit.score(x))], names=["doc_id", "score"])
    return fn


def _dictionaries(spark, drawn: dict[int, list], halves: set[int]):
    return spark.sparkContext.broadcast(train_dictionaries(
        *([w for h, _, w in drawn[y] if h in halves] for y in (0, 1))))


def fit_toxicity(src: DataFrame, labels: DataFrame, scratch: Scratch, label_col: str = "toxic",
                 sample_rows: int = 6_000, train_windows: int = 100_000):
    """(dictionaries, calibration) learned from the rows of ``src`` (doc_id,
    text) that ``labels`` names; without labels of both kinds the dictionaries
    are None and the calibration is constant."""
    spark = src.sparkSession
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y"))
             .filter("doc_id is not null and y is not null").groupBy("doc_id").agg(F.round(F.avg("y")).cast("int").alias("y")))
    have = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows
    if not have.get(0) or not have.get(1):
        share = have.get(1, 0) / max(1, sum(have.values())) if have else 0.5
        return None, Calibration(float(share))
    turn = F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1 << 31))
    part = F.when(F.col("y") == 1, F.lit(sample_rows / have[1])).otherwise(F.lit(sample_rows / have[0])) * (1 << 31)
    sample = (known.filter(turn < part)
              .withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(2)).cast("int")))
    texts = scratch.write(src.join(F.broadcast(sample), "doc_id"))  # about 2 * sample_rows ids at most
    wins = scratch.write(texts.select("doc_id", "text", "y", "half")
                         .mapInArrow(_cut, "doc_id long, y int, half int, place long, win binary"))
    count = {r["y"]: r["n"] for r in wins.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows
    draw = F.pmod(F.xxhash64("doc_id", "place", F.lit(31)), F.lit(1 << 31))
    drawn = {y: sorted((r["half"], r["doc_id"], bytes(r["win"])) for r in wins.filter(
        (F.col("y") == y) & (draw < int((1 << 31) * min(1.0, train_windows / max(1, count.get(y, 0)))))).collect())
        for y in (0, 1)}  # about train_windows each at most
    measured = []
    for half in (0, 1):
        seen = _dictionaries(spark, drawn, {1 - half})
        measured.append(texts.filter(F.col("half") == half).select("doc_id", "text")
                        .mapInArrow(_features(seen), "doc_id long, vec binary")
                        .join(F.broadcast(sample), "doc_id").toArrow().to_pandas())  # about sample_rows rows
    fit = pd.concat(measured).sort_values(["doc_id", "vec"])
    x = np.frombuffer(b"".join(fit["vec"])).reshape(-1, FEATURES)
    y = fit["y"].to_numpy(np.float64)
    weight = np.where(y == 1, max(1.0, have[1] / sample_rows), max(1.0, have[0] / sample_rows))
    if len(y) and 0 < y.mean() < 1:
        calibration = Calibration().fit(x, y, weight / weight.mean())
    else:
        calibration = Calibration(have[1] / (have[0] + have[1]))
    return _dictionaries(spark, drawn, {0, 1}), calibration


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **fit) -> DataFrame:
    """(doc_id, score) for every row: calibrated probability of label 1.
    ``labels`` (doc_id, label) holds the rows to learn from; a row without an
    id is scored and never learned from. ``fit``: parameters of ``fit_toxicity``."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    dictionaries, calibration = fit_toxicity(src, labels, scratch, **fit)
    if dictionaries is None:
        return src.select("doc_id", F.lit(calibration.constant).alias("score"))
    return scratch.finish(src.mapInArrow(_scored(dictionaries, spark.sparkContext.broadcast(calibration)),
                                         "doc_id long, score double"))
