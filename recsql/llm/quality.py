"""Quality classifier: random-indexing word vectors, pooled per document, and a
two-layer network with temperature-calibrated probabilities.

* Tokens are runs of one byte class (lower-case or multi-byte letters, upper
  case, digits, one repeated symbol, line feed), hashed into ``BUCKETS`` words.
* Random indexing: every word has a fixed sparse random index vector; its word
  vector is the sum of the index vectors of its neighbours, two to either side,
  over all documents. Tasks add up their own fixed-size integer table, so the
  sum over all text moves at most ``BUCKETS`` rows per task and is exact.
* Pooling: mean and spread over tokens, mean over distinct words, the share of
  distinct words, of words equal to the one before, and the log length.
* The network learns from a bounded sample of labelled rows (``sample_rows``,
  chosen by a hash of the id). Calibration fits one temperature on a fifth of
  the sample that the network does not see.

The fit uses labels only through ``labels``; callers leave held-out rows out.

Defined results: null and empty texts pool to zeros and still get a score;
repeated rows get one score each; with no labels, or labels of one kind, every
score is the share of label 1 (0.5 without labels); a document with several
label rows counts once with their mean rounded; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .words import mix, powers, string_buffers

BUCKETS = 1 << 14
DIMS = 32
SPREAD = 2  # non-zero entries of an index vector
WINDOW = 2
FEATURES = 3 * DIMS + 3
_U = np.uint64
_RESERVED = 512
_LETTER, _UPPER, _DIGIT, _SPACE = 1, 2, 3, 0


def _byte_classes() -> np.ndarray:
    kind = np.arange(256) + 8  # every other byte is a class of its own
    kind[ord("a"):ord("z") + 1] = _LETTER
    kind[128:] = _LETTER
    kind[ord("A"):ord("Z") + 1] = _UPPER
    kind[ord("0"):ord("9") + 1] = _DIGIT
    kind[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = _SPACE
    return kind.astype(np.int16)


_KIND = _byte_classes()
_COEF = mix(np.arange(1001, 1257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


def _runs(col: pa.Array):
    """(bucket of every token, first token of every row) of a string column."""
    data, offsets = string_buffers(col)
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    kind = _KIND[data]
    new = np.ones(len(data), dtype=bool)
    new[1:] = kind[1:] != kind[:-1]
    inner = offsets[:-1]
    new[inner[inner < len(data)]] = True
    start = np.flatnonzero(new)
    length = np.diff(np.append(start, len(data)))
    k = kind[start]
    keep = k != _SPACE
    start, length, k = start[keep], length[keep], k[keep]
    bucket = np.empty(len(start), dtype=np.int32)
    letters = k == _LETTER
    bucket[letters] = _letter_buckets(data, start[letters], length[letters])
    upper = k == _UPPER
    bucket[upper] = np.minimum(length[upper], 3)
    bucket[k == _DIGIT] = 4
    symbol = k >= 8
    bucket[symbol] = 8 + (k[symbol] - 8) + 128 * np.minimum(length[symbol] - 1, 2)
    return bucket, np.searchsorted(start, offsets, side="left")


def _letter_buckets(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    p, q = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_COEF[data] * p[:len(data)], out=total[1:])
        h = mix((total[start + length] - total[start]) * q[start] + length.astype(np.uint64))
    return (_RESERVED + h % _U(BUCKETS - _RESERVED)).astype(np.int32)


def _slices(batch: pa.RecordBatch, limit: int = 1 << 21):
    """Row ranges of about ``limit`` bytes of text (one row at least)."""
    _, offsets = string_buffers(batch.column(1))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, min(to, batch.num_rows)
        at = min(to, batch.num_rows)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the non-zero entries of every word's index vector."""
    h = mix(np.arange(BUCKETS * SPREAD, dtype=np.uint64) + _U(77)).reshape(BUCKETS, SPREAD)
    return (h % _U(DIMS)).astype(np.int64), (((h >> _U(40)) & _U(1)).astype(np.float64) * 2 - 1)


def _contexts():
    def fn(batches):
        table = np.zeros(BUCKETS * DIMS)
        place, sign = index_vectors()
        for batch in batches:
            for lo, hi in _slices(batch):
                tokens, first = _runs(batch.column(1).slice(lo, hi - lo))
                row = np.repeat(np.arange(hi - lo), np.diff(first))
                for d in range(1, WINDOW + 1):
                    same = row[:-d] == row[d:]
                    a, b = tokens[:-d][same].astype(np.int64), tokens[d:][same].astype(np.int64)
                    for x, y in ((a, b), (b, a)):
                        for s in range(SPREAD):
                            table += np.bincount(x * DIMS + place[y, s], weights=sign[y, s], minlength=BUCKETS * DIMS)
        table = table.astype(np.int64).reshape(BUCKETS, DIMS)
        seen = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64())] + [pa.array(table[seen, d]) for d in range(DIMS)],
                                         names=["word"] + [f"d{d}" for d in range(DIMS)])
    return fn


def word_vectors(docs: DataFrame) -> np.ndarray:
    """BUCKETS x DIMS unit vectors from all texts (columns doc_id, text)."""
    schema = "word long, " + ", ".join(f"d{d} long" for d in range(DIMS))
    summed = docs.mapInArrow(_contexts(), schema).groupBy("word").agg(*[F.sum(f"d{d}").alias(f"d{d}") for d in range(DIMS)])
    out = np.zeros((BUCKETS, DIMS))
    for r in summed.toLocalIterator():  # at most BUCKETS rows
        out[r["word"]] = r[1:]
    out = np.sign(out) * np.log1p(np.abs(out))
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(norm > 0, norm, 1.0)).astype(np.float32)


def pool(tokens: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Document vector of a token sequence."""
    out = np.zeros(FEATURES, dtype=np.float32)
    if len(tokens):
        words, counts = np.unique(tokens, return_counts=True)
        v, w = vectors[words], (counts / len(tokens)).astype(np.float32)
        mean = w @ v
        out[:DIMS] = mean
        out[DIMS:2 * DIMS] = np.sqrt(np.maximum(w @ (v * v) - mean * mean, 0))
        out[2 * DIMS:3 * DIMS] = v.mean(axis=0)
        out[-3:] = (np.log1p(len(tokens)), len(words) / len(tokens), _echo(tokens))
    return out


def _echo(tokens: np.ndarray) -> float:
    """Share of tokens equal to the token one, two or three places before."""
    same = [np.count_nonzero(tokens[d:] == tokens[:-d]) / (len(tokens) - d) for d in (1, 2, 3) if len(tokens) > d]
    return float(max(same, default=0.0))


def _pooled(shared):
    def fn(batches):
        vectors = shared.value
        for batch in batches:
            for lo, hi in _slices(batch):
                tokens, first = _runs(batch.column(1).slice(lo, hi - lo))
                rows = [pool(tokens[first[r]:first[r + 1]], vectors).tobytes() for r in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(rows, pa.binary())],
                                                 names=["doc_id", "vec"])
    return fn


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


class Network:
    """Two layers (tanh, logistic) on standardised inputs, with a temperature."""

    def __init__(self, hidden: int = 24, epochs: int = 120, rate: float = 0.01, decay: float = 1e-4, seed: int = 5):
        self.hidden, self.epochs, self.rate, self.decay, self.seed = hidden, epochs, rate, decay, seed
        self.constant: float | None = None
        self.temperature = 1.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Network:
        if len(y) < 10 or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return self
        rng = np.random.default_rng(self.seed)
        order = rng.permutation(len(y))
        check, train = order[:len(y) // 5], order[len(y) // 5:]
        self.mean, self.scale = x[train].mean(axis=0), x[train].std(axis=0) + 1e-3
        self.w = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], self.hidden)), np.zeros(self.hidden),
                  rng.normal(0, 1 / np.sqrt(self.hidden), self.hidden), np.zeros(1)]
        moment, square, step = [0 * p for p in self.w], [0 * p for p in self.w], 0
        z = (x - self.mean) / self.scale
        for _ in range(self.epochs):
            rng.shuffle(train)
            for at in range(0, len(train), 256):
                i = train[at:at + 256]
                h = np.tanh(z[i] @ self.w[0] + self.w[1])
                err = (_sigmoid(h @ self.w[2] + self.w[3]) - y[i]) / len(i)
                back = np.outer(err, self.w[2]) * (1 - h * h)
                grad = [z[i].T @ back, back.sum(axis=0), h.T @ err, err.sum(keepdims=True)]
                step += 1
                for k, g in enumerate(grad):
                    g = g + self.decay * self.w[k]
                    moment[k] = 0.9 * moment[k] + 0.1 * g
                    square[k] = 0.999 * square[k] + 0.001 * g * g
                    self.w[k] -= self.rate * (moment[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)
        logits, truth = self._logits(x[check]), y[check]
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 81))
        loss = [-np.mean(np.where(truth == 1, np.log(_sigmoid(logits / t) + 1e-12), np.log(1 - _sigmoid(logits / t) + 1e-12)))
                for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])
        return self

    def _logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return _sigmoid(self._logits(x) / self.temperature)


def _scored(shared):
    def fn(batches):
        net = shared.value
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float32).reshape(-1, FEATURES).astype(np.float64)
            score = np.round(net.score(x), 12)  # a product's last bits depend on a row's place in its batch
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])
    return fn


def training_sample(labels: DataFrame, label_col: str, rows: int) -> DataFrame:
    """(doc_id, y) of about ``rows`` labelled documents, chosen by a hash of the
    id; all of them when there are no more."""
    one = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y"))
           .filter("doc_id is not null and y is not null").groupBy("doc_id").agg(F.round(F.avg("y")).cast("int").alias("y")))
    have = one.count()
    if have <= rows:
        return one
    part = int((1 << 31) * (rows / have))
    return one.filter(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 31)) < part)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", sample_rows: int = 20_000) -> DataFrame:
    """(doc_id, score) for every row: calibrated probability of label 1.
    ``labels`` (doc_id, label) holds the rows to learn from."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    vectors = spark.sparkContext.broadcast(word_vectors(src))  # fixed size
    pooled = scratch.write(src.mapInArrow(_pooled(vectors), "doc_id long, vec binary"))
    sample = F.broadcast(training_sample(labels, label_col, sample_rows))  # about sample_rows at most
    fit = (pooled.join(sample, "doc_id").groupBy("doc_id").agg(F.min("vec").alias("vec"), F.min("y").alias("y"))
           .toArrow().to_pandas().sort_values("doc_id"))
    x = np.frombuffer(b"".join(fit["vec"]), np.float32).reshape(-1, FEATURES).astype(np.float64)
    net = Network().fit(x, fit["y"].to_numpy(np.float64))
    return scratch.finish(pooled.mapInArrow(_scored(spark.sparkContext.broadcast(net)), "doc_id long, score double"))
