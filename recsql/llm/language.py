"""Language identification by language-bitmask n-gram filters.

* Learning. Character n-grams (lengths ``LENGTHS``, letters in lower case, one
  gap allowed at either end) of all training texts are counted per language.
  A language holds an n-gram that makes up at least ``min_share`` of its
  n-grams and occurs there at least ``1 / RATIO`` as often as in the language
  that has it most. So a language holds at most ``1 / min_share`` n-grams,
  whatever the corpus.
* Filter. A bit-sliced Bloom filter: ``slots`` rows of one bit per language;
  an n-gram sets its languages' bits in ``HASHES`` rows, and the AND of these
  rows returns all languages that contain it. Its size is fixed by ``slots``
  and the number of languages.
* Decision. Per text and language the set bits over all its n-grams are
  counted. With fill f of a language's column, ``f ** HASHES`` of foreign
  n-grams hit by chance; the count is corrected by that, and the largest
  corrected count decides, of equal ones the language with more training rows.

Defined results: a null text, or one without a letter, is ``und`` with score
0; a text none of whose n-grams is held gets the most frequent training
language; without training rows every text is ``und``. The score is the
winner's part of all corrected counts. Training rows without language or text
teach nothing; repeated rows keep one output row each; other columns are
ignored. Whole texts are read, long ones in overlapping chunks."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .words import mix

LENGTHS = (3, 4, 5)
HASHES = 2
RATIO = 16
UNKNOWN = "und"
_CHUNK = 1 << 19
_U = np.uint64
_STEP = mix(np.arange(11, 11 + max(LENGTHS), dtype=np.uint64)) | _U(1)


@cache
def _letters() -> np.ndarray:
    """Per code point its lower-case letter, 0 for what is no letter."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def _pieces(texts: list):
    """(rows, first codes of the rows' pieces, codes) in chunks: each text with
    a gap before and behind, long ones cut with an overlap so that every
    n-gram starts in one piece; ``own`` counts the codes that start n-grams."""
    reach = max(LENGTHS) - 1
    rows, parts, own, size = [], [], [], 0
    for r, t in enumerate(texts):
        if not t:
            continue
        for at in range(0, len(t), _CHUNK):
            end = min(len(t), at + _CHUNK)
            part = (" " if at == 0 else "") + t[at:end + reach] + (" " if end + reach >= len(t) else "")
            rows.append(r)
            parts.append(part)
            own.append(end - at + (at == 0))
            size += len(part)
            if size >= _CHUNK:
                yield rows, parts, own
                rows, parts, own, size = [], [], [], 0
    if rows:
        yield rows, parts, own


def ngrams(texts: list):
    """(n-gram hashes, row of each) of texts, a bounded chunk at a time."""
    for rows, parts, own in _pieces(texts):
        code = _letters()[np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.uint64)
        length = np.array([len(p) for p in parts])
        first = np.cumsum(length) - length
        row = np.repeat(np.asarray(rows), length)
        inside = np.arange(len(code)) - np.repeat(first, length)  # position in the piece
        left = np.repeat(length, length) - inside  # codes from here to its end
        starts = inside < np.repeat(np.asarray(own), length)
        gaps = np.concatenate([[0], np.cumsum(code == 0)])
        h = np.zeros(len(code), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(max(LENGTHS)):
                if k >= len(code):
                    break
                h[:len(code) - k] += (code[k:] + _U(1)) * _STEP[k]
                n = k + 1
                if n not in LENGTHS:
                    continue
                ok = starts & (left >= n)
                at = np.flatnonzero(ok)
                at = at[gaps[at + n - 1] == gaps[at + 1]]  # only letters between the ends
                yield mix(h[at] + _U(n)), row[at]


def _counted(langs: list[str]):
    code = {x: k for k, x in enumerate(langs)}

    def fn(batches):
        for batch in batches:
            lang = np.array([code[x] for x in batch.column(1).to_pylist()], dtype=np.int64)
            for h, row in ngrams(batch.column(0).to_pylist()):
                for k in np.unique(lang[row]).tolist():
                    g, n = np.unique(h[lang[row] == k], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), k)), pa.array(g.view(np.int64)), pa.array(n, pa.int64())],
                                                     names=["lang_no", "gram", "n"])
    return fn


def _places(h: np.ndarray, slots: int) -> list[np.ndarray]:
    return [((h >> _U(32 * k)) & _U(slots - 1)).astype(np.int64) for k in range(HASHES)]


def learn_filter(train: DataFrame, text_col: str, lang_col: str, min_share: float, slots: int, scratch: Scratch):
    """(languages by number of rows, filter as a slots x bytes array)."""
    src = train.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter(
        "text is not null and lang is not null")
    langs = [r.lang for r in src.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()]
    masks = np.zeros((slots, max(1, -(-len(langs) // 8))), dtype=np.uint8)
    if not langs:
        return langs, masks
    grams = scratch.write(src.mapInArrow(_counted(langs), "lang_no long, gram long, n long")
                          .groupBy("lang_no", "gram").agg(F.sum("n").alias("n")))
    total = grams.groupBy("lang_no").agg(F.sum("n").alias("total"))
    share = (grams.join(F.broadcast(total), "lang_no")  # one row per language
             .filter((F.col("n") >= 2) & (F.col("n") >= min_share * F.col("total")))
             .select("lang_no", "gram", (F.col("n") / F.col("total")).alias("share")))
    most = share.groupBy("gram").agg(F.max("share").alias("most"))
    held = share.join(most, "gram").filter(F.col("share") * RATIO >= F.col("most")).select(
        "gram", F.shiftright("lang_no", 3).alias("byte"),
        F.call_function("shiftleft", F.lit(1), F.pmod("lang_no", F.lit(8)).cast("int")).alias("bit"))
    place = F.explode(F.array(*[F.shiftrightunsigned("gram", 32 * k).bitwiseAND(F.lit(slots - 1)) for k in range(HASHES)]))
    rows = held.select(place.alias("slot"), "byte", "bit").groupBy("slot", "byte").agg(F.bit_or("bit").alias("mask"))
    got = rows.toArrow()  # at most slots rows a byte of languages
    masks[got.column("slot").to_numpy(), got.column("byte").to_numpy()] = got.column("mask").to_numpy().astype(np.uint8)
    return langs, masks


def _identify(langs: list[str], masks, slots: int, fill: np.ndarray):
    chance = fill ** HASHES

    def fn(batches):
        table = np.frombuffer(masks.value, np.uint8).reshape(slots, -1)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows = len(texts)
            hits, total = np.zeros((rows, len(langs))), np.zeros(rows)
            for h, row in ngrams(texts):
                if not len(h):
                    continue
                one, *more = _places(h, slots)
                found = table[one]
                for p in more:
                    found &= table[p]
                total += np.bincount(row, minlength=rows)
                at = np.flatnonzero(np.diff(row, prepend=-1))  # rows come in order
                for k in range(len(langs)):
                    set_bits = (found[:, k // 8] >> np.uint8(k % 8)) & np.uint8(1)
                    hits[row[at], k] += np.add.reduceat(set_bits, at, dtype=np.int64)
            corrected = np.maximum(hits - total[:, None] * chance, 0) / np.maximum(1 - chance, 1e-9)
            known = np.array([bool(langs) and t is not None and any(map(str.isalpha, t)) for t in texts], dtype=bool)
            best = np.argmax(corrected, axis=1) if langs else np.zeros(rows, int)
            top, everything = (corrected.max(axis=1), corrected.sum(axis=1)) if langs else (np.zeros(rows), np.zeros(rows))
            score = np.where(known & (everything > 0), top / np.maximum(everything, 1e-300), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([langs[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), known.tolist(), strict=True)], pa.string()),
                 pa.array(np.minimum(score, 1.0))], names=["doc_id", "lang_pred", "score"])
    return fn


def identify_languages(docs: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       lang_col: str = "lang", min_share: float = 1e-5, slots: int = 1 << 22) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs``, learned from the
    texts and languages of ``train``. ``slots`` is a power of two."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    langs, masks = learn_filter(train, text_col, lang_col, min_share, slots, scratch)
    fill = np.array([np.count_nonzero(masks[:, k // 8] & (1 << k % 8)) / slots for k in range(len(langs))])
    shared = spark.sparkContext.broadcast(masks.tobytes())
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return scratch.finish(src.mapInArrow(_identify(langs, shared, slots, fill), "doc_id long, lang_pred string, score double"))
