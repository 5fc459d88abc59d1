"""Cost-balanced packing of documents into fixed-length training sequences.

Attention over a piece of ``n`` tokens costs ``linear * n + quadratic * n * n``.
Within a packing group, documents are taken in descending length and each goes
to the lowest-cost sequence with enough remaining capacity. Documents longer
than a sequence give up whole sequences first. When no open sequence has room
for a whole piece, the piece is cut at a multiple of ``GRAIN`` tokens and fills
the lowest-cost sequence with room, so padding stays below one grain per
sequence, plus less than one sequence per group.

Only token counts and checksums move between tasks, never ids: the tokenising
task keeps the running CRC-32 of a document at every grain, and the checksum
of any piece follows from two of them, because CRC-32 is linear over GF(2).

Groups are formed from row numbers frozen in a written table, so repeated ids
and hot keys spread evenly and a retried task sees the same group. A group
holds about ``group_tokens`` tokens at any input size.

Defined results: a null text is empty; an empty text is the closing id alone;
repeated rows are packed once each; an empty table gives no pieces; columns
other than the id and the text are ignored."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .wordpiece_ids import encoder

GRAIN = 16
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
_COUNTED = "doc_id long, doc_tokens long, grain_crc binary"


def _default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _grain_crcs(ids: bytes) -> bytes:
    """Running CRC-32 after each GRAIN ids, then after all of them."""
    step, crc, out = 4 * GRAIN, 0, []
    for at in range(0, len(ids), step):
        crc = zlib.crc32(ids[at:at + step], crc)
        out.append(crc)
    return np.asarray(out, dtype="<u4").tobytes()


def _count(vocabulary: str, end_id: int):
    end = int(end_id).to_bytes(4, "little")

    def fn(batches):
        enc = encoder(vocabulary)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 256):
                part = [t or "" for t in texts.slice(at, 256).to_pylist()]
                counts, crcs = [], []
                for raw in enc(part):
                    raw += end
                    counts.append(len(raw) // 4)
                    crcs.append(_grain_crcs(raw))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, 256).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(crcs, pa.binary())],
                    names=["doc_id", "doc_tokens", "grain_crc"])
    return fn


_ZERO_BYTES: list[list[int]] = []


def _zero_operators() -> list[list[int]]:
    """GF(2) matrices that advance a CRC-32 over 2^k zero bytes."""
    if not _ZERO_BYTES:
        poly = 0xEDB88320

        def one_byte(x: int) -> int:
            for _ in range(8):
                x = (x >> 1) ^ (poly if x & 1 else 0)
            return x

        op = [one_byte(1 << k) for k in range(32)]
        for _ in range(48):
            _ZERO_BYTES.append(op)
            op = [_apply(op, column) for column in op]
    return _ZERO_BYTES


def _apply(op: list[int], x: int) -> int:
    out, k = 0, 0
    while x:
        if x & 1:
            out ^= op[k]
        x >>= 1
        k += 1
    return out


def crc_between(before: int, upto: int, n_bytes: int) -> int:
    """CRC-32 of the last ``n_bytes`` of a string from the CRC of all of it and
    of what precedes them."""
    k = 0
    while n_bytes and before:
        if n_bytes & 1:
            before = _apply(_zero_operators()[k], before)
        n_bytes >>= 1
        k += 1
    return before ^ upto


def balance(lengths: np.ndarray, capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int]]:
    """(document, start, length, sequence) of every piece; ``lengths`` in the
    order given break ties."""
    out: list[tuple[int, int, int, int]] = []
    sequences = 0
    rest = np.empty(len(lengths), dtype=np.int64)
    for d, n in enumerate(lengths.tolist()):
        whole = n // capacity
        for k in range(whole):
            out.append((d, k * capacity, capacity, sequences))
            sequences += 1
        rest[d] = n - whole * capacity
    first = sequences
    n_open = int(-(-int(rest.sum()) // capacity))
    room = np.full(n_open, capacity, dtype=np.int64)
    cost = np.zeros(n_open)
    for d in np.argsort(-rest, kind="stable").tolist():
        left = int(rest[d])
        start = int(lengths[d]) - left
        while left:
            fits = room >= left
            take = left
            if not fits.any():
                fits = room >= GRAIN
                take = 0
            if not fits.any():  # grains lost at earlier cuts: one more sequence
                room, cost = np.append(room, capacity), np.append(cost, 0.0)
                continue
            s = int(np.argmin(np.where(fits, cost, np.inf)))
            take = take or int(room[s]) // GRAIN * GRAIN
            out.append((d, start, take, first + s))
            room[s] -= take
            cost[s] += linear * take + quadratic * take * take
            start += take
            left -= take
    return out


def _pack(capacity: int, linear: float, quadratic: float):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_tokens", "row"], ascending=[False, True], ignore_index=True)
        group, total = int(pdf["grp"].iloc[0]), pdf["doc_tokens"].to_numpy(np.int64)
        crcs = [np.frombuffer(b, dtype="<u4") for b in pdf["grain_crc"]]
        filled: dict[int, int] = {}
        rows = []
        for d, start, length, seq in balance(total, capacity, linear, quadratic):
            stop = start + length
            upto = int(crcs[d][-1] if stop == total[d] else crcs[d][stop // GRAIN - 1])
            before = int(crcs[d][start // GRAIN - 1]) if start else 0
            at = filled.get(seq, 0)
            filled[seq] = at + length
            rows.append((d, start, length, crc_between(before, upto, 4 * length) if start else upto,
                         (group << 32) | seq, at))
        d, start, length, crc, seq, at = (np.asarray(x, dtype=np.int64) for x in zip(*rows, strict=True))
        return pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy()[d], "start": start, "length": length, "ids_crc32": crc,
                             "doc_tokens": total[d], "sequence_id": seq, "offset": at})
    return fn


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096,
                   vocabulary: str | None = None, end_id: int = 2, linear: float = 1.0,
                   quadratic: float = 1.0 / 1024, group_tokens: int = 2_000_000) -> DataFrame:
    """One row per piece: document, start and length in its ids, checksum, the
    document's token count, sequence and offset there."""
    if capacity % GRAIN:
        raise ValueError(f"capacity must be a multiple of {GRAIN}")
    spark = docs.sparkSession
    scratch = Scratch(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counted = scratch.write(src.mapInArrow(_count(vocabulary or _default_vocabulary(), end_id), _COUNTED)
                            .withColumn("row", F.monotonically_increasing_id()))
    tokens = counted.agg(F.sum("doc_tokens").alias("n")).first()["n"] or 0
    groups = max(1, -(-int(tokens) // int(group_tokens)))
    pieces = (counted.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups)))
              .groupBy("grp").applyInPandas(_pack(capacity, linear, quadratic), PIECES))
    return scratch.finish(pieces)
