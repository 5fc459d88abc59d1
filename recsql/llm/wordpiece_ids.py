"""Token ids of whole texts under a word-level BPE vocabulary file, many new
words at a time.

The public ``tokenizers`` library loads the file and encodes every text that
leaves a plain character set. For plain texts (printable ASCII, ASCII white
space, Latin-1 letters) the runs between white space are looked up in a bounded
memory of known ones; new runs are cut into the vocabulary's pre-tokens, and
new letter runs are merged together as rows of one array, by the ranks in the
same file. Both ways
give the same ids (tested), the second several times faster on text rich in
words that occur once."""

from __future__ import annotations

import json
import re
from itertools import islice

import numpy as np

KNOWN_WORDS, KEPT_WORDS = 500_000, 150_000
_PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*\Z")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")  # the file's own split pattern on plain text
_NEVER = np.int32(1 << 30)
_LONGEST = 48


def _byte_symbols() -> list[str]:
    """Printable stand-ins of the 256 bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [], 0
    for b in range(256):
        if b in shown:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


class WordIds:
    """Callable: texts -> little-endian uint32 ids as bytes."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(vocabulary)
        with open(vocabulary, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        symbols = _byte_symbols()
        self.inner = np.asarray([vocab[s] for s in symbols], np.int32)
        self.final = np.asarray([vocab[s + end] for s in symbols], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        size = self.size = max(vocab.values()) + 1
        keys = np.asarray([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
        self._hash(keys)
        self.merged = np.asarray([vocab[a + b] for a, b in pairs], np.int32)  # by rank
        single = np.concatenate([self.inner, self.final])  # ranks of all pairs of single bytes
        left, right = np.repeat(single, 512), np.tile(single, 512)
        self.byte_rank = self._ranks(left, right).reshape(512, 512)
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        pieces = [t.lower().split() if _PLAIN.match(t) and "<|" not in t else None for t in texts]
        if len(self.known) > KNOWN_WORDS:  # words met early are mostly the frequent ones
            self.known = dict(islice(self.known.items(), KEPT_WORDS))
        known = self.known
        new = set().union(*filter(None, pieces)) - known.keys()
        if new:
            self._learn(list(new))
        odd = [t for t, p in zip(texts, pieces, strict=True) if p is None]
        library = iter(self.lib.encode_batch_fast(odd, add_special_tokens=False) if odd else ())
        return [np.asarray(next(library).ids, "<u4").tobytes() if p is None else b"".join(map(known.__getitem__, p))
                for p in pieces]

    def _learn(self, new: list[str]) -> None:
        rows, rest, mixed = [], [], []
        for w in new:
            if w.isalpha():
                (rows if len(w) <= _LONGEST else rest).append(w)
            elif len(parts := _PIECES.findall(w)) > 1:
                mixed.append((w, parts))
            else:
                rest.append(w)
        if mixed:  # words with punctuation: their pieces first
            missing = {p for _, parts in mixed for p in parts}.difference(self.known, new)
            if missing:
                self._learn(list(missing))
        for w, e in zip(rest, self.lib.encode_batch_fast(rest, add_special_tokens=False) if rest else (), strict=True):
            self.known[w] = np.asarray(e.ids, "<u4").tobytes()
        rows.sort(key=len)  # rows of one array have similar lengths
        for at in range(0, len(rows), 4096):
            part = rows[at:at + 4096]
            self.known.update(zip(part, self._merge([w.encode() for w in part]), strict=True))
        for w, parts in mixed:
            self.known[w] = b"".join(map(self.known.__getitem__, parts))

    def _hash(self, keys: np.ndarray) -> None:
        """Open-addressing table from pair to merge rank, four slots per pair."""
        self.bits = int(4 * len(keys)).bit_length()
        self.slot_key = np.full((1 << self.bits) + 64, -1, np.int64)
        self.slot_rank = np.full((1 << self.bits) + 64, _NEVER, np.int32)
        at, todo = self._slots(keys), np.arange(len(keys))
        while len(todo):
            free = self.slot_key[at] < 0
            self.slot_key[at[free]] = keys[todo[free]]  # of several claims on a slot the last stays
            won = self.slot_key[at] == keys[todo]
            self.slot_rank[at[won]] = todo[won]
            at, todo = at[~won] + 1, todo[~won]

    def _slots(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = np.where((left >= 0) & (right >= 0), left.astype(np.int64) * self.size + right, -2)
        at = self._slots(key)
        found = self.slot_key[at]
        out = np.where(found == key, self.slot_rank[at], _NEVER)
        todo = np.flatnonzero((found != key) & (found >= 0))
        while len(todo):
            at[todo] += 1
            found = self.slot_key[at[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.slot_rank[at[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return out

    def _merge(self, words: list[bytes]) -> list[bytes]:
        """Lowest-ranked adjacent pair first, leftmost first, one merge per word
        and step, for all words at once."""
        n, length = len(words), np.asarray([len(w) for w in words])
        width = int(length.max())
        flat = np.frombuffer(b"".join(words), np.uint8)
        row, col = np.repeat(np.arange(n), length), np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
        symbol = flat.astype(np.int32)
        symbol[np.cumsum(length) - 1] += 256  # a word's last byte is a symbol of its own
        ids = np.full((n, width + 1), -1, np.int32)
        ids[row, col] = np.concatenate([self.inner, self.final])[symbol]
        rank = np.full((n, width), _NEVER, np.int32)
        inside = col[1:] > 0
        rank[row[:-1][inside], col[:-1][inside]] = self.byte_rank[symbol[:-1][inside], symbol[1:][inside]]
        place = np.arange(width)
        live = np.arange(n)
        done = np.empty((n, width + 1), np.int32)
        while len(live):
            j = rank.argmin(axis=1)
            here = np.arange(len(live))
            best = rank[here, j]
            go = best < _NEVER
            if not go.all():
                done[live[~go], :ids.shape[1]] = ids[~go]
                live, ids, rank, j, best = live[go], ids[go], rank[go], j[go], best[go]
                here = np.arange(len(live))
                if not len(live):
                    break
            ids[here, j] = self.merged[best]
            after = place > j[:, None]  # close the gap at j + 1
            np.copyto(ids[:, :width], ids[:, 1:], where=after)
            np.copyto(rank[:, :width - 1], rank[:, 1:], where=after[:, :width - 1])
            rank[:, width - 1] = _NEVER
            prev = np.flatnonzero(j > 0)
            r, c = np.concatenate([here, prev]), np.concatenate([j, j[prev] - 1])
            rank[r, c] = self._ranks(ids[r, c], ids[r, c + 1])
        count = (done >= 0).sum(axis=1)
        raw = done[done >= 0].astype("<u4").tobytes()
        stop = 4 * np.cumsum(count)
        return [raw[b - 4 * c:b] for b, c in zip(stop.tolist(), count.tolist(), strict=True)]


_ENCODERS: dict[str, WordIds] = {}


def encoder(vocabulary: str) -> WordIds:
    """One encoder per worker process and vocabulary: what it knows serves the
    next task as well."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = WordIds(vocabulary)
    return _ENCODERS[vocabulary]
