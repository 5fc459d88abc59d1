"""Chat formatting by incremental black-box rendering.

The template is any function from a list of (role, text) turns to a string.
Successive prefixes of a conversation are rendered and consecutive outputs
compared: what the longer one adds behind the shorter one is the new turn's
span. If the shorter output is not the beginning of the longer one, the
template rewrites history, which is reported with the offset where they part.

Every prefix is rendered whole and compared whole, however long the
conversation, so a rewrite is found wherever it lies; a template may look at any
earlier turn, so this work grows with the square of a conversation's turns.

Conversations are shuffled once by id and streamed in turn order; what
is held is the turns and the output of one conversation at a time.

The default template marks turns as ``<|im_start|>role``, a line feed, the text
and ``<|im_end|>`` with a line feed. Inside roles and texts a backslash becomes
two and ``<|`` becomes ``<\\|``, so control strings in a text cannot end a turn
and the output reads back exactly.

Defined results: null text and null role are empty; rows are ordered by turn
(nulls first), then role, then text; repeated rows are turns of their own; a
null conv_id is one conversation; an empty table gives no rows; other columns
are ignored."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
Turn = tuple[str, str]
PIECES = ("conv_id long, place long, piece string, start long, mask_start long, mask_end long, "
          "rewrites_at long, last boolean")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\([\\|])", r"\1", text)


def chat_markup(turns: list[Turn]) -> str:
    """The default template."""
    return "".join(f"{START}{escape(role).replace(chr(10), chr(92) + 'n')}\n{escape(text)}{END}\n" for role, text in turns)


def read_turn(piece: str) -> Turn:
    """The (role, text) that the default template rendered as ``piece``."""
    if not piece.startswith(START) or not piece.endswith(f"{END}\n"):
        raise ValueError("not a turn of this template")
    role, _, text = piece[len(START):-len(END) - 1].partition("\n")
    role = re.sub(r"\\([\\|n])", lambda m: "\n" if m[1] == "n" else m[1], role)
    return role, unescape(text)


def turn_mask(piece: str) -> tuple[int, int]:
    """Where the text of an assistant turn lies in its piece ((0, 0): no loss)."""
    role, _ = read_turn(piece)
    return (piece.index("\n") + 1, len(piece) - len(END) - 1) if role == "assistant" else (0, 0)


class Prefixes:
    """Renders a conversation turn by turn. ``add`` gives the span text of the
    new turn and where history was rewritten, an offset into the conversation's
    output (None: it was not)."""

    def __init__(self, template: Callable[[list[Turn]], str]):
        self.template = template
        self.turns: list[Turn] = []
        self.shown = ""

    def add(self, turn: Turn) -> tuple[str, int | None]:
        self.turns.append(turn)
        now = self.template(list(self.turns))
        parted = None if now.startswith(self.shown) else _parting(self.shown, now)
        piece = now[len(self.shown) if parted is None else parted:]
        self.shown = now
        return piece, parted


def _parting(a: str, b: str) -> int:
    """The length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


def _render(template: Callable[[list[Turn]], str], mask: Callable[[str], tuple[int, int]]):
    def fn(batches):
        at, prefixes, place, offset = object(), None, 0, 0
        held = None  # the last piece, given out when it is known whether its conversation goes on
        for batch in batches:
            out = []
            for conv, role, text in zip(*[batch.column(k).to_pylist() for k in (0, 2, 3)], strict=True):
                if held and conv != at:
                    out.append(held[:-1] + (True,))
                elif held:
                    out.append(held)
                if conv != at:
                    at, prefixes, place, offset = conv, Prefixes(template), 0, 0
                piece, parted = prefixes.add((role or "", text or ""))
                lo, hi = mask(piece) if parted is None else (0, 0)
                held = (conv, place, piece, offset, offset + lo, offset + hi, parted, False)
                place, offset = place + 1, offset + len(piece)
            yield _rows(out)
        if held:
            yield _rows([held[:-1] + (True,)])
    return fn


def _rows(out: list) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
    names = ("conv_id", "place", "piece", "start", "mask_start", "mask_end", "rewrites_at", "last")
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=list(names))


def format_conversations(rows: DataFrame, template: Callable[[list[Turn]], str] = chat_markup,
                         mask: Callable[[str], tuple[int, int]] = turn_mask) -> DataFrame:
    """One row per turn, in order within each partition: conversation, place,
    the turn's rendered piece, its offset in the conversation's output, the
    loss mask there (empty where no loss is taken), where history was rewritten
    and whether the turn is the last. The pieces of a conversation, joined in
    order, are its formatted text; offsets are code points."""
    src = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                      F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return (src.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(_render(template, mask), PIECES))


def _digest(batches):
    count = loss = size = 0
    turns, masked = hashlib.sha256(), hashlib.sha256()
    for batch in batches:
        out = []
        for conv, piece, start, lo, hi, last in zip(*[batch.column(k).to_pylist() for k in (0, 2, 3, 4, 5, 7)], strict=True):
            role, text = read_turn(piece)
            turns.update(f"{role}\n{text}\n".encode())
            learned = unescape(piece[lo - start:hi - start])
            masked.update(learned.encode())
            count, loss, size = count + 1, loss + len(learned), size + len(piece)
            if last:
                out.append((conv, count, turns.hexdigest(), loss, masked.hexdigest(), size))
                count = loss = size = 0
                turns, masked = hashlib.sha256(), hashlib.sha256()
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)],
                                         names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def digests(pieces: DataFrame) -> DataFrame:
    """One row per conversation, read back from ``format_conversations`` with
    the default template: turn count, digest of all turns, and size and digest
    of the text under the loss mask."""
    return pieces.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long")
