"""N-gram Jaccard join: documents linked when their sets of n-word shingles
have a Jaccard similarity of at least ``num / den``; no link is missed.

A set is the sorted distinct 64-bit hashes of a text's shingles; equal sets
share one 64-bit fingerprint and are one node, so copies are never expanded.

* Size bands. Set sizes are cut into geometric bands. A pair is handled in the
  band of its smaller set, so a set enters its own band and, as the larger
  partner, at most the bands down to ``num / den`` of its size.
* Tiles. In a band a linked pair differs in at most k shingles. The hash range
  is cut into m > k parts, so at least m - k parts of a linked pair are equal:
  a tile is (band, part, hash of the part's shingles). A part without shingles
  says little and is left out, unless a set has m - k or more of them, when
  leaving them out could lose a pair.
* Leaders. Each tile offers one of six leaders (one per residue of the tile's
  hash), found with a minimum that is combined before the shuffle, so a tile
  holding a third of all sets yields one candidate per member.
* Bit counts. Every set has a hashed bitmap. A bit set in only one of the two
  bitmaps proves a shingle in only one set, which bounds the overlap from
  above; pairs that cannot reach the similarity stop here.
* Exact check. The remaining pairs intersect their sorted arrays.
* Rest of a tile. Tiles whose members are still in different components (one
  of those with the same members) are compared in blocks of at most ``BLOCK``
  members and ``BLOCK_BYTES`` a side, only where sizes allow a link and only
  between components. Two rounds, on a quarter of the bitmap and on all of it,
  keep the members that have a pair left which the bound allows. The sets of
  these are intersected in their block pair, joining components there as links
  are found, so that only links which join something leave: fewer than members.
  No pair leaves unchecked and none is dropped.

Defined results: a null or empty text has an empty set, ``n_shingles`` 0, and
is its own component; a text with fewer than ``n`` words has one shingle, all
its words; repeated rows keep one output row each; other columns are ignored.
Hashes stand for shingles and sets: results are exact but for a 64-bit hash
collision."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .scratch import Scratch
from .words import mix, shingle_hashes, word_hashes

BLOCK = 2048
BLOCK_BYTES = 16 << 20
PROBE = 4
SLICE = 256
BAND_RATIO = 1.5
_U = np.uint64
_LEADERS = 6


@cache
def bands(num: int, den: int, upto: int) -> tuple[tuple[int, int, int, int], ...]:
    """(lowest, highest smaller-set size, k, m) of each band up to a size."""
    out, lo = [], 1
    while lo <= upto:
        hi = max(lo, int(lo * BAND_RATIO))
        widest = hi * den // num
        k = (hi + widest) * (den - num) // (den + num)
        slack = 0
        for _ in range(4):  # expected empty parts of the smallest set, with a margin
            empty = (k + 1 + slack) * float(np.exp(-lo / (k + 1 + slack)))
            slack = int(np.ceil(empty + 3 * np.sqrt(empty)))
            slack = min(slack, k // 3 + 2)
        out.append((lo, hi, k, k + 1 + slack))
        lo = hi + 1
    return tuple(out)


def _tiles(s: np.ndarray, num: int, den: int) -> np.ndarray:
    """Tile hashes of a sorted distinct set."""
    n = len(s)
    out = []
    with np.errstate(over="ignore"):
        run = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(mix(s ^ _U(0x5851F42D4C957F2D)), out=run[1:])
        for b, (lo, hi, k, m) in enumerate(bands(num, den, n)):
            if k == 0 or hi * den < n * num or lo > n:
                continue  # k = 0: only equal sets link there
            edges = np.searchsorted(s, (np.arange(1, m, dtype=np.uint64) * _U((1 << 64) // m)))
            edges = np.concatenate([[0], edges, [n]])
            size = np.diff(edges)
            part = np.arange(m, dtype=np.uint64)
            key = mix((run[edges[1:]] - run[edges[:-1]]) + part * _U(0x9E3779B97F4A7C15)
                      + _U(b + 1) * _U(0xC2B2AE3D27D4EB4F) + size.astype(np.uint64))
            if np.count_nonzero(size == 0) < m - k:
                key = key[size > 0]
            out.append(key)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _bitmap(s: np.ndarray, part: int = 1) -> bytes:
    """Bits of a sorted set, or of its hashes in the first 1/``part`` of the
    range, from which the bound holds as well, only looser."""
    width = max(64, (1 << (4 * len(s) - 1).bit_length()) // part)
    s = s[:np.searchsorted(s, _U((1 << 64) // part - 1), side="right")]
    bits = np.zeros(width, dtype=np.uint8)
    bits[(s & _U(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _slices(batches):
    """Batches in pieces that keep a worker's arrays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def _each_set(batch: pa.RecordBatch, n: int):
    words, first = word_hashes(batch.column(1))
    for r in range(batch.num_rows):
        w = words[first[r]:first[r + 1]]
        h = shingle_hashes(w, min(n, len(w))) if len(w) else w
        yield np.unique(h)


def _fingerprint(s: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        total = np.asarray([mix(s).sum(dtype=np.uint64) + _U(len(s))], dtype=np.uint64)
    return int(mix(total).view(np.int64)[0])


def _outline(n: int, num: int, den: int):
    def fn(batches):
        seen: set[int | None] = {None}  # a task's copies of a set need its tiles and bitmap once
        for batch in _slices(batches):
            sizes, prints, tiles, maps, probes = [], [], [], [], []
            for s in _each_set(batch, n):
                sizes.append(len(s))
                prints.append(_fingerprint(s) if len(s) else None)
                new = prints[-1] not in seen
                seen.add(prints[-1])
                tiles.append(_tiles(s, num, den).view(np.int64) if new else np.zeros(0, np.int64))
                maps.append(_bitmap(s) if new and len(tiles[-1]) else None)
                probes.append(_bitmap(s, PROBE) if new and len(tiles[-1]) else None)
            lengths = np.zeros(len(tiles) + 1, np.int32)
            np.cumsum([len(t) for t in tiles], out=lengths[1:])
            flat = np.concatenate(tiles) if tiles else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat, pa.int64())),
                 pa.array(maps, pa.binary()), pa.array(probes, pa.binary())],
                names=["doc_id", "n_shingles", "node", "tiles", "bits", "probe"])
    return fn


def _full_sets(n: int):
    def fn(batches):
        for batch in _slices(batches):
            prints, sets = [], []
            for s in _each_set(batch, n):
                if len(s):
                    prints.append(_fingerprint(s))
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(prints, pa.int64()), pa.array(sets, pa.binary())],
                                             names=["node", "items"])
    return fn


def _fold(bits: np.ndarray, width: int) -> np.ndarray:
    """Narrow bitmaps (rows of 64-bit words) to ``width`` words by OR of halves."""
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def _may_link(na, nb, only_a, only_b, num: int, den: int):
    """Can the overlap, bounded by what each bitmap has alone, still suffice?"""
    bound = np.minimum(na - only_a, nb - only_b)
    return den * bound >= num * (na + nb - bound)


def _bit_filter(num: int, den: int):
    def fn(batches):
        for batch in batches:
            na, nb = (batch.column(k).to_numpy() for k in (2, 3))
            keep = np.zeros(batch.num_rows, dtype=bool)
            for r, (x, y) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                width = min(len(x), len(y))
                x, y = _fold(x, width), _fold(y, width)
                keep[r] = _may_link(na[r], nb[r], int(np.bitwise_count(x & ~y).sum()),
                                    int(np.bitwise_count(y & ~x).sum()), num, den)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))
    return fn


def _exact(num: int, den: int):
    def fn(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for r in range(batch.num_rows):
                x = np.frombuffer(batch.column(2)[r].as_buffer(), np.uint64)
                y = np.frombuffer(batch.column(3)[r].as_buffer(), np.uint64)
                both = _common(x, y)
                keep[r] = den * both >= num * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))
    return fn


def _each_block(fn):
    """Runs ``fn(tile, columns)`` on each block pair; rows come sorted by it.
    ``fn`` yields tuples of longs, put out under the names it carries."""
    names = ("side", "node", "root", "n", "bits")

    def run(batches):
        at, rows = None, {k: [] for k in names}
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            out = []
            for r in range(batch.num_rows):
                key = (cols[0][r], cols[1][r], cols[2][r])
                if key != at:
                    if at is not None:
                        out.extend(fn(at[0], rows))
                    at, rows = key, {k: [] for k in names}
                for k, c in zip(names, cols[3:], strict=True):
                    rows[k].append(c[r])
            yield _long_batch(out, fn.names)
        if at is not None:
            yield _long_batch(list(fn(at[0], rows)), fn.names)
    return run


def _long_batch(out: list, names: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(len(names))], names=list(names))


def _partners(side, node, root, n, bits, num: int, den: int):
    """(i, the members j of the other side) that are in different components
    and pass the size and bitmap bounds; each pair once. ``root`` may change
    between the steps."""
    left, right = np.flatnonzero(side <= 1), np.flatnonzero(side >= 1)
    for i in left.tolist():
        j = right[(root[right] != root[i]) & (den * np.minimum(n[right], n[i]) >= num * np.maximum(n[right], n[i]))]
        if side[i] == 1:  # both sides hold the same block
            j = j[node[j] > node[i]]
        if len(j):
            mine = np.bitwise_count(bits[i] & ~bits[j]).sum(axis=1, dtype=np.int64)
            theirs = np.bitwise_count(bits[j] & ~bits[i]).sum(axis=1, dtype=np.int64)
            j = j[_may_link(n[i], n[j], mine, theirs, num, den)]
            if len(j):
                yield i, j


def _arrays(rows: dict[str, list]):
    return [np.asarray(rows[k], dtype=np.int64) for k in ("side", "node", "root", "n")]


def _stacked(maps: list) -> np.ndarray:
    width = min(len(b) for b in maps) // 8
    return np.stack([_fold(np.frombuffer(b, np.uint64), width) for b in maps])


def _survivors(num: int, den: int):
    """Members of a block pair that have a partner left."""
    def fn(tile: int, rows: dict[str, list]):
        side, node, root, n = _arrays(rows)
        left = np.zeros(len(node), dtype=bool)
        for i, j in _partners(side, node, root, n, _stacked(rows["bits"]), num, den):
            left[i] = True
            left[j] = True
        for k in np.flatnonzero(left).tolist():
            yield tile, int(node[k]), int(n[k])
    fn.names = ("tile", "node", "n")
    return fn


def _common(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    return int(np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x))


def _joining_links(num: int, den: int):
    """Links of a block pair, by exact intersection, that join two components
    not joined by those before."""
    def fn(tile: int, rows: dict[str, list]):
        side, node, root, n = _arrays(rows)
        sets = [np.frombuffer(b, np.uint64) for b in rows["bits"]]
        bits = _stacked([_bitmap(x) for x in sets])
        for i, j in _partners(side, node, root, n, bits, num, den):
            while len(j):
                both = _common(sets[i], sets[j[0]])
                if den * both >= num * (n[i] + n[j[0]] - both):
                    yield int(min(node[i], node[j[0]])), int(max(node[i], node[j[0]]))
                    root[root == root[j[0]]] = root[i]
                    j = j[root[j] != root[i]]
                else:
                    j = j[1:]
    fn.names = ("a", "b")
    return fn


def _bit(h):
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(h, 40), F.lit(64)).cast("int"))


def _member_sketch(keys: DataFrame, col: str, rows: int) -> DataFrame:
    """A bitmap of at most ``rows`` 64-bit words marking the hashes of ``col``."""
    h = F.xxhash64(F.col(col))
    return F.broadcast(keys.groupBy(F.pmod(h, F.lit(rows)).alias("_word")).agg(  # at most ``rows`` rows
        F.bit_or(_bit(h)).alias("_mask")))


def _may_be_member(df: DataFrame, col: str, sketch: DataFrame, rows: int) -> DataFrame:
    """Rows of ``df`` whose ``col`` may be among the sketched keys (no false
    negatives); saves shuffling the others into the exact join that follows."""
    h = F.xxhash64(F.col(col))
    return (df.withColumn("_word", F.pmod(h, F.lit(rows))).join(sketch, "_word")
            .filter(F.col("_mask").bitwiseAND(_bit(h)) != 0).drop("_word", "_mask"))


SKETCH_ROWS = 1 << 19


class _Documents:
    """What checks need of the input: bitmaps by node, and whole sets of the
    few nodes whose pairs pass the bitmap bound, from the texts again."""

    def __init__(self, src: DataFrame, outline: DataFrame, scratch: Scratch, n: int, num: int, den: int):
        self.src, self.outline, self.scratch, self.n, self.num, self.den = src, outline, scratch, n, num, den
        self.maps = outline.filter("bits is not null").select("node", F.col("n_shingles").alias("n"), "bits").dropDuplicates(["node"])
        self.probes = outline.filter("bits is not null").select("node", F.col("n_shingles").alias("n"), F.col("probe").alias("bits")).dropDuplicates(["node"])

    def sets_of(self, nodes: DataFrame) -> DataFrame:
        wanted = self.scratch.write(self.outline.select("node", "doc_id").join(nodes, "node", "left_semi")
                                    .groupBy("node").agg(F.min("doc_id").alias("doc_id")))
        sketch = _member_sketch(wanted, "doc_id", SKETCH_ROWS)
        texts = _may_be_member(self.src, "doc_id", sketch, SKETCH_ROWS).select("doc_id", "text")
        return self.scratch.write(texts.mapInArrow(_full_sets(self.n), "node long, items binary")
                                  .join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]))

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Linked pairs among candidate (a, b): bitmap bound, then exact."""
        one, two = (self.maps.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"x{k}")) for k in "ab")
        close = self.scratch.write(
            pairs.join(one, "a").join(two, "b").filter(F.least("na", "nb") * self.den >= F.greatest("na", "nb") * self.num)
            .select("a", "b", "na", "nb", "xa", "xb").mapInArrow(_bit_filter(self.num, self.den), "a long, b long"))
        sets = self.sets_of(close.select(F.col("a").alias("node")).unionByName(close.select(F.col("b").alias("node"))).distinct())
        one, two = (sets.select(F.col("node").alias(k), F.col("items").alias(f"x{k}")) for k in "ab")
        return self.scratch.write(close.join(one, "a").join(two, "b").select("a", "b", "xa", "xb")
                                  .mapInArrow(_exact(self.num, self.den), "a long, b long"))


def _mixed_tiles(members: DataFrame, roots: DataFrame, width: int, least: int = 2) -> DataFrame:
    """(tile, node, root, blocks) of tiles of at least ``least`` members in
    several components; a member takes ``width`` bytes a shingle."""
    placed = members.select("tile", "node", "n").join(roots, "node", "left").select(
        "tile", "node", "n", F.coalesce("root", "node").alias("root"))
    # Linked texts share many tiles with the same members; one of these is enough.
    mixed = (placed.groupBy("tile").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("c"),
                                        F.sum("n").alias("total"), F.bit_xor(F.xxhash64("node")).alias("who"))
             .filter((F.col("lo") != F.col("hi")) & (F.col("c") >= least))
             .groupBy("who", "c").agg(F.min(F.struct("tile", "total")).alias("one")).select("one.*", "c"))
    blocks = F.greatest(F.ceil(F.col("c") / F.lit(BLOCK)), F.ceil(F.col("total") * width / F.lit(BLOCK_BYTES)))
    return placed.drop("n").join(mixed.select("tile", blocks.alias("blocks")), "tile")


def _block_rows(mixed: DataFrame, maps: DataFrame) -> DataFrame:
    """Each member once per block pair of its tile, with its bitmap, sorted."""
    mine = F.pmod(F.xxhash64("node"), F.col("blocks"))
    return (mixed.withColumn("mine", mine)
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .withColumn("p", F.least("mine", "other")).withColumn("q", F.greatest("mine", "other"))
            .withColumn("side", F.when(F.col("p") == F.col("q"), 1).when(F.col("mine") == F.col("p"), 0).otherwise(2))
            .join(maps, "node").repartition("tile", "p", "q").sortWithinPartitions("tile", "p", "q")
            .select("tile", "p", "q", "side", "node", "root", "n", "bits"))


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3,
                    num: int = 90, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row: the size of its set
    and the smallest id reachable by links."""
    spark = docs.sparkSession
    scratch = Scratch(spark, batch_rows=1024)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    outline = scratch.write(src.mapInArrow(
        _outline(n, num, den), "doc_id long, n_shingles long, node long, tiles array<long>, bits binary, probe binary"))

    tiles = outline.select("node", F.col("n_shingles").alias("n"), F.explode("tiles").alias("tile"))
    turn = F.pmod("tile", F.lit(_LEADERS))
    salt = F.element_at(F.array(*[F.lit(int(x)) for x in mix(np.arange(7, 7 + _LEADERS, dtype=np.uint64)).view(np.int64)]),
                        (turn + 1).cast("int"))
    shared = scratch.write(  # tiles of two sets or more, and the leader each offers
        tiles.withColumn("x", F.col("node").bitwiseXOR(salt)).groupBy("tile")
        .agg(F.min("x").alias("lo"), F.max("x").alias("hi")).filter("lo <> hi")
        .select("tile", F.col("lo").bitwiseXOR(salt).alias("leader")))
    sketch = _member_sketch(shared, "tile", SKETCH_ROWS)
    members = scratch.write(_may_be_member(tiles, "tile", sketch, SKETCH_ROWS).join(shared, "tile")
                            .select("tile", "node", "n", "leader").distinct())

    texts = _Documents(src, outline, scratch, n, num, den)
    tried = scratch.write(members.filter("node <> leader").select(
        F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct())
    roots = components(texts.linked(tried), scratch)

    # A tile of two was compared through its leader.
    mixed = scratch.write(_mixed_tiles(members, roots, 1, least=3))
    for maps in (texts.probes, texts.maps):
        members = scratch.write(_block_rows(mixed, maps).mapInArrow(
            _each_block(_survivors(num, den)), "tile long, node long, n long").distinct())
        mixed = _mixed_tiles(members, roots, 1)
    sets = texts.sets_of(members.select("node").distinct()).select(
        "node", F.expr("octet_length(items) div 8").alias("n"), F.col("items").alias("bits"))
    links = scratch.write(_block_rows(_mixed_tiles(members, roots, 8), sets).mapInArrow(
        _each_block(_joining_links(num, den)), "a long, b long").distinct())
    if not links.isEmpty():
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links), scratch)

    joined = outline.select("doc_id", "n_shingles", "node").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    smallest = joined.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("low"))
    return scratch.finish(joined.join(smallest, "root", "left").select(
        "doc_id", "n_shingles", F.coalesce("low", "doc_id").alias("component_id")))
