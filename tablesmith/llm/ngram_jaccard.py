"""N-gram Jaccard join by PartEnum signatures (Arasu, Ganti and Kaushik,
Efficient Exact Set-Similarity Joins, 2006).

A document's set are its distinct word shingles; two documents link when
``100 * intersection >= percent * union``. Then their symmetric difference has
at most ``(100 - percent) / (100 + percent) * (|A| + |B|)`` elements, at most
``k`` of them for sets of one size family. The signatures of a set: shingles are
dealt by hash to ``n1`` partitions, few enough differ that one partition holds
at most ``k2`` differing elements; each partition is dealt to ``n2`` smaller
ones, of which at most ``k2`` are touched; all subsets of ``n2 - k2`` smaller
ones are enumerated, and the elements of each subset are hashed to a signature.
Linked sets share at least one. The families are the size bands and, for
partners on both sides of the bound of two bands, the sizes around it. The join
is exact: signatures only propose pairs, the sets decide.

A subset without elements says nothing, and a share of all sets have it. There
is one partition more for every ``BLOCK``, so that in some block of them linked
sets share two signatures of different partitions: one with elements, which
stands by itself, or two without, which sign as a couple.

Every row is a node of its own; rows of equal sets are one class, represented by
the row of the smallest id. Signatures are many and nearly all occur once, so
they move packed: a task sorts those of its rows (of equal sets in a pack one
signs) and writes the differences of neighbours by
byte places, which compress. Ranges of the signature space, as many as there are
signatures for, then meet. Of the classes that share a signature the one of the
smallest node leads the others; all that one class leads are its star. Only the
pairs of a star are compared: what signatures chain together through many stars
grows with the square of the table. At lower similarities
signatures hold few elements, and passages that many documents share bring
unrelated sets into a star. A sketch takes them apart first: element
hashes flip the bits of a bit set, so two sets whose sketches differ in more
bits than their difference may have elements cannot link. The sketches
of a large star are compared in tiles by a matrix product, at one width; larger sets
have wider sketches, which take apart the pairs that are left. The components of
the pairs that then remain are the clusters. Inside these the sets themselves are
compared, all pairs, but no pairs are emitted: its sets are dealt to tiles of
about ``TILE`` sets, a task multiplies the incidence matrices of two tiles, and
returns per set the number of documents linked to it and one edge of a
spanning forest of the links. A group of thousands of near copies costs rows
in proportion to its size, and a task's memory is bounded by two tiles.

Shingles are compared as 64-bit hashes of 64-bit word hashes; sets as a
128-bit combination of them.

Defined results: null texts and texts without words have the empty set and
link with nothing (their component is their own id); rows with equal ids but
different texts are linked as documents of their own, and their components are
one; rows with a null id belong to the class of their equal sets only; very long
texts are read whole, their sets fill a task one at a time; an empty table gives
an empty result; only ``doc_id`` and ``text`` are read, so other columns may have
any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablesmith.llm.common import Scratch, components, join_forest, own_exchange, small_batches

WORDS = 3
PERCENT = 90
K2, N2 = 1, 3
#: Partitions for which there is one more.
BLOCK = 16
TILE = 512
SKETCH_BITS = 2048
SKETCH_TILE = 4096
COLUMNS = 4096  # of the incidence matrices at a time
CHUNK_ROWS = 512
CACHE_WORDS = 200_000
SKETCH_ROWS = 128
#: Sets of a star that is compared pair by pair, among others.
SMALL_STAR = 64
COMPARED = 4 << 20  # bytes of sketches at a time
#: Signatures of one pack, and about those of one range of the signature space.
PACK = 1 << 19
RANGE = 1 << 20
#: Bits of a signature. Chance meetings are few even for 10^13 signatures, and only propose pairs.
SIGNATURE_BITS = 56
_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mix(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads all bits (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, words: int, hashes: _WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit shingles; bytes.lower and bytes.split know A-Z
    and the six ASCII white-space characters only, as the definition asks."""
    parts = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, parts), dtype=np.uint64, count=len(parts))
    width = min(words, len(parts))
    total = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        total = _mix(total * _C1 + h[i : len(h) - width + 1 + i])
    return np.unique(total)


def sketch_bits(n: int) -> int:
    """Bits of the sketch of a set of ``n`` elements: ``n`` or more. With fewer
    the sketches of unrelated sets differ in no more bits than linked ones may."""
    return SKETCH_BITS << (max(0, n - 1) // SKETCH_BITS).bit_length()


def sketch(items: np.ndarray) -> bytes:
    """A bit set with the bit of each element's hash flipped. Its halves
    combined are the sketch of half as many bits."""
    width = sketch_bits(len(items))
    bits = np.bincount((_mix(items ^ _C1 ^ _C3) % np.uint64(width)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


class Bands:
    """Size bands, the families that sets sign for, and the signatures."""

    def __init__(self, percent: int):
        self.percent = percent
        self.lows = [1]

    def _low(self, band: int) -> int:
        while len(self.lows) <= band:
            low = self.lows[-1]
            # at least as wide as the sizes a partner can have, so that partners are in the same or next band
            self.lows.append(max(low + 1, low * 3 // 2 + 1, low * 100 // self.percent + 1))
        return self.lows[band]

    def _difference(self, both: int) -> int:
        """The most that linked sets of ``both`` elements together differ in."""
        return both * (100 - self.percent) // (100 + self.percent)

    def families(self, size: int) -> list[tuple[int, int]]:
        """The families a set of this size signs for, with the difference bound
        of each: its band, and the bounds of it that a partner may lie beyond."""
        band = 0
        while self._low(band + 1) <= size:
            band += 1
        out = [(2 * band, self._difference(2 * (self._low(band + 1) - 1)))]
        for family, low in ((2 * band - 1, self._low(band)), (2 * band + 1, self._low(band + 1))):
            largest = 100 * (low - 1) // self.percent  # of a partner of a set below
            if low <= largest and (100 * size >= self.percent * low if size < low else size <= largest):
                out.append((family, self._difference(low - 1 + largest)))
        return out

    def signatures(self, items: np.ndarray) -> np.ndarray:
        out = []
        for family, k in self.families(len(items)):
            if k == 0:
                continue  # only equal sets, which are one class already
            n1 = k // (K2 + 1) + 1
            blocks = -(-n1 // BLOCK)
            n1 += blocks  # linked sets agree in more partitions than there are blocks
            part = (_mix(items ^ _C2) % np.uint64(n1 * N2)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            counts = np.bincount(part, minlength=n1 * N2)
            sums = np.zeros(len(items) + 1, dtype=np.uint64)
            np.cumsum(_mix(items[order] ^ _C3), out=sums[1:])
            ends = np.cumsum(counts)
            each = (sums[ends] - sums[ends - counts] + counts.astype(np.uint64) * _C1).reshape(n1, N2)
            filled = counts.reshape(n1, N2) > 0
            subsets = list(combinations(range(N2), N2 - K2))
            empty = np.empty((n1, len(subsets)), dtype=bool)
            for s, subset in enumerate(subsets):
                some = filled[:, subset[0]].copy()
                for i in subset[1:]:
                    some |= filled[:, i]
                empty[:, s] = ~some
                partition = np.flatnonzero(some)
                name = np.full(len(partition), family * 64 + s, dtype=np.uint64) * _C2 + partition.astype(np.uint64) * _C3
                value = np.zeros(len(partition), dtype=np.uint64)
                for i in subset:
                    value = _mix(value * _C1 + each[partition, i])
                out.append(_mix(value + name))
            out += _couples(np.flatnonzero(empty), len(subsets), n1, blocks, family)
        return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def _couples(at: np.ndarray, subsets: int, n1: int, blocks: int, family: int) -> list[np.ndarray]:
    """A signature for each two subsets without elements, of different partitions
    of a block; ``at`` has the numbers of these subsets, rising by partition."""
    out, partition = [], at // subsets
    block = partition * blocks // n1
    for step in range(1, len(at)):
        near = block[step:] == block[:-step]
        if not near.any():
            break
        two = near & (partition[step:] != partition[:-step])
        first, second = at[:-step][two].astype(np.uint64), at[step:][two].astype(np.uint64)
        out.append(_mix(_mix(first * _C1 + np.uint64(family)) * _C2 + second * _C3))
    return out


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Its rows one by one: each holds whole packs or tiles."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


class _Packs:
    """Signatures of the rows of a task, packed ``PACK`` at a time. Of rows with
    equal sets the first signs: they are one class."""

    def __init__(self):
        self.nodes: list[int] = []
        self.signatures: list[np.ndarray] = []
        self.seen: set[tuple] = set()
        self.size = 0

    def add(self, node: int, set_hash: tuple, signatures: np.ndarray) -> None:
        if not len(signatures) or set_hash in self.seen:
            return
        self.seen.add(set_hash)
        self.nodes.append(node)
        self.signatures.append(signatures)
        self.size += len(signatures)

    def take(self) -> dict:
        """A pack."""
        owner = np.repeat(np.arange(len(self.nodes), dtype=np.int32), np.fromiter(map(len, self.signatures), dtype=np.int64, count=len(self.nodes)))
        found = np.concatenate([np.zeros(0, dtype=np.uint64), *self.signatures])
        order = np.argsort(found, kind="stable")  # owners rise within a signature
        pack = _packed(found[order], owner[order])
        pack["nodes"] = np.array(self.nodes, dtype=np.int64).tobytes()
        self.__init__()
        return pack


def _planes(a: np.ndarray) -> bytes:
    """The bytes of an array of integers, place by place: high ones are mostly 0."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def _packed(signatures: np.ndarray, owners: np.ndarray) -> dict:
    return {"count": len(signatures), "signatures": _planes(np.diff(signatures, prepend=np.uint64(0))), "owners": _planes(owners.astype(np.int32))}


_SETS = "kind int, node long, doc_id long, n long, h1 long, h2 long, digest long, sketch binary, count long, signatures binary, owners binary, nodes binary"
_ROW, _PACK = 0, 1


def _sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Rows of two kinds: a document with its set size, 128-bit set hash and
    sketch; a pack of signatures. No shuffle."""
    names = [c.split()[0] for c in _SETS.split(", ")]

    def rows(kind: int, columns: dict) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
        types = [kinds[c.split()[1]] for c in _SETS.split(", ")]
        columns = {"kind": np.full(n, kind, dtype=np.int32)} | columns
        return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(names, types)], names=names)

    def flush(packs: _Packs) -> Iterator[pa.RecordBatch]:
        pack = packs.take()
        if pack["count"]:
            yield rows(_PACK, {k: [v] for k, v in pack.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bands, packs = _WordHashes(), Bands(percent), _Packs()
        node = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                if len(hashes) > CACHE_WORDS:
                    hashes.clear()
                found: dict[str, list] = {c: [] for c in ("node", "n", "h1", "h2", "sketch")}
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    items = shingles(text, words, hashes)
                    set_hash = _mix(items ^ _C1).sum(dtype=np.uint64), np.bitwise_xor.reduce(_mix(items + _C3), initial=np.uint64(0))
                    for c, v in zip(found, (node, len(items), *(int(h.view(np.int64)) for h in set_hash), sketch(items))):
                        found[c].append(v)
                    if len(items) and doc_id is not None:
                        packs.add(node, (len(items), *set_hash), bands.signatures(items) >> np.uint64(64 - SIGNATURE_BITS))
                    node += 1
                yield rows(_ROW, found | {"doc_id": part.column(0), "digest": part.column(2)})
                if packs.size >= PACK:
                    yield from flush(packs)
        yield from flush(packs)

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("digest"))
    return ids.mapInArrow(run, _SETS)


def _shared(packs: DataFrame) -> DataFrame:
    """``a, b``: nodes that share a signature with the smallest node ``b``."""
    total, ranges = packs.agg(F.sum("count")).first()[0] or 0, 32
    while ranges * RANGE < total:
        ranges *= 2
    shift = np.uint64(SIGNATURE_BITS - ranges.bit_length() + 1)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack in _rows(batch):
                found, owners = np.cumsum(_from_planes(pack["signatures"], np.uint64), dtype=np.uint64), _from_planes(pack["owners"], np.int32)
                nodes = np.frombuffer(pack["nodes"], dtype=np.int64)
                ends = np.searchsorted(found >> shift, np.arange(ranges + 1, dtype=np.uint64)).tolist()
                for r, (s, e) in enumerate(zip(ends[:-1], ends[1:])):
                    if s < e:
                        part = _packed(found[s:e], owners[s:e])
                        # a task's nodes are numbered in a row: the first one and distances to it say all
                        offsets = _planes((nodes[owners[s:e]] - nodes[0]).astype(np.int32))
                        row = {"range": [r], "base": [int(nodes[0])], "signatures": [part["signatures"]], "offsets": [offsets]}
                        yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("range", pa.int32()), ("base", pa.int64()), ("signatures", pa.binary()), ("offsets", pa.binary())]))

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        found = np.concatenate([np.cumsum(_from_planes(x, np.uint64), dtype=np.uint64) for x in rows["signatures"]])
        nodes = np.concatenate([np.int64(base) + _from_planes(x, np.int32).astype(np.int64) for base, x in zip(rows["base"], rows["offsets"])])
        order = np.lexsort((nodes, found))
        found, nodes = found[order], nodes[order]
        first = np.concatenate([[True], found[1:] != found[:-1]])
        least = nodes[np.maximum.accumulate(np.where(first, np.arange(len(found)), 0))]
        return pd.DataFrame({"a": nodes[~first], "b": least[~first]}).drop_duplicates()

    parts = packs.select("count", "signatures", "owners", "nodes").mapInArrow(split, "range int, base long, signatures binary, offsets binary")
    return parts.groupBy("range").applyInPandas(meet, "a long, b long")


def _shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """``cluster, tiles, id, copies`` and the set of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                items = [shingles(t, words, hashes).view(np.int64) for t in part.column(4).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(items, pa.list_(pa.int64()))], names=["cluster", "tiles", "id", "copies", "items"])

    return docs.select("cluster", "tiles", "id", "copies", "text").mapInArrow(run, "cluster long, tiles long, id long, copies long, items array<long>")


class Tile:
    """Some sets of a cluster: ``items`` are their distinct elements, sorted, and
    ``column`` holds the place of each element there, set by set."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, lengths: np.ndarray, items: np.ndarray, column: np.ndarray):
        self.ids, self.copies, self.lengths, self.items, self.column = ids, copies, lengths, items, column

    def held(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which sets hold the chosen of ``items``: set, number of the item; by item."""
        number = np.full(len(self.items), -1, dtype=np.int32)
        number[chosen] = np.arange(len(chosen), dtype=np.int32)
        column = number[self.column]
        some = column >= 0
        row = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.lengths)[some]
        column = column[some]
        order = np.argsort(column, kind="stable")
        return row[order], column[order]


def _tile(ids: np.ndarray, copies: np.ndarray, sets: list[np.ndarray]) -> Tile:
    ids, first = np.unique(ids, return_index=True)  # rows that repeat an id are one
    sets = [sets[f] for f in first.tolist()]
    items, column = np.unique(np.concatenate(sets), return_inverse=True)
    lengths = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    return Tile(ids, copies[first], lengths, items, column.astype(np.int32))


def _from_rows(rows: pd.DataFrame) -> Tile:
    return _tile(rows["id"].to_numpy(np.int64), rows["copies"].to_numpy(np.int64), list(rows["items"]))


_TILE = ["ids", "copies", "lengths", "items", "columns"]


def _pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """A tile as one row. The sets of a cluster share most elements: an element
    is written once, the sets hold distances of places, which compress."""
    t = _from_rows(rows)
    steps = pa.compress(_planes(np.diff(t.column, prepend=np.int32(0))), codec="zstd", asbytes=True)
    packed = dict(zip(_TILE, [*(x.tobytes() for x in (t.ids, t.copies, t.lengths, t.items)), steps]))
    return pd.DataFrame({"cluster": [key[0]], "tile": [key[1]], **{k: [v] for k, v in packed.items()}})


def _unpack(ids: bytes, copies: bytes, lengths: bytes, items: bytes, columns: bytes) -> Tile:
    ids, copies, lengths, items = (np.frombuffer(x, dtype=np.int64) for x in (ids, copies, lengths, items))
    steps = pa.decompress(columns, decompressed_size=4 * int(lengths.sum()), codec="zstd", asbytes=True)
    return Tile(ids, copies, lengths, items, np.cumsum(_from_planes(steps, np.int32), dtype=np.int32))


def common_counts(a: Tile, b: Tile) -> np.ndarray:
    """The sizes of the intersections of all sets of ``a`` with all of ``b``; of
    one tile with itself, those of its different sets."""
    if a is b:
        in_a = in_b = np.flatnonzero(np.bincount(a.column, minlength=len(a.items)) > 1)
    else:
        _, in_a, in_b = np.intersect1d(a.items, b.items, assume_unique=True, return_indices=True)
    held_a = a.held(in_a)
    held_b = held_a if a is b else b.held(in_b)

    def incidence(held: tuple, sets: int, first: int) -> np.ndarray:
        row, column = held
        s, e = np.searchsorted(column, [first, first + COLUMNS])
        m = np.zeros((sets, min(COLUMNS, len(in_a) - first)), dtype=np.float32)
        m[row[s:e], column[s:e] - first] = 1
        return m

    out = np.zeros((len(a.ids), len(b.ids)), dtype=np.float32)
    for first in range(0, len(in_a), COLUMNS):
        x = incidence(held_a, len(a.ids), first)
        out += x @ (x if a is b else incidence(held_b, len(b.ids), first)).T
    return out.astype(np.int64)


def _tile_links(a: Tile, b: Tile, percent: int) -> pd.DataFrame:
    """Linked documents and a forest edge for each set of two tiles, or of one."""
    same = a is b
    common = common_counts(a, b)
    i, j = np.nonzero(100 * common >= percent * (a.lengths[:, None] + b.lengths[None] - common))
    if same:
        i, j = i[i < j], j[i < j]
    shift = 0 if same else len(a.ids)
    ids = a.ids if same else np.concatenate([a.ids, b.ids])
    links, parent = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
    np.add.at(links, i, b.copies[j])
    np.add.at(links, j + shift, a.copies[i])
    join_forest(parent, i, j + shift)
    some = np.flatnonzero(links)
    return pd.DataFrame({"id": ids[some], "links": links[some], "root": ids[parent[some]]})


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """``id, links, root`` from all pairs of tiles of each cluster."""
    schema = "id long, links long, root long"

    def inside(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tile = _from_rows(rows)
        return _tile_links(tile, tile, percent)

    small = sets.where("tiles = 1").groupBy("cluster").applyInPandas(inside, schema)
    large = sets.where("tiles > 1").withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")))
    packed = large.groupBy("cluster", "tile").applyInPandas(_pack, "cluster long, tile long, ids binary, copies binary, lengths binary, items binary, columns binary")
    last = large.select("cluster", "tiles").distinct()
    tiles = large.select("cluster", "tile").distinct()
    pairs = tiles.join(last, "cluster").withColumn("other", F.explode(F.expr("sequence(tile, tiles - 1)"))).select("cluster", "tile", "other")
    second = packed.select("cluster", F.col("tile").alias("other"), *(F.col(c).alias(f"{c}2") for c in _TILE))
    both = pairs.join(packed, ["cluster", "tile"]).join(second, ["cluster", "other"])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                x = _unpack(*(row[c] for c in _TILE))
                y = x if row["tile"] == row["other"] else _unpack(*(row[f"{c}2"] for c in _TILE))
                yield pa.RecordBatch.from_pandas(_tile_links(x, y, percent), preserve_index=False)

    return small.unionByName(both.mapInArrow(across, schema))


# ------------------------------------------------- clusters by sketches
class SketchTile:
    """Sets with their sketches, packed at each width for the sets that have it."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, sketches: bytes):
        self.ids, self.n = ids, n
        width = np.array([sketch_bits(x) for x in n.tolist()], dtype=np.int64) // 8
        ends, data = np.cumsum(width), np.frombuffer(sketches, dtype=np.uint8)
        self.wide: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # bytes: place of each set or -1, sketches
        rows, folded = np.zeros(0, dtype=np.int64), None
        w = int(width.max(initial=SKETCH_BITS // 8))
        while w >= SKETCH_BITS // 8:
            own = np.flatnonzero(width == w)
            found = [data[e - w : e] for e in ends[own].tolist()]
            if folded is not None:
                found = [folded[:, :w] ^ folded[:, w:], *(x[None] for x in found)]
            folded, rows = np.vstack(found) if found else np.zeros((0, w), dtype=np.uint8), np.concatenate([rows, own])
            place = np.full(len(n), -1, dtype=np.int64)
            place[rows] = np.arange(len(rows))
            self.wide[w] = place, folded.view(np.uint64)
            w //= 2

    @cached_property
    def bits(self) -> np.ndarray:
        """Bits of -1 and 1 at the least width."""
        place, folded = self.wide[SKETCH_BITS // 8]
        return np.unpackbits(folded.view(np.uint8)[place], axis=1).astype(np.float32) * 2 - 1


def _sketch_links(a: SketchTile, b: SketchTile, percent: int) -> pd.DataFrame:
    """Forest edges of the pairs that sizes and sketches do not rule out.

    Linked sets of ``x`` and ``y`` elements differ in at most
    ``(100 - percent) / (100 + percent) * (x + y)``, and their sketches in no
    more bits. With bits as -1 and 1 a product counts equal less unequal bits.
    Pairs of larger sets that are left meet at each width that both have.
    """
    same = a is b
    parent = np.arange(len(a.ids) + (0 if same else len(b.ids)))
    shift = 0 if same else len(a.ids)
    for at in range(0, len(a.ids), SKETCH_ROWS):
        rows = slice(at, at + SKETCH_ROWS)
        unequal = (SKETCH_BITS - a.bits[rows] @ b.bits.T) / 2
        x, y = a.n[rows, None], b.n[None]
        possible = ((100 + percent) * unequal <= (100 - percent) * (x + y)) & (100 * np.minimum(x, y) >= percent * np.maximum(x, y))
        i, j = np.nonzero(possible)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for w in sorted(a.wide.keys() & b.wide.keys())[1:]:
            left = _near_at(w, a, b, i, j, percent)
            i, j = i[left], j[left]
        join_forest(parent, i, j + shift)
    ids = a.ids if same else np.concatenate([a.ids, b.ids])
    some = np.flatnonzero(parent != np.arange(len(parent)))
    return pd.DataFrame({"id": ids[some], "root": ids[parent[some]]})


def _star_links(rows: pa.RecordBatch, percent: int) -> pd.DataFrame:
    """Forest edges of what may link in each star; ``cluster, id, n, sketch`` by star."""
    cluster, ids, n = (rows.column(i).to_numpy() for i in range(3))
    sketches = rows.column(3)
    starts = np.flatnonzero(np.concatenate([[True], cluster[1:] != cluster[:-1]]))
    sizes = np.diff(np.append(starts, len(cluster)))
    out = []
    for s, e in zip(starts[sizes > SMALL_STAR].tolist(), (starts + sizes)[sizes > SMALL_STAR].tolist()):
        t = SketchTile(ids[s:e], n[s:e], b"".join(sketches[s:e].to_pylist()))
        out.append(_sketch_links(t, t, percent))
    few = np.flatnonzero(np.repeat(sizes <= SMALL_STAR, sizes))
    if len(few):
        t = SketchTile(ids[few], n[few], b"".join(sketches.take(pa.array(few)).to_pylist()))
        after = np.repeat(np.cumsum(sizes[sizes <= SMALL_STAR]), sizes[sizes <= SMALL_STAR]) - np.arange(len(few)) - 1  # places of a star after each of its places
        i = np.repeat(np.arange(len(few)), after)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(after) - after, after)
        left = 100 * np.minimum(t.n[i], t.n[j]) >= percent * np.maximum(t.n[i], t.n[j])
        i, j = i[left], j[left]
        for w in sorted(t.wide):
            left = _near_at(w, t, t, i, j, percent)
            i, j = i[left], j[left]
        parent = np.arange(len(few))
        join_forest(parent, i, j)
        some = np.flatnonzero(parent != np.arange(len(parent)))
        out.append(pd.DataFrame({"id": t.ids[some], "root": t.ids[parent[some]]}))
    return pd.concat(out)


def _near_at(width: int, a: SketchTile, b: SketchTile, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs sketches of ``width`` bytes do not rule out, or do not exist for."""
    (place_a, wide_a), (place_b, wide_b) = a.wide[width], b.wide[width]
    near, step = np.ones(len(i), dtype=bool), max(1, COMPARED // width)
    both = np.flatnonzero((place_a[i] >= 0) & (place_b[j] >= 0))
    for at in range(0, len(both), step):
        k = both[at : at + step]
        unequal = np.bitwise_count(wide_a[place_a[i[k]]] ^ wide_b[place_b[j[k]]]).sum(axis=1, dtype=np.int64)
        near[k] = (100 + percent) * unequal <= (100 - percent) * (a.n[i[k]] + b.n[j[k]])
    return near


def _possible(placed: DataFrame, percent: int) -> DataFrame:
    """``id, root``: a spanning forest of what may link, from ``cluster, tiles, id, n, sketch``."""

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # a star may go on in the next batch
        for batch in batches:
            table = pa.Table.from_batches([batch] if kept is None else [kept, batch]).combine_chunks()
            kept = table.to_batches()[0] if table.num_rows else None
            if kept is None:
                continue
            cluster = kept.column(0).to_numpy()
            done = int(np.searchsorted(cluster, cluster[-1]))
            if done:
                yield pa.RecordBatch.from_pandas(_star_links(kept.slice(0, done), percent), preserve_index=False)
                kept = kept.slice(done)
        if kept is not None:
            yield pa.RecordBatch.from_pandas(_star_links(kept, percent), preserve_index=False)

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        columns = {"ids": rows["id"].to_numpy(np.int64).tobytes(), "sizes": rows["n"].to_numpy(np.int64).tobytes(), "sketches": b"".join(rows["sketch"])}
        return pd.DataFrame({"cluster": [key[0]], "tile": [key[1]], **{k: [v] for k, v in columns.items()}})

    schema = "id long, root long"
    few = placed.where("tiles = 1").select("cluster", "id", "n", "sketch").repartition("cluster").sortWithinPartitions("cluster")
    small = few.mapInArrow(stars, schema)
    # tiles of sets of about one size: most pairs of tiles have sizes too different
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent * 1.000001)))  # a little wider than partners can be
    large = placed.where("tiles > 1").withColumn("band", band)
    bands = large.groupBy("cluster", "band").agg(F.ceil(F.count(F.lit(1)) / SKETCH_TILE).alias("need"))
    before = Window.partitionBy("cluster").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = bands.withColumn("first", F.coalesce(F.sum("need").over(before), F.lit(0)))
    tile_of = F.col("first") + F.pmod(F.xxhash64("id"), F.col("need"))
    split = bands.select(own_exchange("cluster").alias("cluster"), "band", "need", "first")
    dealt = large.join(split, ["cluster", "band"]).withColumn("tile", tile_of)
    packed = dealt.groupBy("cluster", "tile").applyInPandas(pack, "cluster long, tile long, ids binary, sizes binary, sketches binary")
    tiles = bands.select("cluster", "band", F.explode(F.expr("sequence(first, first + need - 1)")).alias("tile"))
    right = bands.select("cluster", F.col("band").alias("band2"), F.explode(F.expr("sequence(first, first + need - 1)")).alias("other"))
    near = tiles.withColumn("band2", F.explode(F.expr("array(band, band + 1)")))  # linked sizes are in one or in neighbouring bands
    pairs = near.join(right, ["cluster", "band2"]).where("tile <= other").select("cluster", "tile", "other")
    columns = ["ids", "sizes", "sketches"]
    second = packed.select("cluster", F.col("tile").alias("other"), *(F.col(c).alias(f"{c}2") for c in columns))
    both = pairs.join(packed, ["cluster", "tile"]).join(second, ["cluster", "other"])

    def unpack(row: dict, end: str) -> SketchTile:
        return SketchTile(*(np.frombuffer(row[c + end], dtype=np.int64) for c in columns[:2]), row[columns[2] + end])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                x = unpack(row, "")
                y = x if row["tile"] == row["other"] else unpack(row, "2")
                yield pa.RecordBatch.from_pandas(_sketch_links(x, y, percent), preserve_index=False)

    return small.unionByName(both.mapInArrow(across, schema))


def _clusters(edges: DataFrame, a: str, b: str, tile: int, scratch: Scratch) -> DataFrame:
    """``id, cluster, tiles`` of all ids with an edge."""
    return _sized(components(edges, a, b, scratch).withColumnRenamed("component_id", "cluster"), tile)


def _sized(joined: DataFrame, tile: int) -> DataFrame:
    """``id, cluster, tiles`` from ``id, cluster`` of all but the ids that name a cluster."""
    members = joined.unionByName(joined.select(F.col("cluster").alias("id"), "cluster").distinct())
    sizes = members.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / tile).alias("tiles"))
    return members.join(sizes.select(own_exchange("cluster").alias("cluster"), "tiles"), "cluster")


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``n_links`` (other documents linked
    directly, equal ones included) and ``component_id`` of every row."""
    with small_batches(docs.sparkSession):  # packs and pairs of tiles are rows of some MB
        return _joined(docs, words, percent)


def _joined(docs: DataFrame, words: int, percent: int) -> DataFrame:
    scratch = Scratch(docs.sparkSession)
    signed = scratch.keep(_sets(docs, words, percent))
    key = ["n", "h1", "h2"]
    rows = signed.where(F.col("kind") == _ROW).select("node", "doc_id", *key, "digest", "sketch")
    # the class's row of the smallest id is its node
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node", "digest", "sketch"))
    classes = rows.where("n > 0").groupBy(*key).agg(least.alias("m"), F.count(F.lit(1)).alias("copies"))
    classes = scratch.keep(classes.select(*key, F.col("m.node").alias("rep"), "m.doc_id", "m.digest", "m.sketch", "copies"))
    known = classes.select(F.col("n").alias("n_class"), own_exchange("h1").alias("h1"), "h2", "rep")
    of_class = (F.col("n") == F.col("n_class")) & (rows["h1"] == known["h1"]) & (rows["h2"] == known["h2"])
    stored = scratch.keep(rows.join(known, of_class, "left").select("node", "doc_id", "n", "rep"))
    shared = scratch.keep(_of_classes(_shared(signed.where(F.col("kind") == _PACK)), stored))
    scratch.drop(signed)
    stars = _sized(shared.select(F.col("a").alias("id"), F.col("b").alias("cluster")), SKETCH_TILE)
    weak = scratch.keep(stars.join(classes.select(F.col("rep").alias("id"), "n", "sketch"), "id"))
    scratch.drop(shared)
    possible = scratch.keep(_possible(weak, percent))
    scratch.drop(weak)
    members = _clusters(possible, "id", "root", TILE, scratch)
    placed = scratch.keep(members.join(classes.select(F.col("rep").alias("id"), "copies", F.col("doc_id").alias("own"), F.col("digest").alias("own_digest")), "id"))
    # the candidates have no size bound: the same merge join at every size, not a broadcast of few
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("digest"))
    texts = whole.join(placed.hint("merge"), (whole["doc_id"] == placed["own"]) & (whole["digest"] == placed["own_digest"]))
    sets = scratch.keep(_shingle_sets(texts, words))
    found = scratch.keep(_links(sets, percent))
    scratch.drop(sets)
    joined = found.select("id", "root").unionByName(_same_ids(stored))
    labels = components(joined, "id", "root", scratch).select(F.col("id").alias("rep"), F.col("component_id").alias("top"))
    links = found.groupBy(F.col("id").alias("rep")).agg(F.sum("links").alias("links"))
    named = classes.select("rep", "doc_id", "copies").join(labels, "rep", "left").join(links, "rep", "left")
    named = named.select("rep", "doc_id", F.coalesce("top", "rep").alias("top"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    smallest = named.groupBy("top").agg(F.min("doc_id").alias("component_id")).select(own_exchange("top").alias("top"), "component_id")
    named = named.join(smallest, "top").select(own_exchange("rep").alias("rep"), "n_links", "component_id")
    return stored.join(named, "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def _of_classes(links: DataFrame, stored: DataFrame) -> DataFrame:
    """Links of nodes as links of their classes."""
    copies = stored.where("rep <> node").select(own_exchange("node").alias("node"), "rep")
    for end in ("a", "b"):
        moved = copies.select(F.col("node").alias(f"{end}_node"), F.col("rep").alias(f"{end}_rep"))
        links = links.join(moved, F.col(end) == F.col(f"{end}_node"), "left").withColumn(end, F.coalesce(f"{end}_rep", end)).drop(f"{end}_node", f"{end}_rep")
    return links.where("a <> b").distinct()


def _same_ids(stored: DataFrame) -> DataFrame:
    """``id, root``: the classes of one id lead to the first of them."""
    of_id = stored.where("doc_id is not null and rep is not null").groupBy("doc_id")
    several = of_id.agg(F.min("rep").alias("root"), F.max("rep").alias("last")).where("root <> last").select(own_exchange("doc_id").alias("doc_id"), "root")
    return stored.select("doc_id", F.col("rep").alias("id")).join(several, "doc_id").where("id <> root").select("id", "root").distinct()
