"""SentencePiece encoding and decoding of BPE models, by vectorised merge rounds.

Encoding works on *words*: runs of the space symbol with the text after them.
No piece of the model may join a word's end to the next space symbol (checked
when the model is loaded; otherwise a whole text is one word), so merges never
cross a word. The symbols of many words lie in one flat numpy array. A round
takes the pair of the smallest rank of each word by a segmented minimum (the
leftmost pair on ties) and merges these pairs of all words at once; only the
pairs beside a merge get a new rank. Symbols keep their places and know the next
and previous one; words without a mergeable pair leave the arrays when they are
many. One merge per word and round keeps the exact order of the library, also where
a merge creates a pair of better rank than the one just used. Words longer
than ``LONG`` symbols would need a round per merge over a long array; they are
merged with a heap instead, with the same result.

Each distinct word is encoded once per task (a bounded cache): it gets a number,
its ids lie in one flat array, and the ids of texts are gathered from there.
Characters without a piece become byte pieces. Decoding takes the bytes of all
pieces at once; texts that are not plain UTF-8 then are decoded one by one.

Defined results: null and empty texts give the end id only and decode to the
empty text; repeated rows and clashing extra columns pass through.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
LONG = 400
CACHE_WORDS = 400_000
CHUNK_ROWS = 256
_CODES = 0x110000
_NO_RANK = 2**24  # above all ranks
_PLACE = 16  # bits of a place within a word of at most LONG symbols
_NO_PAIR = _NO_RANK << _PLACE


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 5:
            yield tag >> 3, struct.unpack_from("<f", data, at)[0]
            at += 4
        elif kind == 1:
            yield tag >> 3, data[at : at + 8]
            at += 8
        else:
            size = varint()
            yield tag >> 3, data[at : at + size]
            at += size


class _Numbers(dict):
    """Numbers of words as they come, the new ones kept apart."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class PieceBpe:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = f.read()
        self.pieces: list[str] = []
        self.types: list[int] = []
        scores = []
        trainer, normalizer = {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(piece.get(2, 0.0))
                self.types.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        # the kind of model this operator is written for; others would need their own normalization
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0):
            raise ValueError("a BPE model with byte fallback and leading spaces is expected")
        if normalizer.get(2) or not normalizer.get(3, 1) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("identity normalization with a dummy prefix is expected")
        if {USER, UNUSED} & set(self.types):
            raise ValueError("user-defined and unused pieces are not supported")
        self.eos = self.types.index(CONTROL, self.pieces.index("</s>"))
        self.controls = [i for i, t in enumerate(self.types) if t == CONTROL]
        size = len(self.pieces)
        ids = {p: i for i, p in enumerate(self.pieces) if self.types[i] == NORMAL}
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.types[i] == BYTE}
        self.size = size
        self.char_ids = np.arange(size, size + _CODES, dtype=np.int64)  # a symbol without piece: size + code point
        for p, i in ids.items():
            if len(p) == 1:
                self.char_ids[ord(p)] = i
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in ids.values()}, reverse=True))}
        keys, merged, ranks = [], [], []
        for p, i in ids.items():
            for cut in range(1, len(p)):
                pair = [self._symbol(x, ids) for x in (p[:cut], p[cut:])]
                if None not in pair:
                    keys.append(pair[0] * (size + _CODES) + pair[1])
                    merged.append(i)
                    ranks.append(order[scores[i]])
        at = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.array(keys, dtype=np.int64)[at]
        self.merged = np.array(merged, dtype=np.int64)[at]
        self.ranks = np.array(ranks, dtype=np.int64)[at]
        self.pairs = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.merged.tolist())))
        long_pieces = [p for p in ids if len(p) > 1]
        crosses = any(SPACE in p.lstrip(SPACE) for p in long_pieces)
        # a line feed that is in no longer piece ends a word, too
        line = "" if any("\n" in p for p in long_pieces) else "\n"
        self.words = re.compile("(?s:.+)") if crosses else re.compile(f"{SPACE}*[^{SPACE}{line}]+|{SPACE}+|\n")
        self.forget()
        self.texts = [
            b"" if t == CONTROL else " ⁇ ".encode() if t == UNKNOWN else bytes([int(p[3:5], 16)]) if t == BYTE else p.replace(SPACE, " ").encode()
            for p, t in zip(self.pieces, self.types)
        ]
        # behind them, as they begin a text: without the space put before it
        spaced = [t == NORMAL and p[0] == SPACE for p, t in zip(self.pieces, self.types)]
        self.bytes = pa.array(self.texts + [x[1:] if c else x for x, c in zip(self.texts, spaced)], pa.large_binary())
        self.is_control = np.array(self.types) == CONTROL

    def forget(self) -> None:
        """The cache of words: the ids of number i are ``flat[first[i]:][:size[i]]``."""
        self.cache = _Numbers()
        self.flat, self.used = np.zeros(1 << 16, dtype=np.int32), 0
        self.first, self.size_of = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)

    def _symbol(self, part: str, ids: dict[str, int]) -> int | None:
        if len(part) == 1:
            return int(self.char_ids[ord(part)])
        return ids.get(part)

    # ------------------------------------------------------------ encoding
    def _learn(self, words: list[str]) -> None:
        """Ids of the words numbered last."""
        at = len(self.cache) - len(words)
        names, sizes, ids = self.encode_words(words)
        self.first, self.size_of = _room(self.first, len(self.cache)), _room(self.size_of, len(self.cache))
        self.flat = _room(self.flat, self.used + len(ids))
        self.flat[self.used : self.used + len(ids)] = ids
        self.first[at + names] = self.used + np.cumsum(sizes) - sizes
        self.size_of[at + names] = sizes
        self.used += len(ids)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of each word after all merges: places of the words, in the order
        in which they were done, numbers of their ids, and these in a row."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        names = np.flatnonzero(lengths <= LONG)
        done = []
        for i in np.flatnonzero(lengths > LONG).tolist():
            found = self._encode_long(words[i])
            done.append((np.array([i]), np.array([len(found)]), np.array(found, dtype=np.int64)))
        done += self._merge_rounds(names, lengths[names], "".join([words[i] for i in names.tolist()]))
        names, sizes, sym = (np.concatenate(x) for x in zip(*done))
        return names, *self._with_bytes(sizes, sym)

    def _merge_rounds(self, names: np.ndarray, lengths: np.ndarray, joined: str) -> list[tuple[np.ndarray, ...]]:
        """Some names at a time, their numbers of symbols after all merges, and the symbols."""
        sym = self.char_ids[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        starts = np.cumsum(lengths) - lengths
        place = np.arange(len(sym)) - np.repeat(starts, lengths)
        after, before = place + 1, place - 1  # places of the next and previous symbol
        rank, into = self._pair_ranks(sym[:-1], sym[1:])
        key, into = np.append((rank << _PLACE) + place[:-1], _NO_PAIR), np.append(into, -1)  # of each symbol and the next one
        key[starts + lengths - 1] = _NO_PAIR  # no pair across words
        ready = []
        while len(names):
            best = np.minimum.reduceat(key, starts)
            going = best < _NO_PAIR
            go = np.flatnonzero(going)
            if 4 * len(go) < 3 * len(names):
                stay = np.repeat(going, lengths)
                left = ~stay & (sym >= 0)
                ready.append((names[~going], np.add.reduceat((sym >= 0).astype(np.int64), starts)[~going], sym[left]))
                sym, key, into, after, before = sym[stay], key[stay], into[stay], after[stay], before[stay]
                names, lengths, best = names[go], lengths[go], best[go]
                starts = np.cumsum(lengths) - lengths
                go = np.arange(len(names))
            start, at = starts[go], best[go] & ((1 << _PLACE) - 1)
            one = start + at
            two = start + after[one]
            far = after[two]  # the place after the pair
            sym[one], sym[two] = into[one], -1
            key[one] = key[two] = _NO_PAIR
            after[one] = far
            # only the pairs on both sides of a merged symbol change
            has = np.flatnonzero(far < lengths[go])
            right = start[has] + far[has]
            before[right] = at[has]
            near = before[one]
            prior = np.flatnonzero(near >= 0)
            first, second = np.concatenate([one[has], start[prior] + near[prior]]), np.concatenate([right, one[prior]])
            rank, merged = self._pair_ranks(sym[first], sym[second])
            key[first] = (rank << _PLACE) + np.concatenate([at[has], near[prior]])
            into[first] = merged
        return ready

    def _with_bytes(self, sizes: np.ndarray, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of words and their symbols, those without a piece as byte pieces."""
        odd = np.flatnonzero(sym >= self.size)
        if not len(odd):
            return sizes, sym
        symbols, which = np.unique(sym[odd], return_inverse=True)
        parts = [[self.byte_ids[b] for b in chr(s - self.size).encode("utf-8", "surrogatepass")] for s in symbols.tolist()]
        width = np.array([len(x) for x in parts])[which]
        table = np.array([x + [0] * (4 - len(x)) for x in parts])[which]
        times = np.ones(len(sym), dtype=np.int64)
        times[odd] = width
        out = np.repeat(sym, times)
        ends = np.cumsum(times)
        for i in range(4):
            some = width > i
            out[ends[odd[some]] - width[some] + i] = table[some, i]
        return np.diff(ends[np.cumsum(sizes) - 1], prepend=0), out

    def _pair_ranks(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = first * (self.size + _CODES) + second
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], _NO_RANK), self.merged[at]

    def _encode_long(self, word: str) -> list[int]:
        sym = self.char_ids[np.frombuffer(word.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)].tolist()
        n, base = len(sym), self.size + _CODES
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = nxt[i]
            if j < n and (found := self.pairs.get(sym[i] * base + sym[j])):
                heapq.heappush(heap, (found[0], i, sym[i], sym[j], found[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = nxt[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue  # one of the two was merged meanwhile
            sym[i], sym[j] = merged, None
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            if prv[i] >= 0:
                offer(prv[i])
            offer(i)
        return [s for s in sym if s is not None]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text, the end id last."""
        ids, ends = self.encode_flat(texts)
        return [x.tolist() for x in np.split(ids, ends[:-1])] if texts else []

    def encode_flat(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, the end id last in each, and where each ends."""
        split = [self.words.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.forget()
        count = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        number = np.fromiter(map(self.cache.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=int(count.sum()))
        if new := self.cache.new:
            self.cache.new = []
            self._learn(new)
        size = self.size_of[number]
        done = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(self.first[number] - done[:-1], size) + np.arange(done[-1])]
        ends = done[np.cumsum(count)]
        return np.insert(ids, ends, np.int32(self.eos)), ends + np.arange(1, len(texts) + 1)

    # ------------------------------------------------------------ decoding
    def decode(self, ids: list[int]) -> str:
        if any(c in ids[:-1] for c in self.controls):
            return self._decode_apart(ids)
        data = b"".join(map(self.texts.__getitem__, ids))
        for i in ids:
            if self.types[i] != CONTROL:
                if self.types[i] == NORMAL and self.pieces[i][0] == SPACE:
                    data = data[1:]  # the space put before the text
                break
        try:
            return data.decode()
        except UnicodeDecodeError:
            return self._decode_apart(ids)

    def decode_flat(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts of ids in a row, none of them empty."""
        starts = np.concatenate([[0], ends[:-1]])
        control = self.is_control[ids]
        control[ends - 1] = False
        if not control.any():
            taken = ids.astype(np.int64)
            taken[starts] += self.size
            pieces = self.bytes.take(pa.array(taken))
            _, places, data = pieces.buffers()
            at = np.frombuffer(places, dtype=np.int64, count=len(pieces) + 1)[np.concatenate([[0], ends])]
            try:
                return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(at), data]).cast(pa.string())
            except pa.ArrowInvalid:  # not UTF-8
                pass
        return pa.array([self.decode(ids[s:e].tolist()) for s, e in zip(starts.tolist(), ends.tolist())], pa.string())

    def _decode_apart(self, ids: list[int]) -> str:
        """Each run of byte pieces by itself; a byte that is not UTF-8 becomes U+FFFD."""
        out, run, first = [], b"", True
        for i in [*ids, None]:
            if i is not None and self.types[i] == BYTE:
                run += self.texts[i]
                first = False
                continue
            while run:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(run[:n].decode())
                        run = run[n:]
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�")
                    run = run[1:]
            if i is None or self.types[i] == CONTROL:
                continue
            text = self.texts[i].decode()
            out.append(text[1:] if first and self.types[i] == NORMAL and text[0] == " " else text)
            first = False
        return "".join(out)


def _room(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), dtype=a.dtype)])


_loaded: dict[str, PieceBpe] = {}


def load(path: str) -> PieceBpe:
    """The model, loaded once per Python worker."""
    if path not in _loaded:
        _loaded[path] = PieceBpe(path)
    return _loaded[path]


def encode_decode(docs: DataFrame, model_path: str, keep: list[str], with_text: bool = True) -> DataFrame:
    """``keep`` columns, ``input_ids`` of the text with the end id last and,
    if ``with_text``, ``decoded``: what the ids decode to. No shuffle."""
    fields = [docs.schema[c] for c in keep] + [T.StructField("input_ids", T.ArrayType(T.IntegerType()))]
    if with_text:
        fields.append(T.StructField("decoded", T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, CHUNK_ROWS):
                    part = batch.slice(at, CHUNK_ROWS)
                    ids, ends = model.encode_flat(part.column(len(keep)).to_pylist())
                    columns = [part.column(i) for i in range(len(keep))]
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids)))
                    if with_text:
                        columns.append(model.decode_flat(ids, ends))
                    yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])
        finally:
            model.forget()  # the worker lives on, in stages that need the memory

    return docs.select(*keep, "text").mapInArrow(run, T.StructType(fields))
