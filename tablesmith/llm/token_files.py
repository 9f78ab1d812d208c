"""Token ids in Parquet files that allow selective reads.

``write`` range-sorts the documents by id, encodes each whole text and writes
one row per document into shards, one per task:

* ``ids``: a list column, dictionary-encoded (a vocabulary fits one dictionary
  page, so an id takes 16 bits or less);
* ``doc_id``, ``shard``, ``before``, ``after``: delta-encoded; the last two are
  the numbers of ids of the shard before and up to the end of the document;
* row groups and pages of a set size, with column and offset indexes, so that
  a predicate on the small columns skips row groups and pages of ``ids``.

Each task counts its own ids while it writes; the shards' totals, one small row
each, are summed in a table beside the files and give the offset of a shard in
the whole stream. ``documents`` reads the small columns only, ``tokens`` adds
the ids and ``span`` reads the ids at a range of positions of the stream.

Encoding is exact: texts are cut at ASCII white space, where the tokenizer cuts
too, and of each chunk the distinct words are taken. Words of ASCII and Latin-1
letters are cut further by the tokenizer's own pattern, so that a word costs no
merges whose pieces others had in another case or beside another mark. The
pieces, and other words whole, are encoded once each by the library and kept in
a bounded cache that a worker's tasks share.

Defined results: a null text is an empty one and holds the end id only; rows
with a null id come last; rows with equal ids come in the order of a hash of
their texts (equal rows are interchangeable); very long texts are encoded whole,
a task holds a few MB of texts, or one longer text, at a time; an empty table gives files without
rows; only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 1024
CHUNK_BYTES = 4 << 20
CACHE_WORDS = 700_000
JOINED = 512
#: In words that do not hold ASCII and the letters of Latin-1 only. No normal form
#: changes these simple ones, and each of their characters has one lower case.
_OTHER = r"[^\x00-\x7FÀ-ÖØ-öø-ÿ]"
#: How the tokenizer of ``word_bpe`` cuts such words in lower case; between words
#: there is one space.
_PIECE = re.compile(r" |'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^ a-z0-9ß-öø-ÿ]+")
_SCHEMA = "doc_id long, shard int, before long, after long, ids array<int>"


class Encoder:
    """Ids of texts, by cached ids of their pieces."""

    def __init__(self, tokenizer_path: str, end_id: int = 2):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer_path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        # simple pieces are in normal form and lower case, and cut: only the merges are left to do
        bare = json.loads(self.library.to_str())
        bytes_only = next(p for p in bare["pre_tokenizer"]["pretokenizers"] if p["type"] == "ByteLevel")
        bare |= {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, bytes_only]}, "added_tokens": []}
        self.merges = Tokenizer.from_str(json.dumps(bare))
        self.end_id = end_id
        self.clear()

    def clear(self) -> None:
        """Forget all words: place i holds flat[ends[i]:ends[i + 1]]."""
        self.words: dict[str, int] = {}
        self.pieces: dict[str, int] = {}
        self.flat, self.ends, self.n = np.zeros(1 << 16, dtype=np.int32), np.zeros(1 << 14, dtype=np.int64), 0
        self.pieces[" "] = self._add(np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64))[0]

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> range:
        """Places for new entries."""
        used, n = int(self.ends[self.n]), self.n
        self.flat, self.ends = _room(self.flat, used + len(ids)), _room(self.ends, n + len(sizes) + 1)
        self.flat[used : used + len(ids)] = ids
        self.ends[n + 1 : n + 1 + len(sizes)] = used + np.cumsum(sizes)
        self.n += len(sizes)
        return range(n, self.n)

    def _learn(self, pieces: list[str]) -> None:
        for at in range(0, len(pieces), JOINED):
            part = pieces[at : at + JOINED]
            found = self.merges.encode(" ".join(part), add_special_tokens=False)
            ids, numbers = np.array(found.ids, dtype=np.int32), np.array(found.word_ids, dtype=np.int64)
            self.pieces.update(zip(part, self._add(ids, np.bincount(numbers, minlength=len(part)))))

    def _of_simple(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of simple words in a row, and how many each has."""
        joined = pc.binary_join(pa.LargeListArray.from_arrays([0, len(words)], words), " ")[0].as_py()
        cut = _PIECE.findall(f"{joined} ".lower()) if len(words) else []
        self._learn(list(set(cut).difference(self.pieces)))
        places = np.fromiter(map(self.pieces.__getitem__, cut), dtype=np.int64, count=len(cut))
        ids, done = _gather(self.flat, self.ends, places)
        return ids, np.diff(done[places == self.pieces[" "]], prepend=0)

    def _of_other(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words that the library takes as they are."""
        new = [w for w in words if w not in self.words]
        each = [x.ids for x in self.library.encode_batch_fast(new, add_special_tokens=False)]
        sizes = np.array([len(x) for x in each], dtype=np.int64)
        self.words.update(zip(new, self._add(np.array([i for x in each for i in x], dtype=np.int32), sizes)))
        places = np.fromiter(map(self.words.__getitem__, words), dtype=np.int64, count=len(words))
        ids, done = _gather(self.flat, self.ends, places)
        return ids, np.diff(done, prepend=0)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, each text followed by the end id, and the numbers of ids."""
        if self.n > CACHE_WORDS:
            self.clear()
        lists = pc.ascii_split_whitespace(texts.fill_null(""))
        found = lists.flatten().dictionary_encode()
        words = found.dictionary
        other = pc.match_substring_regex(words, _OTHER)
        simple = pc.invert(other)
        # the simple words come first, then the other ones
        parts = [self._of_simple(words.filter(simple)), self._of_other(words.filter(other).to_pylist())]
        flat, sizes = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(other.to_numpy(zero_copy_only=False), kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        ids, done = _gather(flat, np.concatenate([[0], np.cumsum(sizes)]), place[found.indices.to_numpy()])
        ends = np.concatenate([[0], done])[np.cumsum(np.diff(lists.offsets.to_numpy()))]
        return np.insert(ids, ends, np.int32(self.end_id)), np.diff(ends, prepend=0) + 1


def _gather(flat: np.ndarray, ends: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids at places in a row, and where each place's ids end in it."""
    first, size = ends[places], ends[places + 1] - ends[places]
    done = np.cumsum(size)
    return flat[np.repeat(first - (done - size), size) + np.arange(int(done[-1]) if len(done) else 0)], done


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows from, to: of about ``CHUNK_BYTES``, or one longer text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, done = 0, 0
    while at < len(size):
        end = max(at + 1, int(np.searchsorted(size, done + CHUNK_BYTES, side="right")))
        yield at, end
        at, done = end, int(size[end - 1])


def _room(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), dtype=a.dtype)])


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def _encoder(path: str, end_id: int) -> Encoder:
    """One for each worker process: its cache outlives a task."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = Encoder(path, end_id)
    return _ENCODERS[path, end_id]


def write(docs: DataFrame, tokenizer_path: str, out: str, end_id: int = 2) -> None:
    """Encode ``docs`` and write the folders ``out/ids`` and ``out/shards``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, before = _encoder(tokenizer_path, end_id), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at, end in _chunks(batch.column(1)):
                part = batch.slice(at, end - at)
                ids, counts = encoder.encode(part.column(1))
                ends = np.cumsum(counts)
                rows = [
                    part.column(0), pa.array(np.full(len(counts), shard, dtype=np.int32)), pa.array(before + ends - counts), pa.array(before + ends),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids)),
                ]
                before += int(ends[-1])
                yield pa.RecordBatch.from_arrays(rows, names=["doc_id", "shard", "before", "after", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
    # the row number only parts rows that are equal otherwise, so that many of them do not meet in one shard
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie").asc(), F.col("row").asc()]
    encoded = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(run, _SCHEMA)
    (
        encoded.write.option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#ids.list.element", "true")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .parquet(f"{out}/ids")
    )
    totals = _ids(docs.sparkSession, out).groupBy("shard").agg(F.max("after").alias("size"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    totals.select("shard", "size", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset")).write.parquet(f"{out}/shards")


def _ids(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(f"{out}/ids")


def _shards(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema("shard int, size long, offset long").parquet(f"{out}/shards")


def _placed(spark: SparkSession, out: str, ids: DataFrame) -> DataFrame:
    # one row per shard: no more rows than the write had tasks
    shards = F.broadcast(_shards(spark, out).select("shard", "offset"))
    return ids.join(shards, "shard").withColumn("start", F.col("offset") + F.col("before")).withColumn("n_tokens", F.col("after") - F.col("before"))


def documents(spark: SparkSession, out: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it) and ``n_tokens``;
    the ids are not read."""
    return _placed(spark, out, _ids(spark, out)).select("doc_id", "start", "n_tokens")


def tokens(spark: SparkSession, out: str) -> DataFrame:
    """``documents`` with ``ids``."""
    return _placed(spark, out, _ids(spark, out)).select("doc_id", "start", "n_tokens", "ids")


def span(spark: SparkSession, out: str, first: int, last: int) -> DataFrame:
    """``doc_id``, ``start`` and ``ids`` of the stream's positions from
    ``first`` up to, not including, ``last``. Only the pages that hold them are
    read: the shards at both ends, two rows, turn the positions into predicates
    on the files' columns."""
    ends = _shards(spark, out).where((F.col("offset") < last) & (F.col("offset") + F.col("size") > first))
    a, b = ends.agg(F.min("shard"), F.max("shard")).first()
    if a is None:
        return tokens(spark, out).select("doc_id", "start", "ids").limit(0)
    offset = {r["shard"]: r["offset"] for r in ends.where(F.col("shard").isin(a, b)).collect()}
    rows = _ids(spark, out).where(F.col("shard").between(a, b))
    in_first, in_last = F.col("after") > first - offset[a], F.col("before") < last - offset[b]
    if a == b:
        rows = rows.where(in_first & in_last)
    else:
        rows = rows.where((F.col("shard") > a) | in_first).where((F.col("shard") < b) | in_last)
    rows = _placed(spark, out, rows)
    skip, until = F.greatest(F.lit(first) - F.col("start"), F.lit(0)), F.least(F.lit(last) - F.col("start"), F.col("n_tokens"))
    part = F.slice("ids", (skip + 1).cast("int"), (until - skip).cast("int"))
    return rows.select("doc_id", (F.col("start") + skip).alias("start"), part.alias("ids"))


def with_crc32(rows: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens`` and the unsigned CRC-32 of the ids as
    little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            data = memoryview(np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False)).astype("<u4").tobytes())
            crc = [zlib.crc32(data[4 * s : 4 * e]) for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
