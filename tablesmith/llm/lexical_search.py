"""Ranked lexical search by MaxScore with pair bounds.

The index is one row per block of documents: their ids and lengths, the block's
terms in order, and for each term the places of its documents and how often they
hold it. It is built where the documents are read, without a shuffle.

A search takes the queries in batches of ``BATCH``. For a batch, each block gets
the lists of the batch's terms as impacts (a term's share of the score) and,
computed beforehand for every block, the *term-pair intersection lists*: the
documents that hold both terms of a pair, with the largest joint impact. Each
query's terms are paired by falling document frequency, so that the frequent,
light terms, whose lists are long, bound each other. The largest impact of the
two terms together in one document is usually well below the sum of their
maxima; the bound of a pair is that joint maximum, or the larger single one.

MaxScore then runs on pairs instead of terms. Pairs whose bounds sum to less
than the threshold, the score of the query's 50th best so far, cannot make a
result alone: only documents in lists of the other pairs are scored. Of these,
one is given up once its score and the bounds of the pairs left stay below the
threshold; in a pair, a document outside the intersection list is bounded by the
larger single maximum. Nothing that may reach the threshold is skipped, so the
result is exact. Thresholds start from the query's block with the largest bound,
searched first, and rise while a task goes through its blocks.

The score of a document is in 64-bit integers: see ``impacts`` and ``weight``.
To the driver come two numbers of the corpus, the terms of a batch of queries
and at most ``k`` scores for each of its queries, none of which grows with the
documents; a task holds one block, which it also writes and reads alone.

Defined results: null and empty texts have no terms, match nothing and do not
count as documents; a query without known terms returns no rows; a document
without id ranks after all others of its score; rows with equal ids are
documents of their own; queries with equal ids are answered one by one; a very
long text is a block of its own; an empty table gives no rows; only ``doc_id``
and ``text`` (queries: ``item_id`` and ``text``) are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablesmith.llm.common import Scratch, wide_rows

TOP = 50
BLOCK_ROWS = 2048
BLOCK_BYTES = 8 << 20
#: Queries of one pass over the index.
BATCH = 1024
#: All ASCII but letters and digits separates terms; only A-Z are lower-cased.
_TO_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_NO_ID = np.iinfo(np.int64).max
_INDEX = "block long, n_docs long, n_filled long, n_terms long, ids array<long>, lengths array<long>, terms array<string>, counts array<int>, places array<int>, tfs array<int>"


def text_terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, with repeats."""
    return text.translate(_TO_TERMS).split() if text else []


# ------------------------------------------------------------------- index
def _block_row(block: int, ids: list[int | None], texts: list[list[bytes]]) -> pa.RecordBatch:
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    number: dict[bytes, int] = {}
    seen = np.fromiter((number.setdefault(t, len(number)) for x in texts for t in x), dtype=np.int64, count=int(lengths.sum()))
    terms = sorted(number)
    rank = np.empty(len(terms), dtype=np.int64)
    rank[np.fromiter((number[t] for t in terms), dtype=np.int64, count=len(terms))] = np.arange(len(terms))
    key, tfs = np.unique(rank[seen] * len(texts) + np.repeat(np.arange(len(texts)), lengths), return_counts=True)
    counts = np.bincount(key // len(texts), minlength=len(terms)).astype(np.int32)
    lists = [
        pa.array(ids, pa.int64()), pa.array(lengths), pa.array([t.decode("utf-8", "replace") for t in terms], pa.string()), pa.array(counts),
        pa.array((key % len(texts)).astype(np.int32)), pa.array(tfs.astype(np.int32)),
    ]
    numbers = [pa.array([int(n)], pa.int64()) for n in (block, len(ids), (lengths > 0).sum(), lengths.sum())]
    columns = [*numbers, *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists)]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _INDEX.split(", ")])


def build_index(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The written index of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                text = text.as_py()
                if texts and (len(texts) == BLOCK_ROWS or size + len(text or b"") > BLOCK_BYTES):
                    yield _block_row(block, ids, texts)
                    block, ids, texts, size = block + 1, [], [], 0
                ids.append(doc_id)
                texts.append(text_terms(text))
                size += len(text or b"")
        if texts:
            yield _block_row(block, ids, texts)

    return scratch.keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _INDEX), wide=True)


# ----------------------------------------------------------------- scores
def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to the score of a document, for weight 1."""
    m = 100 - 50 + 50 * length * n_docs // n_terms
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


@dataclass
class Batch:
    """Queries of one pass: for each the numbers of its terms."""

    items: np.ndarray  # numbers of the queries
    terms: list[str]  # sorted
    of_item: list[np.ndarray]
    weights: np.ndarray | None = None
    pairs: np.ndarray | None = None  # (n, 2) term numbers
    units: list[np.ndarray] | None = None  # for each query: numbers of pairs, or -1 - term where one is left over

    def weigh(self, df: np.ndarray, n_docs: int) -> None:
        """Weights from document frequencies, and the pairs of each query:
        terms by falling document frequency, neighbours paired."""
        self.weights = np.array([weight(n_docs, int(d)) if d else 0 for d in df], dtype=np.int64)
        number: dict[tuple[int, int], int] = {}
        self.units = []
        for own in self.of_item:
            known = own[df[own] > 0]
            known = known[np.lexsort((known, -df[known]))]
            couples = [(int(min(c)), int(max(c))) for c in zip(known[::2], known[1::2])]
            units = [number.setdefault(c, len(number)) for c in couples]
            self.units.append(np.array(units + [-1 - int(t) for t in known[len(couples) * 2 :]], dtype=np.int64))
        self.pairs = np.array(list(number), dtype=np.int64).reshape(-1, 2)


def _batches(items: DataFrame) -> Iterator[Batch]:
    """The numbered queries ``item, terms``, ``BATCH`` or so at a time."""
    n = max(1, math.ceil(items.count() / BATCH))
    for b in range(n):
        rows = items.where(F.pmod(F.xxhash64("item"), F.lit(n)) == b).collect()  # a batch of queries
        terms = sorted({t for r in rows for t in r["terms"]})
        number = {t: i for i, t in enumerate(terms)}
        if rows:
            yield Batch(np.array([r["item"] for r in rows], dtype=np.int64), terms, [np.array(sorted(number[t] for t in r["terms"]), dtype=np.int64) for r in rows])


def _document_frequencies(index: DataFrame, batch: Batch) -> np.ndarray:
    terms = batch.terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, wanted = np.zeros(len(terms), dtype=np.int64), pa.array(terms, pa.string())
        for rows in batches:
            for names, counts in zip(rows.column(0), rows.column(1)):
                mine, theirs = _known(wanted, names.values)
                total[mine] += counts.values.to_numpy()[theirs]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

    found = index.select("terms", "counts").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("df")).collect()  # terms of a batch
    df = np.zeros(len(terms), dtype=np.int64)
    for r in found:
        df[r["term"]] = r["df"]
    return df


def _known(wanted: pa.Array, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the wanted terms that occur, and their places in ``names``."""
    at = pa.compute.index_in(wanted, value_set=names)
    mine = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
    return mine, at.drop_null().to_numpy().astype(np.int64)


# --------------------------------------------------- lists, pairs and bounds
class Lists:
    """The lists of a block for a batch: impacts with weights, by term, and
    intersection lists by pair."""

    def __init__(self, terms, ends, places, scores, pairs, pair_ends, pair_places, joint):
        self.at = {int(t): i for i, t in enumerate(terms)}
        self.terms, self.ends, self.places, self.scores = terms, ends, places, scores
        self.top = np.maximum.reduceat(scores, ends[:-1]) if len(terms) else np.zeros(0, dtype=np.int64)
        self.pair_at = {int(p): i for i, p in enumerate(pairs)}
        self.pairs, self.pair_ends, self.pair_places, self.joint = pairs, pair_ends, pair_places, joint

    def list(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        i = self.at.get(term)
        if i is None:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        s, e = self.ends[i], self.ends[i + 1]
        return self.places[s:e], self.scores[s:e]

    def largest(self, term: int) -> int:
        i = self.at.get(term)
        return 0 if i is None else int(self.top[i])

    def both(self, pair: int) -> tuple[np.ndarray, int]:
        """The documents with both terms and their largest joint impact."""
        i = self.pair_at.get(pair)
        if i is None:
            return np.zeros(0, dtype=np.int64), 0
        return self.pair_places[self.pair_ends[i] : self.pair_ends[i + 1]], int(self.joint[i])


def _lists_of(row: dict[str, pa.Scalar], batch: Batch, n_docs: int, n_terms: int) -> Lists:
    """From an index row: the lists of the batch's terms, then the intersection
    list of each pair that occurs in the block."""
    names, counts, places, tfs = (row[c].values for c in ("terms", "counts", "places", "tfs"))
    lengths = row["lengths"].values.to_numpy()
    mine, theirs = _known(pa.array(batch.terms, pa.string()), names)
    ends = np.concatenate([[0], np.cumsum(counts.to_numpy(), dtype=np.int64)])
    size = ends[theirs + 1] - ends[theirs]
    own = np.concatenate([[0], np.cumsum(size)])
    take = np.repeat(ends[theirs] - own[:-1], size) + np.arange(own[-1])
    docs = places.to_numpy()[take].astype(np.int64)
    scores = impacts(tfs.to_numpy()[take].astype(np.int64), lengths[docs], n_docs, n_terms) * np.repeat(batch.weights[mine], size)
    lists = Lists(mine, own, docs, scores, *[np.zeros(0, dtype=np.int64)] * 4)
    present = np.zeros(len(batch.terms), dtype=bool)
    present[mine] = True
    pairs, together, joint = [], [], []
    for p in np.flatnonzero(present[batch.pairs].all(axis=1)).tolist():
        (a, sa), (b, sb) = (lists.list(int(t)) for t in batch.pairs[p])
        common, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
        if len(common):
            pairs.append(p)
            together.append(common)
            joint.append(int((sa[i] + sb[j]).max()))
    pair_ends = np.concatenate([[0], np.cumsum([len(x) for x in together])]).astype(np.int64)
    pair_places = np.concatenate([np.zeros(0, dtype=np.int64), *together])
    return Lists(mine, own, docs, scores, np.array(pairs, dtype=np.int64), pair_ends, pair_places, np.array(joint, dtype=np.int64))


def _unit_bound(lists: Lists, batch: Batch, unit: int) -> tuple[int, int]:
    """The most a document can get from a pair, and from one of its terms alone."""
    if unit < 0:
        one = lists.largest(-1 - unit)
        return one, one
    one = max(lists.largest(int(t)) for t in batch.pairs[unit])
    return max(one, lists.both(unit)[1]), one


_STORED = ("terms", "ends", "places", "scores", "pairs", "pair_ends", "pair_places", "joint")
_LISTS = "block long, ids array<long>, bounds array<long>, " + ", ".join(f"{c} array<long>" for c in _STORED)


def _batch_lists(index: DataFrame, batch: Batch, n_docs: int, n_terms: int, scratch: Scratch) -> DataFrame:
    """The written lists, intersection lists and bounds of a batch, by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i in range(rows.num_rows):
                row = {c: rows.column(k)[i] for k, c in enumerate(rows.schema.names)}
                lists = _lists_of(row, batch, n_docs, n_terms)
                bounds = [sum(_unit_bound(lists, batch, int(u))[0] for u in units) for units in batch.units]
                arrays = [row["ids"].values, pa.array(bounds, pa.int64()), *(pa.array(getattr(lists, c), pa.int64()) for c in _STORED)]
                columns = [pa.array([row["block"].as_py()], pa.int64()), *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in arrays)]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _LISTS.split(", ")])

    return scratch.keep(index.select("block", "ids", "lengths", "terms", "counts", "places", "tfs").mapInArrow(run, _LISTS), wide=True)


# ------------------------------------------------------------------ search
def search_block(lists: Lists, batch: Batch, units: np.ndarray, n_docs: int, threshold: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and scores of all documents of the block whose score is above 0
    and not below the threshold, and the number of documents scored."""
    bounds = np.array([_unit_bound(lists, batch, int(u)) for u in units], dtype=np.int64).reshape(-1, 2)
    order = np.lexsort((units, bounds[:, 0]))
    units, bounds = units[order], bounds[order]
    total = np.cumsum(bounds[:, 0])
    first = int(np.searchsorted(total, max(threshold, 1)))  # the pairs before it cannot make a result
    score = np.zeros(n_docs, dtype=np.int64)

    def add(unit: int) -> None:
        for t in (-1 - unit,) if unit < 0 else batch.pairs[unit].tolist():
            places, scores = lists.list(t)
            score[places] += scores

    for unit in units[first:].tolist():
        add(unit)
    left = np.flatnonzero(score)
    scored = len(left)
    for u in range(first - 1, -1, -1):
        left = left[score[left] + total[u] >= threshold]
        unit, (joint, one) = int(units[u]), bounds[u]
        if unit >= 0 and joint > one and len(left):
            within = np.zeros(n_docs, dtype=bool)
            within[lists.both(unit)[0]] = True
            left = left[score[left] + total[u] - np.where(within[left], 0, joint - one) >= threshold]
        if not len(left):
            break
        add(unit)
    left = left[score[left] >= max(threshold, 1)]
    return left, score[left], scored


def _best(scores: np.ndarray, ids: np.ndarray, null: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, null, -scores))[:k]


def _search(lists: DataFrame, batch: Batch, thresholds: np.ndarray, k: int, only: dict[int, list[int]] | None = None) -> DataFrame:
    """``item, doc_id, score, scored``: each task's best documents of each query.
    ``only`` names the queries to ask of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, best, scored = thresholds.copy(), {}, np.zeros(len(batch.items), dtype=np.int64)
        for rows in batches:
            for i in range(rows.num_rows):
                row = {c: rows.column(n)[i] for n, c in enumerate(rows.schema.names)}
                ids = row["ids"].values
                null = ids.is_null().to_numpy(zero_copy_only=False)
                ids, bounds = ids.fill_null(_NO_ID).to_numpy(), row["bounds"].values.to_numpy()
                asked = np.flatnonzero(bounds >= np.maximum(level, 1))
                if only is not None:
                    asked = np.intersect1d(asked, only[row["block"].as_py()])
                if not len(asked):
                    continue
                one = Lists(*(row[c].values.to_numpy() for c in _STORED))
                for q in asked.tolist():
                    at, score, n = search_block(one, batch, batch.units[q], len(ids), int(level[q]))
                    scored[q] += n
                    if len(at):
                        old = best.get(q, (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)))
                        new = [np.concatenate(x) for x in zip(old, (score, ids[at], null[at]))]
                        top = _best(*new, k)
                        best[q] = tuple(x[top] for x in new)
                        if len(top) == k:
                            level[q] = max(level[q], best[q][0][-1])
        for q, (score, ids, null) in best.items():
            columns = [pa.array(np.full(len(score), batch.items[q])), pa.array(ids, mask=null), pa.array(score), pa.array(np.full(len(score), scored[q]))]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score", "scored"])

    return lists.mapInArrow(run, "item long, doc_id long, score long, scored long")


def _first_thresholds(lists: DataFrame, batch: Batch, k: int) -> np.ndarray:
    """For each query its k-th best score in the block with the largest bound:
    no more than the k-th best of all."""
    bounds = lists.select("block", F.posexplode("bounds").alias("q", "bound")).where("bound > 0")
    top = bounds.groupBy("q").agg(F.max(F.struct("bound", "block")).alias("m")).collect()  # one row per query
    only: dict[int, list[int]] = {}
    for r in top:
        only.setdefault(r["m"]["block"], []).append(r["q"])
    levels = np.zeros(len(batch.items), dtype=np.int64)
    number = {int(item): q for q, item in enumerate(batch.items)}
    found = _search(lists.where(F.col("block").isin(list(only))), batch, levels, k, only)
    for r in found.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).collect():
        levels[number[r["item"]]] = r["least"]
    return levels


def search(docs: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score`` of each query's ``k`` best documents."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    pieces = F.array_distinct(F.regexp_extract_all(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)")))
    items = scratch.keep(queries.where("text is not null").select(F.monotonically_increasing_id().alias("item"), "item_id", pieces.alias("terms")))
    index = build_index(docs, scratch)
    n_docs, n_terms = index.agg(F.sum("n_filled"), F.sum("n_terms")).first()
    out = spark.createDataFrame([], "item long, doc_id long, score long")
    for batch in _batches(items.select("item", "terms")) if n_docs else ():
        with wide_rows(spark):
            batch.weigh(_document_frequencies(index, batch), n_docs)
            lists = _batch_lists(index, batch, n_docs, n_terms, scratch)
            found = scratch.keep(_search(lists, batch, _first_thresholds(lists, batch, k), k).drop("scored"))
        scratch.drop(lists)
        out = out.unionByName(found)
    scratch.drop(index)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(items.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
