"""Toxicity scores from the nearest labelled examples.

A document is a TF-IDF vector over the words and word beginnings that tell the
two labels apart (by a likelihood-ratio test on the examples; beginnings catch
inflected and compound forms). Inverse document frequencies count all
documents. One more term counts all other words of a text, so that a single
chance term in a long text weighs less than several in a short one. Its ``K`` nearest examples by cosine come from a block-max inverted
index: postings of a term are cut into blocks of examples, each with the
largest weight in the block, so the sum of query weight times block maximum
bounds the cosine of every example of the block. Blocks are evaluated in the
order of their bounds and the search ends when the next bound is below the
k-th cosine found: the result is exact, ties go to the smaller id.

Neighbours vote with their squared cosine against a prior of the label's
share; a logistic curve fitted on leave-one-out votes of the examples turns
the vote into a probability. The neighbours are returned as evidence.

Examples are a bounded sample (``MAX_EXAMPLES`` labelled rows, by the hash of
their id), and so are the terms (``MAX_TERMS``): the index has a fixed size
bound and is sent to every task. All documents are counted and scored, one
pass each, without a shuffle of texts.

Defined results: null and empty texts have no terms and get the score of the
prior; without labelled rows every score is 0.5; several labels of one id
count as toxic if one is; repeated rows are scored each; only the named
columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.llm.common import Scratch

MAX_EXAMPLES = 12_000
MAX_TERMS = 4096
K = 15
BLOCK = 64
EVIDENCE = 5
PRIOR_WEIGHT = 0.25
#: Lengths of the word beginnings; a beginning is written with a star.
BEGINNINGS = (4, 5, 6, 7, 8)
MIN_DOCUMENTS = 4
#: A chosen term's share of toxic examples is at least this many times that of the others.
MORE = 5
#: Weight of the term that stands for all other words of a text with chosen terms.
OTHER_WEIGHT = 1.5
THRESHOLD = 0.7
CHUNK_ROWS = 512
#: Bounds of what a task remembers: terms of words, scores of equal term counts.
CACHE_WORDS = 200_000
CACHE_SCORES = 4_000
_WORD = re.compile(r"\w+")
_SLACK = 1e-9


def word_terms(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


class _Terms(dict):
    """Numbers of the chosen terms of each word seen."""

    def __init__(self, numbers: dict[str, int]):
        super().__init__()
        self.numbers = numbers

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = found = tuple(self.numbers[t] for t in word_terms(word) if t in self.numbers)
        return found


def term_counts(text: str | None, terms: _Terms) -> dict[int, int]:
    out: dict[int, int] = {}
    words = _WORD.findall(text.lower()) if text else []
    for word, n in Counter(words).items():
        for t in terms[word]:
            out[t] = out.get(t, 0) + n
    if out:
        out[len(terms.numbers)] = len(words)
    return out


class BlockMaxIndex:
    """Exact top-k cosine over sparse vectors in blocks."""

    def __init__(self, ids: list[int], labels: list[int], vectors: list[dict[int, float]], n_terms: int):
        lead = [max(v.items(), key=lambda x: (x[1], x[0]))[0] if v else -1 for v in vectors]
        order = sorted((i for i, v in enumerate(vectors) if v), key=lambda i: (lead[i], labels[i], ids[i]))
        self.ids = np.array([ids[i] for i in order], dtype=np.int64)
        self.labels = np.array([labels[i] for i in order], dtype=np.int64)
        self.blocks = -(-len(order) // BLOCK)
        by_term: list[list[tuple[int, float]]] = [[] for _ in range(n_terms)]
        self.maxima = np.zeros((n_terms, self.blocks))
        for at, i in enumerate(order):
            for t, w in vectors[i].items():
                by_term[t].append((at, w))
                self.maxima[t, at // BLOCK] = max(self.maxima[t, at // BLOCK], w)
        self.at = [np.array([a for a, _ in p], dtype=np.int64) for p in by_term]
        self.weights = [np.array([w for _, w in p]) for p in by_term]
        edges = np.arange(self.blocks + 1) * BLOCK
        self.cuts = [np.searchsorted(a, edges) for a in self.at]

    def nearest(self, query: dict[int, float], k: int, without: int | None = None) -> list[tuple[float, int, int]]:
        """``(cosine, id, label)`` of the k nearest with a cosine above 0."""
        if not query or not self.blocks:
            return []
        terms = sorted(query)
        bounds = np.zeros(self.blocks)
        for t in terms:
            bounds += query[t] * self.maxima[t]
        best: list[tuple[float, int, int]] = []
        for b in np.argsort(-bounds, kind="stable").tolist():
            if bounds[b] <= 0 or len(best) == k and bounds[b] < -best[-1][0] - _SLACK:
                break
            scores = np.zeros(BLOCK)
            for t in terms:
                s, e = self.cuts[t][b], self.cuts[t][b + 1]
                if e > s:
                    scores[self.at[t][s:e] - b * BLOCK] += query[t] * self.weights[t][s:e]
            for i in np.flatnonzero(scores > 0).tolist():
                at = b * BLOCK + i
                if self.ids[at] != without:
                    best.append((-round(float(scores[i]), 12), int(self.ids[at]), int(self.labels[at])))
            best = sorted(best)[:k]
        return [(-s, i, y) for s, i, y in best]


class Model:
    """Terms, weights, index and calibration; small enough for every task."""

    def __init__(self, terms: list[str], idf: list[float], examples: list[tuple[int, int, dict[int, int]]]):
        self.numbers = {t: i for i, t in enumerate(terms)}
        self.idf = [*idf, OTHER_WEIGHT]
        vectors = [self.vector(c) for _, _, c in examples]
        labels = [y for _, y, _ in examples]
        self.index = BlockMaxIndex([i for i, _, _ in examples], labels, vectors, len(self.idf))
        toxic = sum(labels)
        self.prior = (toxic + 0.5) / (len(labels) + 1)
        self.a, self.b = 1.0, 0.0
        self.seen: dict = {}
        if 0 < toxic < len(labels):
            votes = [self.vote(self.index.nearest(v, K, without=i)) for (i, _, _), v in zip(examples, vectors)]
            self.a, self.b = _platt(np.array([_logit(v) for v in votes]), np.array(labels))

    def vector(self, counts: dict[int, int]) -> dict[int, float]:
        v = {t: (1 + math.log(n)) * self.idf[t] for t, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in v.values()))
        return {t: w / norm for t, w in v.items()} if norm else {}

    def vote(self, near: list[tuple[float, int, int]]) -> float:
        toxic = sum(s * s for s, _, y in near if y)
        return (toxic + PRIOR_WEIGHT * self.prior) / (sum(s * s for s, _, _ in near) + PRIOR_WEIGHT)

    def score(self, counts: dict[int, int]) -> tuple[float, list[tuple[float, int, int]]]:
        key = frozenset(counts.items())
        if key not in self.seen:
            if len(self.seen) >= CACHE_SCORES:
                self.seen.clear()
            near = self.index.nearest(self.vector(counts), K)
            self.seen[key] = 1 / (1 + math.exp(-(self.a * _logit(self.vote(near)) + self.b))), near[:EVIDENCE]
        return self.seen[key]


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def _platt(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """A logistic curve with smoothed targets (Platt, 1999), by Newton steps."""
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * x + b)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - target) * x).sum() + 1e-3 * a, (p - target).sum()])
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum()]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5 / (np.abs(step).max() + 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def _map(df: DataFrame, fn, schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def _examples(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """The sample ``(doc_id, toxic, text)``; the labels are cut to the bound before the join."""
    known = (
        labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_EXAMPLES)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most MAX_EXAMPLES rows
    return scratch.keep(texts.groupBy("doc_id").agg(F.min(F.struct("toxic", "text")).alias("x")).select("doc_id", "x.*"))


def _chosen_terms(examples: DataFrame) -> list[str]:
    """Terms more frequent in toxic examples than chance explains."""
    totals = {r[0]: r[1] for r in examples.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[y].update({t for w in set(_WORD.findall((text or "").lower())) for t in word_terms(w)})
            terms = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_pydict(
                {"term": pa.array(terms, pa.string()), "toxic": pa.array([counts[1][t] for t in terms], pa.int64()), "clean": pa.array([counts[0][t] for t in terms], pa.int64())}
            )

    counted = (
        _map(examples.select("toxic", "text"), run, "term string, toxic long, clean long")
        .groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
        .where(F.col("a") + F.col("b") >= MIN_DOCUMENTS)
    )
    share = F.lit(n1 / (n1 + n0))

    def part(n: Column, expected: Column) -> Column:
        return F.when(n > 0, n * F.ln(n / expected)).otherwise(0.0)

    df = F.col("a") + F.col("b")
    # likelihood ratio of "the term is as frequent in both labels"
    ratio = 2 * (
        part(F.col("a"), df * share) + part(F.col("b"), df * (1 - share))
        + part(n1 - F.col("a"), (n1 + n0 - df) * share) + part(n0 - F.col("b"), (n1 + n0 - df) * (1 - share))
    )
    tested = counted.withColumn("ratio", ratio).withColumn("tests", F.count(F.lit(1)).over(_whole()))
    more = F.col("a") * n0 > MORE * F.col("b") * n1
    # the bound grows with the number of tests, so that chance passes few of them
    passed = tested.where(more & (F.col("ratio") > 2 * F.ln("tests")))
    return [r[0] for r in passed.orderBy(F.desc("ratio"), "term").limit(MAX_TERMS).select("term").collect()]


def _whole():
    from pyspark.sql.window import Window

    return Window.partitionBy()


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Examples, terms, document frequencies over all documents, index."""
    scratch = Scratch(docs.sparkSession)
    examples = _examples(docs, labels, scratch)
    names = _chosen_terms(examples)
    numbers = {t: i for i, t in enumerate(names)}

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, found = _Terms(numbers), np.zeros(len(numbers) + 2, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                for text in batch.column(0).slice(at, CHUNK_ROWS).to_pylist():
                    found[list(term_counts(text, terms))] += 1
                    found[-1] += 1  # all documents
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"term": pa.array(some, pa.int64()), "n": pa.array(found[some], pa.int64())})

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _Terms(numbers)
        for batch in batches:
            found = [term_counts(t, terms) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([[*c] for c in found], pa.list_(pa.int64())), pa.array([[*c.values()] for c in found], pa.list_(pa.int64()))],
                names=["doc_id", "toxic", "terms", "counts"],
            )

    df = dict.fromkeys(range(len(names) + 2), 0)
    if names:
        seen = _map(docs.select("text"), frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        df.update({r[0]: r[1] for r in seen.collect()})  # a row per chosen term
    idf = [math.log(1 + df[len(names) + 1] / max(1, df[t])) for t in range(len(names))]
    rows = _map(examples.select("doc_id", "toxic", "text"), counts, "doc_id long, toxic int, terms array<long>, counts array<long>").collect()
    scratch.drop(examples)
    return Model(names, idf, sorted((r[0], r[1], dict(zip(r[2], r[3]))) for r in rows))


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``score`` and ``neighbours`` (similarity, doc_id, toxic)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_EXAMPLES and MAX_TERMS
    evidence = "array<struct<similarity:double,doc_id:bigint,toxic:int>>"
    fields = [docs.schema[c] for c in keep] + [T.StructField("score", T.DoubleType()), T.StructField("neighbours", T._parse_datatype_string(evidence))]
    kept = "text" in keep  # then it is sent once
    place = keep.index("text") if kept else len(keep)
    kind = pa.list_(pa.struct([("similarity", pa.float64()), ("doc_id", pa.int64()), ("toxic", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        terms = _Terms(model.numbers)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                found = [model.score(term_counts(t, terms)) for t in part.column(place).to_pylist()]
                near = [[{"similarity": s, "doc_id": i, "toxic": y} for s, i, y in n] for _, n in found]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(keep))), pa.array([s for s, _ in found], pa.float64()), pa.array(near, kind)],
                    names=[f.name for f in fields],
                )

    return docs.select(*keep, *([] if kept else [F.col("text").alias("scored_text")])).mapInArrow(run, T.StructType(fields))
