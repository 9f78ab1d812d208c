"""Quality scores by co-training two views of a document.

The *content* view sees the text only: hashed words with what trails them, and
shares of symbols, digits, repeated lines and the like. The *metadata* view
sees the other columns only (language, source, number of characters). Each has
a logistic classifier, first fitted on the labelled rows. In each round both
score all unlabelled documents that are not held out and hand the ones they are
surest of to the other view's training set as pseudo-labels; then both are
fitted on, also after the last round. At the end each view is calibrated on
labelled documents that neither was fitted on, and a logistic combination of
the two calibrated views scores all documents.

Only the labelled rows are a bounded sample (``MAX_LABELLED`` by the hash of
their id). The features of the unlabelled documents are kept in the shared
folder; what goes to the driver are histograms of how sure the views are, which
give the thresholds of a round, and gradients, both summed in Spark and of fixed
size. Where a threshold falls among equally sure documents, the hash of the id
decides. All documents are scored in one pass without a shuffle. Rows whose
crc32(doc_id) mod 3 is 1 are held out and never used in fitting.

Defined results: null texts have the features of the empty text; nulls in the
metadata are values of their own; without labelled rows of both kinds every
score is 0.5; several labels of one id count as good if all are; repeated rows
are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.llm.common import Scratch
from tablesmith.llm.toxicity import held_out

MAX_LABELLED = 6000
ROUNDS = 3
HANDED = 0.05  # share of the unlabelled documents that a view hands over in a round, about
SURE = 0.95
WORD_BUCKETS = 4096
META_BUCKETS = 512
THRESHOLD = 0.5
STEPS = 120
SHARED_STEPS = 6  # over the handed documents, in each round
BINS, BINS_PER_UNIT = 1000, 50  # of the log-odds from SURE on
CHUNK_ROWS = 512
CACHE_WORDS = 300_000
_TAIL = re.compile(r"[^\w\s]+$")
N_SHAPES = 9
CONTENT_SIZE = WORD_BUCKETS + N_SHAPES

Vector = tuple[np.ndarray, np.ndarray]


def _bucket(text: str, size: int) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) % size


class _Words(dict):
    """Buckets of a word: the word without what trails it, and that."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > CACHE_WORDS:
            self.clear()
        tail = _TAIL.search(word)
        stem = word[: tail.start()] if tail else word
        out = [_bucket(stem.lower(), WORD_BUCKETS)] if stem else []
        if tail and len(tail[0]) > 1:
            out.append(_bucket("tail " + tail[0][-3:], WORD_BUCKETS))
        self[word] = found = tuple(out)
        return found


def content_features(text: str | None, words: _Words) -> Vector:
    text = text or ""
    found = Counter(text.split())
    counts: dict[int, int] = {}
    for word, n in found.items():
        for b in words[word]:
            counts[b] = counts.get(b, 0) + n
    names = np.fromiter(counts, dtype=np.int64, count=len(counts))
    values = np.log1p(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)))
    values /= np.sqrt((values * values).sum()) or 1
    lines = [x for x in text.split("\n") if x.strip()]
    n, n_words = max(1, len(text)), max(1, sum(found.values()))
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    symbols = int(((data < 128) & ~_PLAIN[data]).sum())
    shapes = [
        symbols / n, int(((data >= 48) & (data < 58)).sum()) / n, len(found) / n_words, 1 - len(set(lines)) / max(1, len(lines)),
        min(2.0, n / n_words / 10), min(1.0, np.log1p(n_words) / 10), len(lines) / n_words, text.count("|") / n_words, max(found.values(), default=0) / n_words,
    ]
    return np.concatenate([names, WORD_BUCKETS + np.arange(N_SHAPES)]), np.concatenate([values, np.array(shapes)])


#: ASCII bytes that are letters, digits, white space or usual in sentences
_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789 \t\n\r.,;:!?'\"()-"]] = True


def metadata_features(lang: str | None, source: str | None, n_chars: int | None) -> Vector:
    size = "none" if n_chars is None else str(int(n_chars).bit_length())
    names = [f"lang {lang}", f"source {source}", f"size {size}", f"lang {lang} size {size}"]
    at = np.array(sorted({_bucket(x, META_BUCKETS) for x in names}), dtype=np.int64)
    return at, np.ones(len(at))


class Rows:
    """Sparse rows, flat."""

    def __init__(self, vectors: list[Vector], size: int):
        self.size = size
        lengths = np.array([len(v[0]) for v in vectors], dtype=np.int64)
        self.row = np.repeat(np.arange(len(vectors)), lengths)
        self.at = np.concatenate([v[0] for v in vectors]) if vectors else np.zeros(0, dtype=np.int64)
        self.value = np.concatenate([v[1] for v in vectors]) if vectors else np.zeros(0)
        self.n = len(vectors)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.at], minlength=self.n)

    def pull(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, self.value * r[self.row], minlength=self.size)


class Logistic:
    """Weights and, last, the offset; accelerated gradient steps with AdaGrad scaling."""

    def __init__(self, x: Rows, y: np.ndarray, penalty: float = 1e-4):
        self.x, self.y, self.penalty = x, y, penalty
        self.w, self.seen = np.zeros(x.size + 1), np.full(x.size + 1, 1e-6)
        for _ in range(STEPS):
            self.step(np.zeros(x.size + 1), 0)

    def step(self, more: np.ndarray, n: int) -> None:
        """``more``: the summed gradient of ``n`` rows besides the own ones."""
        g = (gradient(self.x, self.y, self.w) + more) / (self.x.n + n) + self.penalty * self.w * (np.arange(len(self.w)) < self.x.size)
        self.seen += g * g
        self.w = self.w - 0.5 * g / np.sqrt(self.seen)


def log_odds(x: Rows, w: np.ndarray) -> np.ndarray:
    return x.dot(w) + w[-1]


def gradient(x: Rows, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    r = 1 / (1 + np.exp(-log_odds(x, w))) - y
    return np.append(x.pull(r), r.sum())


# ------------------------------------------------------------- the exchange
#: Of a round: the weights of both views and, after ``cuts``, per view and
#: label the last bin that is handed over and which part of it.
Round = tuple[list[np.ndarray], list[tuple[int, float]]]
SIZES = (CONTENT_SIZE, META_BUCKETS)


def offers(views: list[Rows], spread: np.ndarray, rounds: list[Round]) -> tuple[np.ndarray, list[np.ndarray]]:
    """In the last of the rounds: the bin of each row by view and label (0 and
    1 of view 0, then of view 1), or -1 if it is not sure enough or was handed
    over earlier; and which rows are handed over."""
    free = np.ones(len(spread), dtype=bool)
    for weights, cut in rounds:
        bins, handed = [], []
        for v in (0, 1):
            z = log_odds(views[v], weights[v])
            for label in (0, 1):
                b = np.floor(((z if label else -z) - np.log(SURE / (1 - SURE))) * BINS_PER_UNIT)
                bins.append(np.where(free & (b >= 0), np.minimum(b, BINS - 1), -1).astype(np.int64))
        for b, (edge, part) in zip(bins, cut):
            handed.append((b > edge) | ((b == edge) & (b >= 0) & (spread < part)))
        for h in handed:
            free &= ~h
    return np.array(bins), handed


NO_CUTS = [(BINS, 0.0)] * 4


def cuts(histogram: np.ndarray, share: float, n: int) -> list[tuple[int, float]]:
    """From the numbers of rows by view and label and bin."""
    out = []
    for k, counts in enumerate(histogram):
        most = max(1, int(HANDED * (share if k % 2 else 1 - share) * n))
        above = np.cumsum(counts[::-1])[::-1]  # in this bin and the surer ones
        if above[0] <= most:
            out.append((-1, 0.0))
        else:
            edge = int(np.flatnonzero(above > most)[-1])
            out.append((edge, float(most - (above[edge] - counts[edge])) / float(counts[edge])))
    return out


def _histogram(bins: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(b[b >= 0], minlength=BINS) for b in bins])


class LocalPool:
    """Unlabelled documents in memory."""

    def __init__(self, rows: list[tuple[Vector, Vector]]):
        self.n = len(rows)
        self.rows = rows
        self.views = [Rows([r[v] for r in rows], SIZES[v]) for v in (0, 1)]
        self.spread = np.array([_bucket(str(i), 1 << 20) / (1 << 20) for i in range(len(rows))])
        self.known: list[list[tuple[Vector, int]]] = [[], []]

    def histogram(self, rounds: list[Round]) -> np.ndarray:
        return _histogram(offers(self.views, self.spread, rounds)[0])

    def hand(self, rounds: list[Round]) -> int:
        """Hands over what the last round chose; the number of rows."""
        handed = offers(self.views, self.spread, rounds)[1]
        for k, h in enumerate(handed):
            to = 1 - k // 2
            self.known[to] += [(self.rows[i][to], k % 2) for i in np.flatnonzero(h)]
        return int(sum(h.sum() for h in handed))

    def gradients(self, weights: list[np.ndarray]) -> list[tuple[np.ndarray, int]]:
        """Per view the gradient summed over all rows handed to it, and their number."""
        return [(gradient(Rows([x for x, _ in known], SIZES[v]), np.array([y for _, y in known], dtype=float), weights[v]), len(known)) for v, known in enumerate(self.known)]


class SharedPool:
    """The same over the table ``a, av, b, bv, spread`` of the shared folder."""

    def __init__(self, rows: DataFrame, scratch: Scratch):
        self.table, self.scratch = rows, scratch
        self.n = rows.count()
        self.known: DataFrame | None = None

    def histogram(self, rounds: list[Round]) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((4, BINS), dtype=np.int64)
            for views, spread, _ in _unpacked(batches):
                total += _histogram(offers(views, spread, rounds)[0])
            of, at = np.nonzero(total)
            yield pa.RecordBatch.from_pydict({"of": of, "at": at, "n": total[of, at]})

        out = np.zeros((4, BINS), dtype=np.int64)
        for r in self.table.mapInArrow(run, "of long, at long, n long").groupBy("of", "at").agg(F.sum("n").alias("n")).collect():  # at most 4 * BINS
            out[r["of"], r["at"]] = r["n"]
        return out

    def hand(self, rounds: list[Round]) -> int:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for views, spread, batch in _unpacked(batches):
                for k, h in enumerate(offers(views, spread, rounds)[1]):
                    part, to = batch.filter(pa.array(h)), 1 - k // 2
                    fixed = [pa.array(np.full(part.num_rows, x, dtype=np.int32)) for x in (to, k % 2)]
                    yield pa.RecordBatch.from_arrays([*fixed, part.column("ab"[to]), part.column("ab"[to] + "v")], names=["to", "label", "at", "value"])

        handed = self.scratch.keep(self.table.mapInArrow(run, "to int, label int, at binary, value binary"))
        self.known = handed if self.known is None else self.known.unionByName(handed)
        return handed.count()

    def gradients(self, weights: list[np.ndarray]) -> list[tuple[np.ndarray, int]]:
        """The place after the offset counts the rows."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = [np.zeros(n + 2) for n in SIZES]
            for batch in batches:
                to, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                for v in (0, 1):
                    mine = batch.filter(pa.array(to == v))
                    x = Rows(_vectors(mine.column(2), mine.column(3)), SIZES[v])
                    total[v] += np.append(gradient(x, y[to == v], weights[v]), x.n)
            for v in (0, 1):
                at = np.flatnonzero(total[v])
                yield pa.RecordBatch.from_pydict({"view": np.full(len(at), v), "at": at, "g": total[v][at]})

        out = [np.zeros(n + 2) for n in SIZES]
        if self.known is not None:
            # one row for each weight
            for r in self.known.mapInArrow(run, "view long, at long, g double").groupBy("view", "at").agg(F.sum("g").alias("g")).collect():
                out[r["view"]][r["at"]] = r["g"]
        return [(x[:-1], int(x[-1])) for x in out]


def fit_small(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression of a few dense columns and an offset, by Newton steps
    towards smoothed targets."""
    x = np.column_stack([x, np.ones(len(x))])
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (p - target) + 1e-2 * w)
        w -= step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
    return w


class Model:
    def __init__(self, labelled: list[tuple[Vector, Vector, int]], pool):
        """``pool``: the unlabelled documents, a list of both views or a ``SharedPool``."""
        self.fitted = False
        good = np.array([y for _, _, y in labelled])
        if not len(good) or good.min() == good.max():
            return
        pool = LocalPool(pool) if isinstance(pool, list) else pool
        # every fourth labelled row calibrates
        calibrates = np.arange(len(labelled)) % 4 == 3
        if len(set(good[calibrates].tolist())) < 2 or len(set(good[~calibrates].tolist())) < 2:
            calibrates[:] = False
        views = [[x[v] for x in labelled] for v in (0, 1)]
        learners = [Logistic(Rows([views[v][i] for i in np.flatnonzero(~calibrates)], SIZES[v]), good[~calibrates]) for v in (0, 1)]
        share = float(good.mean())
        rounds: list[Round] = []
        for _ in range(ROUNDS if pool.n else 0):
            weights = [x.w for x in learners]
            rounds.append((weights, cuts(pool.histogram([*rounds, (weights, NO_CUTS)]), share, pool.n)))
            if not pool.hand(rounds):
                break
            for _ in range(SHARED_STEPS):
                for learner, (g, n) in zip(learners, pool.gradients([x.w for x in learners])):
                    learner.step(g, n)
        self.weights = [x.w for x in learners]
        some = calibrates if calibrates.any() else ~calibrates
        y = good[some]
        z = [log_odds(Rows([views[v][i] for i in np.flatnonzero(some)], SIZES[v]), self.weights[v]) for v in (0, 1)]
        self.curves = [fit_small(z[v][:, None], y) for v in (0, 1)]
        calibrated = np.column_stack([self.curves[v][0] * z[v] + self.curves[v][1] for v in (0, 1)])
        self.mix = fit_small(calibrated, y)
        self.fitted = True

    def scores(self, views: tuple[list[Vector], list[Vector]]) -> np.ndarray:
        n = len(views[0])
        if not self.fitted or not n:
            return np.full(n, 0.5)
        out = np.full(n, self.mix[2])
        for v in (0, 1):
            z = log_odds(Rows(views[v], SIZES[v]), self.weights[v])
            out += self.mix[v] * (self.curves[v][0] * z + self.curves[v][1])
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _views(batch: pa.RecordBatch, words: _Words) -> tuple[list[Vector], list[Vector]]:
    """From the columns text, lang, source and n_chars, the last of the batch."""
    text, lang, source, n_chars = (c.to_pylist() for c in batch.columns[-4:])
    return [content_features(t, words) for t in text], [metadata_features(*x) for x in zip(lang, source, n_chars)]


def _vectors(at: pa.Array, value: pa.Array) -> list[Vector]:
    return [(np.frombuffer(a, dtype=np.int32).astype(np.int64), np.frombuffer(b, dtype=np.float32).astype(np.float64)) for a, b in zip(at.to_pylist(), value.to_pylist())]


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[Rows], np.ndarray, pa.RecordBatch]]:
    """Both views and ``spread`` of rows ``a, av, b, bv, spread``."""
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK_ROWS):
            part = batch.slice(at, CHUNK_ROWS)
            yield [Rows(_vectors(part.column(2 * v), part.column(2 * v + 1)), SIZES[v]) for v in (0, 1)], part.column(4).to_numpy(), part


def _featured(df: DataFrame) -> DataFrame:
    """Features, packed, of rows ``doc_id, good, text, lang, source, n_chars``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            content, meta = _views(batch, words)
            packed = [[a.astype(np.int32).tobytes() for a, _ in v] for v in (content, meta)]
            values = [[b.astype(np.float32).tobytes() for _, b in v] for v in (content, meta)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(x, pa.binary()) for x in (packed[0], values[0], packed[1], values[1]))],
                names=["doc_id", "good", "a", "av", "b", "bv"],
            )

    return df.mapInArrow(run, "doc_id long, good int, a binary, av binary, b binary, bv binary")


def _sampled(df: DataFrame) -> list[tuple[Vector, Vector, int | None]]:
    """Features of a bounded sample on the driver."""
    rows = _featured(df).collect()
    rows.sort(key=lambda r: (xxhash.xxh3_64_intdigest(str(r["doc_id"])), r["a"], r["av"], r["b"]))
    (a, av, b, bv), good = ([[r[c] for r in rows] for c in ("a", "av", "b", "bv")], [r["good"] for r in rows])
    return list(zip(_vectors(pa.array(a, pa.binary()), pa.array(av, pa.binary())), _vectors(pa.array(b, pa.binary()), pa.array(bv, pa.binary())), good))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    by_hash = (F.xxhash64("doc_id"), F.col("doc_id"))
    known = (
        labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("good")).orderBy(*by_hash).limit(MAX_LABELLED)
    )
    columns = ["text", "lang", "source", "n_chars"]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *columns)
    # the sample is bounded before it meets the texts; repeated ids are left to one row
    labelled = docs.join(F.broadcast(known), "doc_id").groupBy("doc_id", "good").agg(F.min(F.struct(*columns)).alias("x"))
    first = _sampled(labelled.select("doc_id", "good", "x.*"))
    if len({y for _, _, y in first}) < 2:
        return Model([], [])
    # features are smaller than texts, so they are what is shuffled
    scratch = Scratch(docs.sparkSession)
    fits = docs.where("doc_id is not null").where(~held_out(F.col("doc_id")))
    featured = _featured(fits.select("doc_id", F.lit(None).cast("int").alias("good"), *columns))
    once = featured.groupBy("doc_id").agg(F.min(F.struct("a", "av", "b", "bv")).alias("x"))
    unlabelled = once.join(labels.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null"), "doc_id", "left_anti")
    spread = (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))).alias("spread")
    return Model(first, SharedPool(scratch.keep(unlabelled.select("x.*", spread)), scratch))


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``score``: how likely the document is good."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two weight vectors of fixed size
    fields = [docs.schema[c] for c in keep] + [T.StructField("score", T.DoubleType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                scores = shared.value.scores(_views(part, words))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), pa.array(scores, pa.float64())], names=[f.name for f in fields])

    view = [F.col(c).alias(f"view_{c}") for c in ("text", "lang", "source", "n_chars")]
    return docs.select(*keep, *view).mapInArrow(run, T.StructType(fields))
