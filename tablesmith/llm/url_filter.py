"""URL rules, and a character language-model ratio for the URLs without a rule.

URLs that a rule accepts or rejects train two smoothed variable-order Markov
models of characters: the probability of a character after a context of
``k`` characters is its count there, smoothed with the probability after
``k - 1`` characters. A URL's score is the difference of its log-likelihoods
under the two models divided by its length. The threshold is calibrated on
labelled URLs that were not counted: the score at which the two error rates
together are smallest. URLs above it are allowed.

All labelled URLs are counted: tasks count n-grams by hash, the counts are
summed by a shuffle and all of them stay in a table of the shared folder, which
grows with the URLs. To score, distinct URLs are dealt by hash into batches of
about ``BATCH_SYMBOLS`` symbols; each batch asks once for each n-gram it holds,
the requests are joined to the counts, and the batch is scored with what comes
back. A frequent n-gram is asked for once per batch, not once per URL, and the
join is one that adaptive execution can split.

Defined results: a null URL or one without ``://`` has empty host and path and
no rule; a null or empty URL has the score 0; without labelled URLs of both
kinds all scores are 0 and every URL without a rule is allowed; repeated rows
are judged each; an empty table gives an empty result; columns of the input
that are named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import Scratch

#: (verdict, host, beginning of the path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
ORDER = 5
BATCH_SYMBOLS = 32_768
SMOOTHING = 2.0
ALPHABET = 256
BINS = 50  # calibration bins per unit of the score
_START, _END = 0x110000, 0x110001
_M = np.uint64(0x9E3779B97F4A7C15)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, domain, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(start)
        rule, verdict = F.when(fits, domain + start).otherwise(rule), F.when(fits, action).otherwise(verdict)
    return rule, verdict


# ---------------------------------------------------------------- the model
def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _symbols(urls: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat code points with start and end marks, the place in the URL and its number."""
    lengths = np.array([len(u or "") + 2 for u in urls], dtype=np.int64)
    flat = np.full(int(lengths.sum()), _START, dtype=np.uint64)
    ends = np.cumsum(lengths)
    flat[ends - 1] = _END
    place = np.arange(len(flat)) - np.repeat(ends - lengths, lengths)
    inner = (place > 0) & (np.arange(len(flat)) != np.repeat(ends - 1, lengths))
    flat[inner] = np.frombuffer("".join(u or "" for u in urls).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return flat, place, np.repeat(np.arange(len(urls)), lengths)


def _grams(flat: np.ndarray) -> list[np.ndarray]:
    """Hashes of the n-grams of 1 to ORDER + 1 symbols that end at each place."""
    out = [_mix(flat + _M)]
    for n in range(2, ORDER + 2):
        before = np.concatenate([out[-1][:1], out[-1][:-1]])
        out.append(_mix(before * _M + flat + np.uint64(n)))
    return out


def _count(urls: DataFrame) -> DataFrame:
    """``gram, accepted, rejected`` from rows ``(url, accepted)``; the gram 0 counts symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, place, owner = _symbols(batch.column(0).to_pylist())
            good = np.array(batch.column(1).to_pylist(), dtype=np.int64)[owner] if len(flat) else np.zeros(0, dtype=np.int64)
            grams, kinds = [np.zeros(int((place > 0).sum()), dtype=np.uint64)], [good[place > 0]]
            for n, h in enumerate(_grams(flat), 1):
                whole = place >= n - 1
                grams.append(h[whole])
                kinds.append(good[whole])
            names, inverse = np.unique(np.concatenate(grams), return_inverse=True)
            accepted = np.bincount(inverse, weights=np.concatenate(kinds), minlength=len(names)).astype(np.int64)
            total = np.bincount(inverse, minlength=len(names))
            yield pa.RecordBatch.from_pydict({"gram": names.view(np.int64), "accepted": accepted, "rejected": total - accepted})

    counted = urls.mapInArrow(run, "gram long, accepted long, rejected long")
    return counted.groupBy("gram").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))


class Counts:
    """The counts of some n-grams; those that are not there are 0."""

    def __init__(self, grams: np.ndarray, accepted: np.ndarray, rejected: np.ndarray):
        order = np.argsort(grams.view(np.uint64))
        self.grams = grams.view(np.uint64)[order]
        self.counts = np.stack([accepted[order], rejected[order]]).astype(np.float64)

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.grams):
            return np.zeros((2, len(hashes)))
        at = np.minimum(np.searchsorted(self.grams, hashes), len(self.grams) - 1)
        return self.counts[:, at] * (self.grams[at] == hashes)

    def scores(self, urls: list[str | None]) -> np.ndarray:
        """Log-likelihood difference per symbol; 0 for empty URLs."""
        total = self.lookup(np.zeros(1, dtype=np.uint64))
        if not urls or not total.all():
            return np.zeros(len(urls))
        flat, place, owner = _symbols(urls)
        grams = _grams(flat)
        p = (self.lookup(grams[0]) + 0.5) / (total + 0.5 * ALPHABET)
        for n in range(1, ORDER + 1):
            context = np.concatenate([grams[n - 1][:1], grams[n - 1][:-1]])
            seen = self.lookup(context) * (place >= n)
            p = (self.lookup(grams[n]) * (place >= n) + SMOOTHING * p) / (seen + SMOOTHING)
        ratio = np.log(p[0] / p[1]) * (place > 0)
        lengths = np.bincount(owner, minlength=len(urls))
        out = np.bincount(owner, weights=ratio, minlength=len(urls)) / (lengths - 1)
        return np.where(lengths == 2, 0.0, out)


def _asked(urls: list[str | None]) -> np.ndarray:
    """The n-grams that ``Counts.scores`` looks up, and the gram 0."""
    flat, place, _ = _symbols(urls)
    return np.unique(np.concatenate([np.zeros(1, dtype=np.uint64), *(h[place >= n] for n, h in enumerate(_grams(flat)))]))


class UrlModel:
    """All counts, as a table ``gram, accepted, rejected`` of the shared folder."""

    def __init__(self, counts: DataFrame):
        self.counts = counts

    def _counts(self, hashes: np.ndarray) -> Counts:
        spark = self.counts.sparkSession
        asked = spark.createDataFrame(pa.table({"gram": np.unique(hashes).view(np.int64)}))
        rows = self.counts.join(asked, "gram").toPandas()  # of the given n-grams only
        return Counts(rows["gram"].to_numpy(np.int64), rows["accepted"].to_numpy(np.int64), rows["rejected"].to_numpy(np.int64))

    def _lookup(self, hashes: np.ndarray) -> np.ndarray:
        return self._counts(hashes).lookup(hashes)

    def scores(self, urls: list[str | None]) -> np.ndarray:
        """Of a few URLs, on the driver; ``score_urls`` is for tables."""
        return self._counts(_asked(urls)).scores(urls)


def fit(labelled: DataFrame) -> UrlModel:
    """From rows ``(url, accepted 0 or 1)``."""
    return UrlModel(Scratch(labelled.sparkSession).keep(_count(labelled)))


def score_urls(urls: DataFrame, model: UrlModel) -> DataFrame:
    """``url, url_score`` of the distinct URLs of the column ``url`` that are not empty."""
    scratch = Scratch(urls.sparkSession)
    once = scratch.keep(urls.where("length(url) > 0").select("url").distinct())
    symbols = once.agg(F.sum(F.length("url") + 2)).first()[0] or 0
    batches = max(1, -(-symbols // BATCH_SYMBOLS))
    dealt = once.select(F.pmod(F.xxhash64("url"), F.lit(batches)).alias("batch"), "url")

    def ask(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        grams = _asked(rows.column("url").to_pylist()).view(np.int64)
        return pa.table({"batch": np.full(len(grams), key[0].as_py(), dtype=np.int64), "gram": grams})

    def answer(_: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        texts = rows.column("url").drop_null()
        found = rows.filter(rows.column("gram").is_valid())
        counts = Counts(*(found.column(c).to_numpy() for c in ("gram", "accepted", "rejected")))
        return pa.table({"url": texts, "url_score": pa.array(counts.scores(texts.to_pylist()), pa.float64())})

    asked = dealt.groupBy("batch").applyInArrow(ask, "batch long, gram long")
    found = asked.join(model.counts, "gram").select("batch", F.lit(None).cast("string").alias("url"), "gram", "accepted", "rejected")
    nothing = [F.lit(None).cast("long").alias(c) for c in ("gram", "accepted", "rejected")]
    both = found.unionByName(dealt.select("batch", "url", *nothing))
    scored = scratch.keep(both.groupBy("batch").applyInArrow(answer, "url string, url_score double"))
    scratch.drop(once)
    return scored


def add_score(df: DataFrame, model: UrlModel) -> DataFrame:
    """All columns of ``df`` and ``url_score`` from the column ``url``."""
    return _with_score(df, score_urls(df, model))


def _with_score(df: DataFrame, scored: DataFrame) -> DataFrame:
    df = df.drop("url_score")
    scored = scored.select(F.col("url").alias("url_scored"), F.col("url_score").alias("score_of_url"))
    joined = df.join(scored, F.col("url") == F.col("url_scored"), "left")
    return joined.select(*(df[c] for c in df.columns), F.coalesce("score_of_url", F.lit(0.0)).alias("url_score"))


def threshold(scored: DataFrame) -> float:
    """From rows ``(url_score, accepted)``: the smallest sum of both error rates."""
    binned = scored.groupBy(F.greatest(F.lit(-500), F.least(F.lit(500), F.floor(F.col("url_score") * BINS))).alias("bin")).agg(
        F.sum("accepted").alias("good"), F.count(F.lit(1)).alias("n")
    )
    rows = sorted((r["bin"], r["good"], r["n"] - r["good"]) for r in binned.collect())  # at most 1001
    good, bad = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not good or not bad:
        return 0.0
    best, at, low, high = 2.0, 0.0, 0, bad
    for b, g, w in rows:
        if low / good + high / bad < best - 1e-12 or (abs(low / good + high / bad - best) <= 1e-12 and abs(b) < abs(at * BINS)):
            best, at = low / good + high / bad, b / BINS
        low, high = low + g, high - w
    return at


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """All columns of ``pages`` and ``host``, ``path``, ``rule``, ``verdict``, ``url_score``."""
    placed = pages.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    rule, action = fitting_rule(F.col("host"), F.col("path"), rules)
    placed = placed.withColumn("rule", rule).withColumn("ruled", action)
    labelled = placed.where("ruled is not null and length(url) > 0").select("url", (F.col("ruled") == "allow").cast("int").alias("accepted"))
    calibrates = F.crc32("url") % 5 == 0
    model = fit(labelled.where(~calibrates))
    scored = score_urls(placed, model)
    cut = threshold(_with_score(labelled.where(calibrates), scored))
    judged = F.coalesce("ruled", F.when(F.col("url_score") >= cut, "allow").otherwise("block"))
    return _with_score(placed, scored).withColumn("verdict", judged).drop("ruled")
