"""What each filter of a chain takes, in every order of the filters.

A document passes or fails each of five filters. Counts per part and per
combination of failures make one tensor of shape 2 x 2 x 2 x 2 x 2 for each
part (index 1: fails), one for all documents, one for those of good quality and
one for toxic ones. Every question about a chain is then a contraction of that
tensor with one selector along each axis: ``PASS``, ``FAIL`` or ``ALL``. For a
filter at some step of an order, *removed* selects pass for the filters before
it, fail for itself and all for those after it; *kept* selects pass up to and
including it; *unique_fails* selects fail for it and pass for all others.

The counts are a distributed aggregation: combinations are summed in the tasks
first, so a part with a third of all rows is 32 rows per task in the shuffle,
and a part's tensor never has more than 32 entries.

The filters on single texts are DataFrame expressions; the filter of copies
compares a document's id with the smallest id of equal texts (by SHA-256), found
by an aggregation and joined back; that side gets an exchange of its own, so
adaptive execution can split a text that a third of all rows hold.

Defined results: a null text is an empty one (0 words: fails A, passes B, C and
D, and is a copy of other empty texts); a null part is the empty string; rows
with a null id have no label, are copies of nothing and make nothing a copy;
rows with equal ids and equal texts are no copies of each other; several labels
of one id are joined by *or*; very long texts are read whole; an empty table
gives no rows; only ``doc_id``, ``text`` and ``source`` (labels: ``doc_id``,
``quality``, ``toxic``) are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.common import Scratch, own_exchange

#: The filters, in the order of the tensor's axes and of the bits of a cell.
FILTERS = "ABCDE"
MEASURES = ("n", "good", "toxic")
WORD = r"([^\x20\x09-\x0D]+)"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Selectors along an axis of (passes, fails).
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)


def text_failures(text: Column) -> list[Column]:
    """Filters A to D of one text, true where it fails: short, repetitive,
    too many capitals, holds a marked character."""
    words = F.regexp_extract_all(text, F.lit(WORD))
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return [
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * capitals.cast("long") > 2 * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    ]


def _bits(fails: Sequence[Column]) -> Column:
    total = F.lit(0)
    for i, fail in enumerate(fails):
        total = total + F.when(fail, 1 << i).otherwise(0)
    return total


def failures(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``part`` and ``cell``, whose bit i says that filter i fails."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"),
        _bits(text_failures(text)).alias("own"), F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    # texts are read once; what follows shuffles these narrow rows only
    rows = Scratch(docs.sparkSession).keep(rows)
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"))
    first = first.select(F.concat("digest", F.lit(b"")).alias("digest"), "first")  # an exchange of its own
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return rows.join(first, "digest").select("doc_id", "part", (F.col("own") + F.when(copy, 1 << 4).otherwise(0)).alias("cell"))


def cell_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, cell`` and the documents of each measure."""
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.coalesce("quality", F.lit(0)) == 1).cast("int")).alias("good"), F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int")).alias("toxic")
    )
    marks = marks.where("doc_id is not null").select(own_exchange("doc_id").alias("doc_id"), "good", "toxic")
    counts = [F.count(F.lit(1)).alias("n"), *(F.sum(F.coalesce(F.col(m), F.lit(0))).cast("long").alias(m) for m in MEASURES[1:])]
    return rows.join(marks, "doc_id", "left").groupBy("part", "cell").agg(*counts)


class Chains:
    """Selectors of every filter at every step of every order."""

    def __init__(self, filters: str = FILTERS):
        k = len(filters)
        self.k = k
        orders = list(permutations(range(k)))
        self.order = np.repeat(["".join(filters[i] for i in o) for o in orders], k)
        self.step = np.tile(np.arange(1, k + 1), len(orders))
        self.at = np.array(orders).reshape(-1)  # the axis of each row's filter
        self.removed, self.kept = (np.full((len(self.at), k, 2), ALL, dtype=np.int64) for _ in range(2))
        self.failing, self.unique = np.full((k, k, 2), ALL, dtype=np.int64), np.full((k, k, 2), PASS, dtype=np.int64)
        for r, (order, step) in enumerate((o, s) for o in orders for s in range(k)):
            self.removed[r, order[:step]] = PASS
            self.removed[r, order[step]] = FAIL
            self.kept[r, order[: step + 1]] = PASS
        for i in range(k):
            self.failing[i, i] = self.unique[i, i] = FAIL

    def contract(self, tensor: np.ndarray, selectors: np.ndarray) -> np.ndarray:
        """Sums over the selected entries; ``tensor`` is (part, measure, 2, ...)
        and the result (selector row, part, measure)."""
        axes = [2 + i for i in range(self.k)]
        row = 2 + self.k
        pairs = [x for i in range(self.k) for x in (selectors[:, i], [row, axes[i]])]
        return np.einsum(tensor, [0, 1, *axes], *pairs, [row, 0, 1], optimize="greedy")

    def audit(self, parts: list[str], tensor: np.ndarray) -> pd.DataFrame:
        removed, kept = self.contract(tensor, self.removed), self.contract(tensor[:, :1], self.kept)[:, :, 0]
        failing, unique = (self.contract(tensor[:, :1], s)[self.at, :, 0] for s in (self.failing, self.unique))
        shapley = np.zeros((self.k, len(parts)), dtype=np.int64)
        np.add.at(shapley, self.at, removed[:, :, 0])
        n = len(self.at)
        columns = {
            "kept": kept, "removed": removed[:, :, 0], "redundant": failing - removed[:, :, 0], "unique_fails": unique,
            "good_lost": removed[:, :, 1], "toxic_lost": removed[:, :, 2], "shapley": shapley[self.at],
        }
        return pd.DataFrame(
            {"part": np.repeat(np.array(parts, dtype=object), n), "filter_order": np.tile(self.order, len(parts)), "step": np.tile(self.step, len(parts)).astype(np.int32)}
            | {name: v.T.reshape(-1) for name, v in columns.items()}
        )


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """The audit of every part from its counts ``part, cell, n, good, toxic``."""
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("cell", *MEASURES)).alias("cells"))  # 32 at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chains = Chains(filters)
        k = len(filters)
        for rows in batches:
            for at in range(0, len(rows), 64):
                some = rows.iloc[at : at + 64]
                flat = np.zeros((len(some), len(MEASURES), 1 << k), dtype=np.int64)
                for p, part in enumerate(some["cells"]):
                    for cell in part:
                        flat[p, :, cell["cell"]] = [cell[m] for m in MEASURES]
                # bit i of a cell is axis i: the highest bit is the first axis of a reshaped array
                tensor = flat.reshape(len(some), len(MEASURES), *[2] * k).transpose(0, 1, *range(k + 1, 1, -1))
                yield chains.audit(some["part"].tolist(), tensor)

    return cells.mapInPandas(run, "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step; see the module's description."""
    return interactions(cell_counts(failures(docs), labels))
