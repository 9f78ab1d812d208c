"""Mixing sources to target weights by a time-varying curriculum.

Training runs over the time 0..1. Each source has a *schedule*: its weight as
a piecewise linear function of time, given as knots ``(time, weight)``. The
integral of the schedule up to ``t``, scaled so that it reaches the source's
token target at the end, is the number of tokens the source has delivered by
``t``. Inverting this cumulative demand at the token offset of a document
gives the document's training position. Documents of a source are read in the
order of the md5 of their id, again from the start when the target exceeds the
source; the mix is all passes, range-sorted by position.

All of it is DataFrame expressions. Token offsets within a source are running
sums; a source may hold any share of the rows, so each is dealt into at most
sqrt(rows) ranges of the md5: ranges are summed first, their offsets come from
a window over the ranges of a source, and the sums inside a range from a
window over that range only. Kept columns, such as texts, are moved twice: to
their range, and once for each pass to its place in the order of training.

Defined results: null texts and texts without words have size 0 and are taken
0 times; a null source is a source of its own (last in the order); rows with
equal ids, also null ids, are ordered by size and text hash (equal rows are
interchangeable); an empty table gives an empty mix; only ``doc_id``, ``text``
and ``source`` of the input are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablesmith.llm.common import Scratch

#: Weights dealt to the sources in their order, again and again.
WEIGHTS = (3, 1, 2)
#: One schedule for each weight of WEIGHTS: early, level and late sources.
SCHEDULES = (((0.0, 3.0), (1.0, 1.0)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.0), (0.5, 1.0), (1.0, 4.0)))
SHARE_PERCENT = 150
MAX_REPEATS = 2
#: Runs of these separate words: space, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _md5_order(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share_percent=SHARE_PERCENT, max_repeats=MAX_REPEATS) -> DataFrame:
    """``(source, n, source_size, weight, kind, target)`` from rows ``(source, size)``.

    Targets share ``share_percent`` of all sizes by weight; a target stops at
    ``max_repeats`` times its source's size and the excess goes to the others.
    In the order of cap / weight the sources that reach their cap come first,
    so one running sum finds them: a source is capped if its share of what is
    left after the smaller ones is above its cap. The windows without a
    partition run over one row per source.
    """
    by_source = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    kind = (F.row_number().over(order) - 1) % len(weights)
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = (
        by_source.withColumn("kind", kind.cast("int"))
        .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("kind") + 1).cast("long"))
        .withColumn("cap", F.col("source_size") * max_repeats)
        .withColumn("budget", F.sum("source_size").over(everything) * share_percent)  # in hundredths
        .withColumn("left", F.col("budget") - 100 * F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weights_left", F.sum("weight").over(after))
        .withColumn("capped", F.col("weight") * F.col("left") > 100 * F.col("cap") * F.col("weights_left"))
    )
    rest = ranked.withColumn("capped_sum", F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything)).withColumn(
        "free_weight", F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything)
    )
    share = F.try_divide(  # null where all are capped
        (F.col("weight") * (F.col("budget") - 100 * F.col("capped_sum"))).cast("double"), (100 * F.col("free_weight")).cast("double")
    )
    return rest.select(
        "source", "n", "source_size", "weight", "kind",
        F.when(F.col("capped") | (F.col("cap") == 0), F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def demand_inverse(kind: Column, part: Column, schedules=SCHEDULES) -> Column:
    """The time at which a source has delivered ``part`` (0..1) of its tokens."""
    out = None
    for i, knots in enumerate(schedules):
        areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
        total, done, time = sum(areas), 0.0, None
        for area, (t0, w0), (t1, w1) in zip(areas, knots, knots[1:]):
            rest = part * F.lit(total) - F.lit(done)  # tokens asked of this segment
            slope = (w1 - w0) / (t1 - t0)
            # solve w0 x + slope x^2 / 2 = rest; this form also holds for slope 0
            x = F.lit(2.0) * rest / (F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0))))
            here = F.lit(t0) + x
            time = here if time is None else F.when(part * F.lit(total) >= F.lit(done), here).otherwise(time)
            done += area
        out = F.when(kind == i, time) if out is None else out.when(kind == i, time)
    return out


def document_takes(docs: DataFrame, keep: list[str] | None = None, **params) -> DataFrame:
    """One row per document with its source's target and the words taken.

    ``takes`` lists the passes: ``pass``, ``words`` and the training
    ``position``. The last document of a source's target is taken in part, so
    that each source's words equal its target rounded to a whole number.
    """
    schedules = params.pop("schedules", SCHEDULES)
    keep = keep or []
    sized = docs.select(
        "doc_id", "source", *keep, word_count(F.col("text")).alias("size"), _md5_order(F.col("doc_id")).alias("h"), F.xxhash64("text").alias("tie")
    )
    # counted once, read for the targets, the ranges and (without kept columns) the rows
    narrow = Scratch(docs.sparkSession).keep(sized.select("doc_id", "source", "size", "h", "tie"))
    if not keep:
        sized = narrow
    # the source as a key without nulls: the join and the window below then share one exchange of the rows
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("s")
    # range of the md5: the first 32 bits, spread over sqrt(rows) ranges
    n_ranges = math.ceil(math.sqrt(narrow.count()))
    part = F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("double") / F.lit(float(2**32)) * F.lit(n_ranges)).alias("part")
    targets = source_targets(narrow.select("source", "size"), **params).select(key, "source_size", "kind", "target")
    ranges = (
        narrow.select(key, part, "size").groupBy("s", "part").agg(F.sum("size").alias("part_size"))
        .withColumn("part_offset", F.coalesce(F.sum("part_size").over(Window.partitionBy("s").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .drop("part_size")
    )
    inside = Window.partitionBy("s", "part").orderBy("h", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.col("part_offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    out = sized.select("*", key, part).join(ranges.join(targets, "s"), ["s", "part"]).withColumn("offset", offset)
    words = F.round("target").cast("long")
    passes = []
    for k in range(params.get("max_repeats", MAX_REPEATS)):
        start = F.col("offset") + k * F.col("source_size")
        taken = F.greatest(F.lit(0), F.least(F.col("size"), words - start)).cast("long")
        passes.append(F.struct(F.lit(k + 1).alias("pass"), taken.alias("words"), demand_inverse(F.col("kind"), F.try_divide(start, F.col("target")), schedules).alias("position")))
    out = out.withColumn("takes", F.filter(F.array(*passes), lambda p: p["words"] > 0))
    taken = F.aggregate("takes", F.lit(0).cast("long"), lambda n, p: n + p["words"])
    return out.select("doc_id", "source", *keep, "size", "source_size", "target", taken.alias("taken"), F.when(F.size("takes") > 0, F.col("takes")[0]["position"]).alias("first_position"), "takes")


def mix(docs: DataFrame, keep: list[str] | None = None, **params) -> DataFrame:
    """The training stream: one row per pass of a document, range-sorted by position."""
    taken = document_takes(docs, keep, **params)
    rows = taken.withColumn("take", F.explode("takes")).select(
        "doc_id", "source", *(keep or []), "size", F.col("take.pass").alias("pass"), F.col("take.words").alias("words"), F.col("take.position").alias("position")
    )
    return rows.repartitionByRange("position", "doc_id", "pass").sortWithinPartitions("position", "doc_id", "pass")


def cut_words(text: Column, words: Column, size: Column) -> Column:
    """``text`` itself, or its first ``words`` words where fewer are taken."""
    found = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    return F.when(words >= size, text).otherwise(F.array_join(F.slice(found, 1, F.greatest(words, F.lit(1)).cast("int")), " "))
