"""The mix against a plain-Python water filling and running sums."""

import hashlib
import re

import pytest

from tablesmith.llm import mixing


def targets(sizes):
    """sizes: source -> words; the shares by repeated resharing."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, open_ = 1.5 * sum(sizes.values()), set(order)
    out = {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] / total > 2 * sizes[s]]
        if not above:
            return out | {s: left * weight[s] / total for s in open_}
        for s in above:
            out[s] = 2.0 * sizes[s]
            open_.remove(s)
        left = 1.5 * sum(sizes.values()) - sum(out.values())
    return out


DOCS = [(i, " ".join(["w"] * ((i * 7) % 41)), ["a", "b", "c", "d", None, "é"][i % 6 if i % 3 else 0]) for i in range(300)] + [
    (1000, None, "a"), (1001, "", "b"), (1002, " \t\n", None), (None, "one two", "c"), (None, "one two", "c"), (5, "w " * 90_000, "d"), (1003, None, "zero"),
]


@pytest.fixture(scope="module")
def taken(spark):
    docs = spark.createDataFrame([(*d, "x", 1.0) for d in DOCS], "doc_id long, text string, source string, size string, target double")
    return mixing.document_takes(docs).collect()


def test_targets_and_sizes(taken):
    sizes = {}
    for _, text, source in DOCS:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = targets(sizes)
    assert len(taken) == len(DOCS)
    for r in taken:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-12)
        assert 0 <= r["taken"] <= 2 * r["size"]
    for source in sizes:
        assert sum(r["taken"] for r in taken if r["source"] == source) == round(want[source])


def test_documents_are_read_in_md5_order(taken):
    """The first pass takes documents from the start until the target is reached."""
    for source in {r["source"] for r in taken}:
        rows = [r for r in taken if r["source"] == source]
        rows.sort(key=lambda r: (hashlib.md5(("" if r["doc_id"] is None else str(r["doc_id"])).encode()).hexdigest(), r["doc_id"] or 0, r["size"]))
        at, words = 0, round(rows[0]["target"])
        for r in rows:
            want = [max(0, min(r["size"], words - at - k * r["source_size"])) for k in range(2)]
            assert [p["words"] for p in r["takes"]] == [w for w in want if w]
            at += r["size"]


def test_positions_invert_the_schedule(spark):
    def weight(knots, t):
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            if t <= t1:
                return w0 + (w1 - w0) * (t - t0) / (t1 - t0)

    from pyspark.sql import functions as F

    parts = [i / 20 for i in range(20)]
    df = spark.createDataFrame([(k, p) for k in range(3) for p in parts], "kind int, part double")
    for r in df.withColumn("t", mixing.demand_inverse(F.col("kind"), F.col("part"))).collect():
        knots = mixing.SCHEDULES[r["kind"]]
        steps = 20_000
        grid = [weight(knots, (i + 0.5) / steps) / steps for i in range(steps)]
        done = sum(grid[: int(r["t"] * steps)]) / sum(grid)
        assert done == pytest.approx(r["part"], abs=2e-4)


def test_mix_is_sorted_and_holds_every_pass(spark, taken):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, source string")
    rows = mixing.mix(docs, ["text"]).collect()
    assert sum(r["words"] for r in rows) == sum(r["taken"] for r in taken)
    assert [r["position"] for r in rows] == sorted(r["position"] for r in rows)


def test_cut_words(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(" a  b\nc ", 3, 3), (" a  b\nc ", 2, 3)], "text string, words long, size long")
    out = [r[0] for r in df.select(mixing.cut_words(F.col("text"), F.col("words"), F.col("size"))).collect()]
    assert out == [" a  b\nc ", "a b"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.document_takes(docs).collect() == [] and mixing.mix(docs).collect() == []


def test_plan_is_native(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, source string")
    plan = mixing.mix(docs, ["text"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def exchanges_of(df, column):
    """The exchanges of the first plan whose rows hold ``column``."""
    seq = lambda x: [x.apply(i) for i in range(x.size())]
    below = [df._jdf.queryExecution().executedPlan().initialPlan()]
    found = 0
    while below:
        node = below.pop()
        below += seq(node.children())
        found += "Exchange" in node.nodeName() and column in [a.name() for a in seq(node.output())]
    return found


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_texts_are_moved_twice(spark, no_broadcast):
    """To their range and to their place, also where no side of a join is small."""
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, source string")
    assert exchanges_of(mixing.document_takes(docs, ["text"]), "text") == 1
    assert exchanges_of(mixing.mix(docs, ["text"]), "text") == 2


def test_many_sources_and_odd_names(spark, no_broadcast):
    """Null, the empty text and names with the mark of the key are sources of their own."""
    names = [None, "", "=", "==", *(f"s{i}" for i in range(60))]
    rows = [(i, "w " * (i % 13), names[i % len(names)]) for i in range(3 * len(names))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = {}
    for i, _, source in rows:
        sizes[source] = sizes.get(source, 0) + i % 13
    want = targets(sizes)
    taken = mixing.document_takes(docs, ["text"]).collect()
    assert sorted((r["doc_id"], r["text"]) for r in taken) == [r[:2] for r in rows]
    for source in names:
        mine = [r for r in taken if r["source"] == source]
        assert {(r["source_size"], round(r["target"], 6)) for r in mine} == {(sizes[source], round(want[source], 6))}
        words, at = int(want[source] + 0.5), 0  # halves up, as Spark rounds
        assert sum(r["taken"] for r in mine) == words
        for r in sorted(mine, key=lambda r: hashlib.md5(str(r["doc_id"]).encode()).hexdigest()):
            assert r["taken"] == sum(max(0, min(r["size"], words - at - k * sizes[source])) for k in range(2))
            at += r["size"]
