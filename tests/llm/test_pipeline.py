"""The pipeline against plain-Python stages, and without the llm folders."""

import re

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline as P
from tablesmith.llm import mixing, secret_scan
from tablesmith.llm.queries import BYTE_RANKS, PIECE_MODEL

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage, the input first."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*P.COLUMNS)
    out = [docs.collect()]
    for _, stage in P.STAGES:
        docs = spark.createDataFrame(rows := stage(spark, docs, SF).collect(), schema=stage(spark, docs, SF).schema)
        out.append(rows)
    return out


def test_stage_order_and_columns(stages):
    assert [name for name, _ in P.STAGES] == ["toxicity", "ngram_jaccard", "secret_scan", "mixing", "sentencepiece"]
    for rows in stages[1:-1]:
        assert list(rows[0].asDict()) == P.COLUMNS


def test_toxicity_only_drops(spark, stages):
    before, after = ({r["doc_id"]: r for r in s} for s in stages[:2])
    assert all(before[i] == r for i, r in after.items())
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    dropped = set(before) - set(after)
    assert sum(labels.get(i) == 0 for i in dropped) <= 0.02 * len(before)


def test_one_document_of_each_group_of_near_copies_stays(stages):
    def shingles(t):
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    rows = sorted(stages[1])
    sets = [shingles(r["text"]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert sorted(stages[2]) == [r for i, r in enumerate(rows) if find(i) == i]


def test_secrets_are_gone_and_the_rest_is_kept(stages):
    encoding = secret_scan.vocabulary(public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)
    before, after = ({r["doc_id"]: r for r in s} for s in stages[2:4])
    assert set(before) == set(after)
    found = dict(zip(before, secret_scan.scan([r["text"] for r in before.values()], encoding)))
    for i, r in after.items():
        if not found[i]:
            assert r == before[i]
        else:
            assert r["n_chars"] == len(r["text"]) and "[SECRET]" in r["text"]
            assert not any(before[i]["text"][s:e] in r["text"] for s, _, e in found[i])


def test_mix_takes_the_targets(stages):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = {}, {}
    for r in stages[3]:
        sizes[r["source"]] = sizes.get(r["source"], 0) + words(r["text"])
    for r in stages[4]:
        taken[r["source"]] = taken.get(r["source"], 0) + words(r["text"])
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=1e-3)
    assert all(taken.get(s, 0) <= 2 * n for s, n in sizes.items())
    assert mixing.SHARE_PERCENT == 150


def test_last_stage_equals_the_library(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECE_MODEL))
    assert len(stages[5]) == len(stages[4])
    for before, r in zip(sorted(stages[4], key=lambda r: (r["doc_id"], r["text"])), sorted(stages[5], key=lambda r: (r["doc_id"], library.decode(r["input_ids"])))):
        assert r["input_ids"] == library.encode(before["text"]) + [2] and r["n_tokens"] == len(r["input_ids"])


def test_last_stage_decodes_its_ids(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECE_MODEL))
    texts = ["plain  words\n", "naïve ☃ text", "", None]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], COLUMNS)
    out = {r["doc_id"]: r for r in P.encode(spark, docs, SF).collect()}
    assert sorted(out) == [0, 1, 2, 3]
    assert all(r["decoded"] == library.decode(r["input_ids"]) for r in out.values())
    assert [out[i]["decoded"] for i in range(4)] == ["plain  words\n", "naïve ☃ text", "", ""]


def test_run_applies_all_stages(spark, stages):
    out = P.run(spark, SF)
    assert sorted(tuple(r["input_ids"]) for r in out.collect()) == sorted(tuple(r["input_ids"]) for r in stages[5])


def test_stages_handle_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "a b c d e f", "en", "s", 11), (3, "a b c d e f", "en", "s", 11), (3, "a b c d e f", "en", "s", 11), (4, "word " * 20_000, "en", None, 5)]
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], COLUMNS + ", size long, rep string")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    got = {r["doc_id"] for r in docs.collect()}
    assert got <= {1, 2, 3, 4, None}
    docs = spark.createDataFrame([], COLUMNS)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []


def test_order_of_training_survives_files_of_unequal_size(spark, scratch_dir):
    """Spark reads large files first; the last stage restores the written order."""
    rows = [(i, "w " * (1 if i < 40 else 3000) + str(i), "en", "s", 5) for i in range(80)]
    spark.createDataFrame(rows, COLUMNS).repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id").write.parquet(f"{scratch_dir}/docs")
    out = P.encode(spark, spark.read.parquet(f"{scratch_dir}/docs"), SF)
    assert [r["doc_id"] for r in out.orderBy("position").collect()] == list(range(80))
    assert [r["doc_id"] for r in out.collect()] == list(range(80))
