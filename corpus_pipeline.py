"""From raw documents to token ids, in stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet to the shared folder and the next stage reads it again.
All stages but the last return the columns of ``documents`` (other columns of
the input are not carried). Nulls, empty texts, repeated rows and empty tables
have the results that the operators define.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.llm import mixing, ngram_jaccard, piece_bpe, secret_scan, toxicity
from tablesmith.llm.common import Scratch, own_exchange, read
from tablesmith.llm.queries import BYTE_RANKS, PIECE_MODEL

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of the threshold or more go."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, COLUMNS)
    return scored.where(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of the n-gram join (five words, similarity 0.8 and
    more) the document with the smallest id stays. Documents without words
    have no copies and all stay; so do rows without an id."""
    found = Scratch(spark).keep(ngram_jaccard.jaccard_components(docs, words=5, percent=80))
    copies = found.where("doc_id <> component_id").select("doc_id")
    repeated = found.groupBy("doc_id").count().where("doc_id is not null and count > 1").select("doc_id")
    out = copies.union(repeated).select(own_exchange("doc_id").alias("doc_id"))
    once = docs.select(*COLUMNS).join(out, "doc_id", "left_anti")
    # rows that repeat an id: of equal rows one stays
    again = docs.select(*COLUMNS).join(repeated.join(copies, "doc_id", "left_anti"), "doc_id", "left_semi")
    return once.select(*COLUMNS).unionByName(again.select(*COLUMNS).dropDuplicates())


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Findings are replaced by a mark; all documents stay."""
    found = secret_scan.find_secrets(docs, public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN, COLUMNS)
    safe = secret_scan.redact(F.col("text"), F.col("findings"))
    length = F.when(F.size("findings") > 0, F.length(safe).cast("long")).otherwise(F.col("n_chars"))
    return found.select("doc_id", safe.alias("text"), "lang", "source", length.alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per pass of a document, in the order of training. Passes that
    are taken in part hold the first words."""
    rows = mixing.mix(docs, ["text", "lang", "n_chars"])
    text = mixing.cut_words(F.col("text"), F.col("words"), F.col("size"))
    length = F.when(F.col("words") < F.col("size"), F.length(text).cast("long")).otherwise(F.col("n_chars"))
    return rows.select("doc_id", text.alias("text"), "lang", "source", length.alias("n_chars"))


def in_order(docs: DataFrame) -> DataFrame:
    """``docs`` with ``position``, which grows in the order in which its rows
    were written: Spark reads files by size, but the name of a file has its
    place and each row its index there. Rows that come from no file are
    counted as they come."""
    try:
        files = docs.select("*", "_metadata.file_name", "_metadata.row_index")
    except AnalysisException:
        return docs.withColumn("position", F.monotonically_increasing_id())
    place = [F.regexp_extract("file_name", p, 1).try_cast("long") for p in (r"^part-(\d+)", r"-c(\d+)\.")]
    part, split = (F.coalesce(p, F.lit(0)) for p in place)
    return files.withColumn("position", part * F.lit(1 << 44) + split * F.lit(1 << 32) + F.col("row_index")).drop("file_name", "row_index")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with the end id, the number of them, the text that they decode
    to, and ``position``, by which the rows are range-sorted: the order of
    training."""
    ids = piece_bpe.encode_decode(in_order(docs), public_tokenizers.path(PIECE_MODEL), ["doc_id", "lang", "source", "position"])
    return ids.withColumn("n_tokens", F.size("input_ids").cast("long")).repartitionByRange("position").sortWithinPartitions("position")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: The trained scores, the set join and the merge rounds have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = read(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs
