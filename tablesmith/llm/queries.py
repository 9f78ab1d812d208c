"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.llm import (
    ann_tree,
    embedding_dedup,
    filter_audit,
    html_extract,
    lexical_search,
    mixing,
    ngram_jaccard,
    piece_bpe,
    quality,
    secret_scan,
    token_files,
    toxicity,
    url_filter,
)
from tablesmith.llm.common import Scratch, read

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_RANKS = "byte_bpe_50k.tiktoken"
WORD_TOKENIZER = "word_bpe_49k.json"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, ["doc_id"])
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "neighbours",
    )


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_components(read(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.score(docs, model, ["doc_id"]).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    ids = piece_bpe.encode_decode(docs, public_tokenizers.path(PIECE_MODEL), ["doc_id"])
    return ids.select(
        "doc_id",
        F.size("input_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("input_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    found = html_extract.extract(pages, html_extract.fit(pages), ["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.document_takes(read(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken", "first_position")


def op8_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.nearest(read(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = secret_scan.find_secrets(docs, public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN, ["doc_id"])

    def count(kind: str):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")

    base = F.filter("findings", lambda f: f["kind"] != "random")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secret_scan.spans(base), 256).alias("base_sha256"),
        secret_scan.spans(F.col("findings")).alias("spans"),
    )


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict", "url_score")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{Scratch(spark).root}/tokens"
    token_files.write(read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER), out)
    return token_files.with_crc32(token_files.tokens(spark, out))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_quality": op3_quality,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_html_extract": op6_html_extract,
    "op7_mixing": op7_mixing,
    "op8_ann_search": op8_ann_search,
    "op9_secret_scan": op9_secret_scan,
    "op10_url_filter": op10_url_filter,
    "op11_filter_audit": op11_filter_audit,
    "op12_lexical_search": op12_lexical_search,
    "op13_token_files": op13_token_files,
    "pipeline": pipeline,
}
