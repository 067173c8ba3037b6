"""The registered queries of this package and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

import corpus_pipeline
from wayfare.llm import (
    bpe,
    conversations,
    embeddings,
    html_text,
    language,
    licenses,
    mixing,
    ngram_join,
    pii,
    quality,
    token_alignment,
    token_counts,
    toxicity,
)
from wayfare.llm.oracle import LLM_ORACLE_SQL
from wayfare.llm.text import read_table

TOKEN_LIMIT = 2048

__all__ = ["LLM_ORACLE_SQL", "LLM_QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return html_text.extract(pages, columns=["page_id", "url"]).select(
        F.col("row.page_id").alias("page_id"),
        F.col("row.url").alias("url"),
        "text",
        F.length("text").cast("long").alias("n_chars"),
    )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    pattern = public_tokenizers.PATTERN
    docs = read_table(spark, sf_dir, "documents")
    coded = bpe.encode(docs, path, pattern, columns=["doc_id"], back=True)
    return coded.select(F.col("row.doc_id").alias("doc_id"), *bpe.digests(coded))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return ngram_join.jaccard_components(docs, width=3, similarity=(90, 100))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"), cosine=0.98)


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return pii.anonymised(docs, key=corpus_pipeline.SURROGATE_KEY, columns=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("clean").alias("text"),
        F.size("found").cast("long").alias("n_found"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda m: m["kind"]))), ",").alias("kinds"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return licenses.license_scan(docs, columns=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"),
        "licence",
        "start",
        "end",
        "gain",
        "missing",
        "added",
        "wording",
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.count_tokens(docs, path, columns=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality.judged(read_table(spark, sf_dir, "documents"), columns=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"),
        *[F.col(name).cast("long").alias(name) for name in names],
        "base_failed",
        "kept",
        F.col("quality").alias("probability"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    labels = read_table(spark, sf_dir, "labels").where(~held_out)
    model = toxicity.fit(toxicity.sampled(docs, labels, "doc_id", "text", "toxic"))
    doc_id = F.col("row.doc_id")
    return toxicity.scored(docs, model, columns=["doc_id"]).select(
        doc_id.alias("doc_id"),
        (F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
    )


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    profiles = language.fit(docs.where(~held_out))
    return language.identified(docs.withColumn("held_out", held_out), profiles, columns=["doc_id", "held_out"]).select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("row.held_out").alias("held_out"),
        F.col("language").alias("lang_pred"),
        "score",
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations")
    return conversations.summary(turns, conversations.damaged(turns))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    aligned = token_alignment.align(docs, *paths, columns=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"),
        *["n_a", "n_b", "n_groups", "n_links", "links"],
        F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"),
    )
    return token_alignment.counted(aligned)


LLM_QUERIES: dict[str, Query] = {
    "pipeline": corpus_pipeline.run,
    "op1_mix_sources": op1_mix_sources,
    "op2_main_text": op2_main_text,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_pii_surrogates": op6_pii_surrogates,
    "op7_license_scan": op7_license_scan,
    "op8_token_counts": op8_token_counts,
    "op9_quality_rules": op9_quality_rules,
    "op10_toxicity": op10_toxicity,
    "op11_language_id": op11_language_id,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_token_alignment": op13_token_alignment,
}
