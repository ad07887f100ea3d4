"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from memberlens.llm import (bpe_trie, fingerprints, html_text, license_rules, mixing, negatives, ngram_join, quality,
                            repeats, token_counts, toxicity, vectors, whitening)
from memberlens.llm.common import table

DOCS = "documents"


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_texts(table(spark, sf_dir, DOCS), n=4, percent=85)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, DOCS)).drop("copies")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, DOCS))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, DOCS), table(spark, sf_dir, "labels"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, DOCS), table(spark, sf_dir, "labels"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, DOCS), public_tokenizers.path("word_bpe_49k.json"))


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, DOCS)).drop("kept")


def op9_bpe_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_trie.encode_documents(table(spark, sf_dir, DOCS).select("doc_id", "text"),
                                      public_tokenizers.path("byte_bpe_50k.json"))
    return coded.drop("text")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.scan_licenses(table(spark, sf_dir, DOCS))


def op11_extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_ngram_join, op2_mix_sources, op3_fingerprints, op4_toxicity, op5_quality, op6_token_counts, op7_near_vectors,
    op8_remove_repeats, op9_bpe_encode, op10_license_scan, op11_extract_pages, op12_hard_negatives, op13_whiten)}
