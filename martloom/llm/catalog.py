"""The registered queries of this subpackage, with production parameters on whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import bpe, iblt, language, lines, manifest, mixing, pii, rules, simhash, sql, toxicity, trie, urls, vectors
from martloom.llm.rows import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predictions(docs, language.train(docs))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op4_paragraph_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.fingerprints(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.summary(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verified(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.rebuilt(table(spark, sf_dir, "conversations"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents"))


REGISTRY = {q.__name__: q for q in (
    op1_language_id, op2_mix_sources, op3_personal_data, op4_paragraph_sketch, op5_url_filter, op6_byte_bpe, op7_simhash, op8_line_dedup,
    op9_toxicity, op10_embedding_dedup, op11_merkle_manifest, op12_prefix_trie, op13_quality_rules)}

ORACLE: dict[str, str] = sql.ORACLE
