"""The corpus pipeline: toxic documents go, repeated lines go, near copies go, sources
are mixed to their weights, and the result is encoded.

Each stage takes (spark, docs, sf_dir) and reads all rows that the one before it kept.
All but the last return the columns of ``docs``, extra ones included.

Defined results: a null or empty text is not toxic, has no line to lose, is a near copy of
every text without words, has size 0, so that the mix takes it or not without effect on its
targets, and is encoded as no ids. Rows without doc_id or source are rows like any other. Of
rows equal in id and text, near-dedup keeps one; the stages before it treat them alike. An
empty table passes through each stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martloom.llm import bpe, lines, mixing, simhash, toxicity
from martloom.llm.rows import table
from martloom.session import fresh_path

#: Near copies: words of a shingle, and the least Jaccard similarity of two texts' shingles.
SIMILAR = (5, 0.8)
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def delete_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, similar=SIMILAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids, and whether decoding gives the text again."""
    return bpe.encoded_documents(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [("toxicity", reject_toxic), ("line_dedup", delete_repeated_lines), ("near_dedup", drop_near_duplicates),
          ("mix", mix_sources), ("encode", encode)]

#: Learned models, random ranks and merges are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
