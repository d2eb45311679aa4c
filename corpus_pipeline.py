"""Corpus pipeline: stages over documents, each calling one of the training-data operators.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept;
all but the last return the columns of ``documents``.  Null texts are kept by no language
stage; empty tables pass through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from casetrail.llm import byte_bpe, decontaminate, language_id, secret_scan, simhash
from casetrail.llm.common import read_table, stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognised language."""
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least doc_id of each group of SimHash near-duplicates."""
    return simhash.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a copy of a benchmark item."""
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask the secrets that the scan reports, in place."""
    return secret_scan.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Append the byte-level BPE ids of every text and the bytes that they decode to."""
    return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                           public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secret_scan", mask_secrets),
    ("byte_bpe", encode),
]
#: SQL can express neither the model fits nor the alignments; tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
