"""Registered queries of the training-data operators; each applies its operator to whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bm25, byte_bpe, decontaminate, language_id, merkle, quality, quality_rules,
               secret_scan, simhash, spelling, style_tree, substring_dedup, url_graph)
from .common import read_table

QUERIES = {}
ORACLE = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 50."""
    docs = read_table(spark, sf_dir, "documents")
    rows = docs.filter("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), "text")
    return bm25.more_like_these(docs, rows)


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digest(byte_bpe.encode(docs, path, public_tokenizers.PATTERN))


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(read_table(spark, sf_dir, "documents")))


@query
def op6_url_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_graph.judge(read_table(spark, sf_dir, "pages"))


ORACLE["op6_url_graph"] = url_graph.oracle_sql()


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


@query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read_table(spark, sf_dir, "documents"),
                               read_table(spark, sf_dir, "benchmark"))


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read_table(spark, sf_dir, "documents"),
                            read_table(spark, sf_dir, "labels"))


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(
        substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents")))


ORACLE["op5_substring_dedup"] = substring_dedup.ORACLE_SQL


@query
def op3_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.digest(style_tree.extract(read_table(spark, sf_dir, "pages")))


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return merkle.digest(merkle.proofs(docs, merkle.tampered(docs)))


ORACLE["op11_merkle"] = merkle.ORACLE_SQL


@query
def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents"),
                               read_table(spark, sf_dir, "labels"))


@query
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


ORACLE["op13_spelling"] = spelling.ORACLE_SQL
