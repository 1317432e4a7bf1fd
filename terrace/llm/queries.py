"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrace.llm import (ann, attention, cover_tree, jaccard, lexical, licenses, mixing, packing, pii, quality, secrets,
                         suffix_dedup, url_filter)
from terrace.llm.tables import read


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(read(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(read(spark, sf_dir, "documents"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 20 = 0"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(read(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(read(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(read(spark, sf_dir, "documents"))


def op9_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.digest(read(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = cover_tree.relabelled(read(spark, sf_dir, "embeddings"))
    return cover_tree.mine(vectors, vectors.where("vec_id % 100 = 0"))


def op12_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention.score(read(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_license_scan, op2_secret_scan, op3_nearest_neighbours,
                                   op4_suffix_dedup, op5_pii, op6_url_filter, op7_quality_rules, op8_source_mix,
                                   op9_sequence_packing, op10_ngram_jaccard, op11_hard_negatives,
                                   op12_attention_scores, op13_lexical_search)}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_suffix_dedup": suffix_dedup.ORACLE,
        "op6_url_filter": url_filter.ORACLE,
        "op7_quality_rules": quality.oracle(),
        "op10_ngram_jaccard": jaccard.ORACLE,
        "op11_hard_negatives": cover_tree.ORACLE,
        "op13_lexical_search": lexical.ORACLE,
    }
