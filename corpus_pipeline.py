"""From the raw ``documents`` table to packed training sequences.

Each stage reads what the stage before it wrote.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrace.llm import jaccard, mixing, packing, quality, secrets
from terrace.llm.tables import materialize, read


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or a certified cutoff."""
    return quality.keep(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: shingles of five words, similarity 0.8."""
    return jaccard.keep_one(docs, words=5, share=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts by a mark; every document stays."""
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw the mixture: a row per run of words that it takes from a document."""
    return mixing.mixed_documents(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens in sequences: a row per piece."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scan", secret_scan),
    ("mixing sources", source_mix),
    ("packing", sequence_packing),
]

# Token ids and drawn mixtures are beyond SQL; tests/llm holds a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
