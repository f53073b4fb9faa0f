"""A training-data pipeline: five stages over `documents`, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from metaloom.llm import bytebpe, decontam, neardup, quality, secretscan
from metaloom.llm.landing import land

RANKS = "byte_bpe_50k.tiktoken"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier, learned from all labelled ones, rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stats = land(quality.document_statistics(docs), "statistics")
    return quality.kept_documents(docs, quality.fit(stats, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of every group; five words a shingle, a similarity of 0.8 or more."""
    return neardup.one_of_each(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop contaminated documents."""
    return decontam.cleaned(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by a mark; every document stays."""
    return secretscan.redact(docs, secretscan.learned(docs))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of texts."""
    return bytebpe.encoded_documents(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("byte_level_bpe", byte_level_bpe),
]

#: Learned scores, near-duplicate groups and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`: the kept documents with their token ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
