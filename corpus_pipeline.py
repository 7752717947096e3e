"""Corpus preparation: the stages in order, each over all rows its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written as Parquet and reread as the next stage's docs.  All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from wardflow.functions.segments import shared_folder
from wardflow.llm import mixing, near_dedup, quality, secrets, segmentation


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current quality policy."""
    return quality.keep(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dedup.one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked."""
    return secrets.redact(docs)


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by their fitted rates; a rate of 1 or more keeps the document once."""
    return mixing.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document as piece ids."""
    return segmentation.encode(docs).drop("text_hash")


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("secret_scans", secret_scans),
    ("mixing_to_targets", mixing_to_targets),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

#: SQL cannot express the signatures, the fitted rates and the sampled segmentations; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
