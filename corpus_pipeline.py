"""A training corpus from raw documents, in stages.

Each stage reads the Parquet the one before wrote, works on all of it, and its
decisions take effect: rejected and duplicate documents are gone, secrets are
blanked, sources are repeated or thinned to their weights, and the last stage
lays the rest into sequences. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import language_id, mixing, near_dedup, packing, secret_scan
from cohortlens.llm.shipping import ship
from cohortlens.session import ensure_checkpoint_dir


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no known language: no letters, or far from all centroids."""
    ship(spark)
    return language_id.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8) stays."""
    ship(spark)
    return near_dedup.deduplicate(docs, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blanks secrets; documents without any stay as they are."""
    ship(spark)
    return secret_scan.redact_secrets(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: a row for each time a document is taken."""
    ship(spark)
    return mixing.mix(docs)


def packing_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences: a row for each piece of a document, with its bin."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", languages),
    ("near_dedup", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixture),
    ("packing", packing_),
]

#: The fitted centroids and clusters of near duplicates are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each but the last written and read again."""
    ship(spark)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
