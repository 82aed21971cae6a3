"""Registered queries of the numbered operators and of the corpus pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cohortlens.llm import ann, concat_cut, language_id, lm_score, mixing, mtree, multi_index, near_dedup, packing, secret_scan, toxicity, turn_repair, warc
from cohortlens.llm.shipping import ship

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mixture(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "passes")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), percent=85)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lm_score.score(_table(spark, sf_dir, "documents"))
    return out.withColumn("score", F.round("score", 6))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs, groups=near_dedup.near_duplicates(docs, percent=85))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.exact_top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(_table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return multi_index.mine(rows, F.col("vec_id") % 100 == 0)


def op13_concat_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = concat_cut.pieces(_table(spark, sf_dir, "documents"))
    digest = F.crc32("ids").alias("ids_crc32")
    return out.select("doc_id", "start", "length", digest, "doc_tokens", "sequence_id", "offset")


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    found = (
        op1_mix_sources,
        op2_near_duplicates,
        op3_nearest_neighbours,
        op4_toxicity,
        op5_lm_score,
        op6_secrets,
        op7_packing,
        op8_warc,
        op9_language,
        op10_exact_top_k,
        op11_turn_repair,
        op12_hard_negatives,
        op13_concat_cut,
    )
    return {f.__name__: _shipped(f) for f in found} | {"pipeline": _shipped(corpus_pipeline.run)}
