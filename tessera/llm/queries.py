"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import covertree, hilbert, lines, minhash, nbsvm, packing, phrases, pseudo, records, zdict


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir), threshold=0.8, shingle_words=5, weighting="count").drop("text_key")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), capacity=1024, end_id=2)


def op3_cover_tree_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), threshold=0.98)


def op4_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shard_documents(_documents(spark, sf_dir), shards=16)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return lines.line_report(docs, lines.duplicate_lines(docs, threshold=0.8, shingle_words=5))


def op6_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbsvm.classify(_documents(spark, sf_dir), _labels(spark, sf_dir), target="quality", modulus=3, held=1)


def op7_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo.score_documents(_documents(spark, sf_dir))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.contamination(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=13, share=20).drop("text_key")


def op9_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_record_digests(_documents(spark, sf_dir), end_id=2)


def op10_toxicity_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zdict.classify(_documents(spark, sf_dir), _labels(spark, sf_dir), target="toxic", modulus=5, held=0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_minhash_near_dedup,
        op2_best_fit_packing,
        op3_cover_tree_near_dedup,
        op4_hilbert_sharding,
        op5_line_dedup,
        op6_quality_nbsvm,
        op7_pseudo_likelihood,
        op8_decontamination,
        op9_token_records,
        op10_toxicity_compression,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op5_line_dedup": lines.SQL, "op8_decontamination": phrases.SQL}
