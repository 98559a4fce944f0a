"""Queries that learn from the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tokenmill.llm import lm, quality, resampling, whitening
from tokenmill.llm.common import documents
from tokenmill.llm.queries import query


@query("op3_lm_scores")
def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(documents(spark, sf_dir))


@query("op11_bit_sliced_whitening")
def op11_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op12_importance_resampling")
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op13_quality_ranking")
def op13_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
