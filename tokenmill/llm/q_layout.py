"""Queries that lay documents out: shards and packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.llm import packing, sharding
from tokenmill.llm.common import documents
from tokenmill.llm.queries import query

SHARDS = 8


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@query("op4_kk_shards")
def op4_kk_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = sharding.shard_documents(documents(spark, sf_dir), SHARDS)
    return d.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"))


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), default_tokenizer())
