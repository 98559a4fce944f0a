"""Corpus pipeline: toxicity, near duplicates, decontamination, secrets, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir)
and returns the documents it keeps (columns of ``documents``), the last one
the packed pieces. Every stage's result is written as Parquet and read back
as the next one's input.

What the stages decide:

* toxicity: documents that score 0.5 or more go (operator 9, learned from
  the ``labels`` of the documents it is given);
* near_duplicates: of documents linked by five-word shingles at a Jaccard
  similarity of 0.75 or more, the one with the smallest id of each connected
  group stays (operator 2);
* decontamination: documents that hold at least 75 percent of the shingles
  of a ``benchmark`` item go (operator 6);
* secrets: secret spans are masked in the text and ``n_chars`` is counted
  anew; every document stays (operator 1);
* packing: the texts are tokenised and packed into sequences of 2048 ids
  (operator 5): one row per piece with its sequence and offset.

Nulls, empty tables, repeated rows and extra columns are handled as the
operators' docstrings say; the first four stages keep all columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.llm import decontam, ngram_join, packing, secrets, toxicity
from tokenmill.llm.common import documents, written
from tokenmill.llm.q_layout import default_tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_per_component(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return (secrets.redact_secrets(docs)
            .withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                        .otherwise(F.char_length("text").cast("long"))))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, default_tokenizer())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

# learned scores, decoded secrets and tokenisers have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read back in the shared checkpoint folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
