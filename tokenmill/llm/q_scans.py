"""Queries of the text scans: secrets, licences, toxicity, personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.llm import licenses, pii, secrets, toxicity
from tokenmill.llm.common import count_kind, documents, spans_text
from tokenmill.llm.queries import query


@query("op1_secret_scan")
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(documents(spark, sf_dir))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return found.select(
        "doc_id",
        *[count_kind(spans, k).alias(f"n_{k}") for k in secrets.BASE_KINDS],
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: s["kind"].isin(*secrets.METHOD_KINDS))).cast("long").alias("n_confirmed"))


@query("op8_license_scan")
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = licenses.scan_licenses(documents(spark, sf_dir))
    base = F.transform("places", lambda p: p["label"])
    starts = F.transform("places", lambda p: p["start"])
    more = F.transform("matches", lambda m: m["label"])

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return d.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, more)).alias("labels"),
        # a full template is certain, a bare phrase only likely
        F.when(F.size("matches") > 0, 1.0).when(F.size("places") > 0, 0.6).otherwise(0.0).alias("score"),
        F.size("matches").cast("long").alias("n_matches"))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score_toxicity(documents(spark, sf_dir), labels)


# a fixed key keeps registered results comparable; a job passes its own secret
PII_KEY = b"registered-query-key"


@query("op10_pii_pseudonyms")
def op10_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pii.scan_pii(documents(spark, sf_dir), PII_KEY)
    spans = F.col("spans")
    return d.select("doc_id", *[count_kind(spans, k).alias(f"n_{k}") for k in pii.KINDS],
                    spans_text(spans).alias("spans"),
                    F.transform(spans, lambda s: s["pseudonym"]).alias("pseudonyms"), "text")
