"""Queries of similarity joins and searches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.llm import decontam, neardup_vectors, ngram_join
from tokenmill.llm.common import documents
from tokenmill.llm.queries import query


LOWER = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingles_sql(name: str, key: str, table: str) -> str:
    """Tables ``{name}_set`` (distinct five-word shingles of each text) and ``{name}_each`` (one row per shingle)."""
    lower = LOWER.format(x="coalesce(text, '')")
    return rf"""{name}_words AS (SELECT {key}, regexp_extract_all({lower}, '[^\x20\x09-\x0D]+') AS w FROM {table}),
{name}_set AS (SELECT {key}, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' '))) END AS sh FROM {name}_words),
{name}_each AS (SELECT {key}, unnest(sh) AS g FROM {name}_set)"""


OP2_SQL = f"""
WITH RECURSIVE {_shingles_sql("d", "doc_id", "documents")},
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM d_each a JOIN d_each b USING (g)
          WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN d_set x ON x.doc_id = a JOIN d_set y ON y.doc_id = b
          WHERE 100 * k >= 75 * (len(x.sh) + len(y.sh) - k)),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM d_set
          UNION SELECT r.doc_id, s.b FROM reach r JOIN steps s ON s.a = r.other)
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id
FROM d_set JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)"""

OP6_SQL = f"""
WITH {_shingles_sql("d", "doc_id", "documents")}, {_shingles_sql("i", "item_id", "benchmark")},
shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d_each JOIN i_each USING (g) GROUP BY ALL)
SELECT doc_id, item_id, CAST(len(sh) AS BIGINT) AS n_item, CAST(n_shared AS BIGINT) AS n_shared, n_shared / len(sh) AS containment
FROM shared JOIN i_set USING (item_id) WHERE 100 * n_shared >= 75 * len(sh)"""


@query("op6_decontamination", OP6_SQL)
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontam.find_contained(documents(spark, sf_dir), items)
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))


@query("op7_vector_near_dups")
def op7_vector_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup_vectors.link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op2_ngram_jaccard_join", OP2_SQL)
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(documents(spark, sf_dir))
