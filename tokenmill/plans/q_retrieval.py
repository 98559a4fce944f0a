"""Registered queries: retrieval, retrieval metrics, batching for
contrastive training."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenmill.operators import retrieval as V
from tokenmill.operators.offsets import hash_key
from tokenmill.operators import records as R
from tokenmill.operators.sample import split_fraction
from tokenmill.plans import tables
from tokenmill.plans.registry import arr_text, query, r6
from tokenmill.session import broadcast_if_bounded, materialize
from tokenmill.sources.io import spread

# every seventh id, as a query, has no relevant row
NO_MATCH = "CASE WHEN vec_id % 7 = 0 THEN -1 ELSE label END"
DIMS = (64, 32, 16, 8)
K = 10

# SQL building blocks ---------------------------------------------------------------
SPLIT = """s AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label,
              row_number() OVER (ORDER BY substr(md5('42-' || CAST(vec_id AS VARCHAR)), 1, 15), vec_id) - 1
                < CAST(ceil(0.1 * count(*) OVER ()) AS BIGINT) AS is_q FROM embeddings),
q AS (SELECT vec_id AS qid, v AS qv, CASE WHEN vec_id % 7 = 0 THEN -1 ELSE label END AS ql FROM s WHERE is_q),
c AS (SELECT vec_id AS cid, v AS cv, label AS cl FROM s WHERE NOT is_q)"""
TOP = SPLIT + """,
d AS (SELECT unnest([64, 32, 16, 8]) AS dim),
sc AS (SELECT dim, qid, cid, ql, cl,
              round(list_dot_product(qv[1:dim], cv[1:dim])
                    / (sqrt(list_dot_product(qv[1:dim], qv[1:dim])) * sqrt(list_dot_product(cv[1:dim], cv[1:dim]))), 12) AS score
       FROM q, c, d),
top AS (SELECT *, row_number() OVER (PARTITION BY dim, qid ORDER BY score DESC, cid) AS rank FROM sc
        QUALIFY rank <= 10)"""
METRICS = TOP + """,
h AS (SELECT dim, qid, rank, CASE WHEN ql = cl THEN 1 ELSE 0 END AS rel FROM top),
cu AS (SELECT *, sum(rel) OVER (PARTITION BY dim, qid ORDER BY rank) AS cum FROM h),
nr AS (SELECT qid, coalesce(n, 0) AS n_rel FROM q LEFT JOIN (SELECT cl, count(*) AS n FROM c GROUP BY cl) x ON x.cl = q.ql),
pq AS (SELECT dim, qid, sum(rel / log2(rank + 1)) AS dcg, max(rel / rank) AS rr, sum(rel * cum / rank) AS ap,
              sum(rel) AS n_hit FROM cu GROUP BY dim, qid),
m AS (SELECT dim, pq.qid, dcg / nullif(CASE WHEN n_rel > 0 THEN list_sum(list_transform(range(1, least(n_rel, 10) + 1), lambda i: 1 / log2(i + 1))) ELSE 0 END, 0) AS ndcg,
             rr AS mrr, ap / nullif(least(n_rel, 10), 0) AS map, n_hit / nullif(n_rel, 0) AS recall,
             n_hit / 10.0 AS precision, CASE WHEN n_hit > 0 THEN 1.0 ELSE 0.0 END AS accuracy
      FROM pq JOIN nr USING (qid)),
agg AS (SELECT dim, avg(coalesce(ndcg, 0)) AS ndcg_at_10, avg(mrr) AS mrr_at_10, avg(coalesce(map, 0)) AS map_at_10, avg(coalesce(recall, 0)) AS recall_at_10,
               avg(precision) AS precision_at_10, avg(accuracy) AS accuracy_at_10 FROM m GROUP BY dim)"""


def split_vectors(spark, sf):
    e = tables.table(spark, sf, "embeddings")
    # the split feeds the query block, the scoring and the relevance counts
    s = materialize(split_fraction(e, 0.1, 42, "vec_id"))
    q = s.where(F.col("split") == "test").select(F.col("vec_id").alias("qid"), "embedding",
                                                  F.expr(NO_MATCH).alias("rel_key"))
    c = s.where(F.col("split") == "train").select(F.col("vec_id").alias("cid"), "embedding",
                                                   F.col("label").alias("rel_key"))
    return q, c


def evaluation(spark, sf, **kw):
    q, c = split_vectors(spark, sf)
    return V.matryoshka_eval(q, c, DIMS, K, **kw)


@query("jon2_score_all_pairs", f"WITH {TOP} SELECT CAST(dim AS INTEGER) AS dim, qid, cid, CAST(rank AS INTEGER) AS rank FROM top")
def jon2(spark, sf):
    q, c = split_vectors(spark, sf)
    hits = V.score_top_k(q, c, DIMS, K)
    return hits.select("dim", "qid", "cid", F.col("rank").cast("int").alias("rank"))


@query("jon2_score_all_pairs_blocked",
       f"WITH {TOP} SELECT CAST(dim AS INTEGER) AS dim, qid, cid, CAST(rank AS INTEGER) AS rank FROM top")
def jon2b(spark, sf):
    """Same result through the path for query sets too large to broadcast."""
    q, c = split_vectors(spark, sf)
    hits = V.score_top_k(q, c, DIMS, K, broadcast_limit=0, query_block=16, corpus_buckets=4)
    return hits.select("dim", "qid", "cid", F.col("rank").cast("int").alias("rank"))


@query("jon1_qrels_join", f"""
WITH {TOP} SELECT CAST(dim AS INTEGER) AS dim, qid, cid, CASE WHEN ql = cl THEN 1 ELSE 0 END AS relevant FROM top""")
def jon1(spark, sf):
    q, c = split_vectors(spark, sf)
    # the corpus key travels with each hit: no join back to the corpus
    hits = V.score_top_k(q, c, DIMS, K, rel_key="rel_key").withColumnRenamed("c_key", "rel_key")
    qrels = q.select(F.col("qid").cast("bigint").alias("qid"), F.col("rel_key").cast("string").alias("rel_key"))
    return V.qrels_join(hits, qrels).select("dim", "qid", "cid", F.col("relevant").cast("int").alias("relevant"))


@query("win2_top_k_per_key", """
SELECT user_id, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS INTEGER) AS rank
FROM events QUALIFY rank <= 3""")
def win2(spark, sf):
    e = tables.table(spark, sf, "events").select("user_id", "event_id", "value")
    t = V.top_k_per_key(e, "user_id", "value", 3, tiebreak="event_id")
    return t.select("user_id", "event_id", F.col("rank").cast("int").alias("rank"))


def _metric_query(name, cols):
    sql = f"WITH {METRICS} SELECT CAST(dim AS INTEGER) AS dim, " + \
        ", ".join(f"round({c}, 6) AS {c}" for c in cols) + " FROM agg"

    def fn(spark, sf):
        m = evaluation(spark, sf)
        return m.select(F.col("dim").cast("int").alias("dim"), *[r6(c).alias(c) for c in cols])

    fn.__name__ = name
    query(name, sql)(fn)


_metric_query("met1_ndcg_at_k", ["ndcg_at_10"])
_metric_query("met2_mrr_at_k", ["mrr_at_10"])
_metric_query("met3_recall_precision_hit_rate", ["recall_at_10", "precision_at_10", "accuracy_at_10"])
_metric_query("met4_map_at_k", ["map_at_10"])


@query("met5_matryoshka_eval", f"""
WITH {METRICS} SELECT CAST(dim AS INTEGER) AS dim, 'dim_' || CAST(dim AS VARCHAR) || '_cosine_ndcg@10' AS key,
       round(ndcg_at_10, 6) AS ndcg_at_10, round(mrr_at_10, 6) AS mrr_at_10, round(map_at_10, 6) AS map_at_10
FROM agg""")
def met5(spark, sf):
    m = evaluation(spark, sf)
    return m.select(F.col("dim").cast("int").alias("dim"), "key", r6("ndcg_at_10").alias("ndcg_at_10"),
                    r6("mrr_at_10").alias("mrr_at_10"), r6("map_at_10").alias("map_at_10"))


QRELS = METRICS.replace(
    "h AS (SELECT dim, qid, rank, CASE WHEN ql = cl THEN 1 ELSE 0 END AS rel FROM top)",
    "h AS (SELECT dim, qid, rank, CASE WHEN ql = cl AND (qid + cid) % 3 = 0 THEN 1 ELSE 0 END AS rel FROM top)").replace(
    "nr AS (SELECT qid, coalesce(n, 0) AS n_rel FROM q LEFT JOIN (SELECT cl, count(*) AS n FROM c GROUP BY cl) x ON x.cl = q.ql)",
    "nr AS (SELECT qid, count(cid) AS n_rel FROM q LEFT JOIN c ON cl = ql AND (qid + cid) % 3 = 0 GROUP BY qid)")


@query("met5_qrels_eval", f"""
WITH {QRELS} SELECT CAST(dim AS INTEGER) AS dim, round(ndcg_at_10, 6) AS ndcg_at_10, round(mrr_at_10, 6) AS mrr_at_10,
       round(map_at_10, 6) AS map_at_10, round(recall_at_10, 6) AS recall_at_10 FROM agg""")
def met5b(spark, sf):
    """Relevance from a table of pairs (a third of the rows with the query's label)."""
    q, c = split_vectors(spark, sf)
    # (qid + cid) % 3 = 0 as a key; few labels hold all rows, so the larger side stays spread over its tasks
    asks = broadcast_if_bounded(q.select("qid", "rel_key", F.pmod(-F.col("qid"), F.lit(3)).alias("rest")), 2_000_000)
    rows = spread(c.select("cid", "rel_key", F.pmod("cid", F.lit(3)).alias("rest")), spark.sparkContext.defaultParallelism)
    pairs = rows.join(asks, ["rel_key", "rest"]).select("qid", "cid")
    m = V.matryoshka_eval(q, c, DIMS, K, qrels=pairs)
    return m.select(F.col("dim").cast("int").alias("dim"), *[r6(x).alias(x) for x in
                    ("ndcg_at_10", "mrr_at_10", "map_at_10", "recall_at_10")])


@query("run5_retention", f"""
WITH {METRICS} SELECT CAST(dim AS INTEGER) AS dim, round(ndcg_at_10 / max(ndcg_at_10) FILTER (WHERE dim = 64) OVER (), 6) AS retention
FROM agg""")
def run5(spark, sf):
    r = V.retention(evaluation(spark, sf), "dim", "ndcg_at_10", 64)
    return r.select(F.col("dim").cast("int").alias("dim"), r6("retention").alias("retention"))


BATCHES = """b AS (SELECT doc_id, (row_number() OVER (ORDER BY substr(md5('42-' || CAST(doc_id AS VARCHAR)), 1, 15), doc_id) - 1) // 16 AS batch
          FROM documents)"""


@query("jon5_in_batch_negatives", f"""
WITH {BATCHES}
SELECT a.doc_id, CAST(a.batch AS BIGINT) AS batch, CAST(count(x.doc_id) AS INTEGER) AS n_negatives,
       coalesce(array_to_string(list(x.doc_id ORDER BY x.doc_id) FILTER (WHERE x.doc_id IS NOT NULL), ','), '') AS negatives
FROM b a LEFT JOIN b x ON x.batch = a.batch AND x.doc_id <> a.doc_id GROUP BY a.doc_id, a.batch""")
def jon5(spark, sf):
    d = tables.table(spark, sf, "documents").select("doc_id")
    b = R.assign_batches(d, 16, [hash_key("doc_id", seed="42"), "doc_id"])
    n = V.in_batch_negatives(b, "batch", "doc_id")
    return n.select("doc_id", "batch", F.size("negatives").alias("n_negatives"),
                    arr_text("negatives").alias("negatives"))


@query("win5_no_duplicate_batches", """
WITH o AS (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) - 1 AS occ FROM documents)
SELECT doc_id, CAST(occ AS BIGINT) AS occ,
       CAST((row_number() OVER (PARTITION BY occ ORDER BY doc_id) - 1) // 16 AS BIGINT) AS batch_idx FROM o""")
def win5(spark, sf):
    d = tables.table(spark, sf, "documents").select("doc_id", "text")
    b = V.no_duplicate_batches(d, "text", "doc_id", 16)
    return b.select("doc_id", F.col("occ").cast("bigint").alias("occ"), "batch_idx")
