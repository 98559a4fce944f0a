"""Exact retrieval and its metrics (JON-1/2/5, WIN-2/5, MET-1…5, RUN-5).

Scoring every query against every corpus row is never materialised as a
pair table. The corpus stays partitioned; each task scores its rows
against a block of queries with one matrix product and keeps only the
top ``k`` per query and dimension. Partial top-k lists (``k`` rows per
query per task) are merged with a window-group limit.

* queries small enough (estimated size checked) -> broadcast to every
  corpus task (``mapInArrow``);
* otherwise queries are cut into blocks, blocks are dealt to stripes and
  corpus rows to buckets; a (stripe, bucket) is a group, sorted so that its
  queries come first and the corpus rows stream past them. The corpus is
  copied once per stripe, and stripes are as few as memory and cores allow.

Relevance is a key equality (``rel_key``): a query's relevant documents
are the corpus rows with its key, so qrels never become a pair list.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.operators.offsets import hash_key, with_positions
from tokenmill.session import BROADCAST_LIMIT_BYTES, bounded_size, broadcast_if_bounded, materialize

HITS_SCHEMA = "dim INT, qid BIGINT, cid BIGINT, score DOUBLE"
KEYED_SCHEMA = HITS_SCHEMA + ", q_key STRING, c_key STRING"
PAIRS_PER_TASK = 1_000_000  # relevant pairs that a task holds at once
MAX_ASKED = 2_000_000  # hits that are broadcast to the relevant pairs


def _unit_prefix(mat: np.ndarray, dim: int) -> np.ndarray:
    m = mat[:, :dim].astype(np.float64)
    n = np.linalg.norm(m, axis=1, keepdims=True)
    n[n == 0] = 1.0
    return m / n


class _RunningTopK:
    """Per query the best ``k`` (score desc, cid asc) seen so far, fed with
    corpus batches; memory is the queries, ``queries x k`` and one score
    block of ``Q_CHUNK x C_CHUNK``. An optional key per corpus row travels
    with its id."""

    Q_CHUNK, C_CHUNK = 512, 2048
    OUT_CHUNK = 4096  # queries of an output batch

    def __init__(self, q_ids: np.ndarray, q_mat: np.ndarray, dims, k: int, keyed: bool = True):
        self.q_ids, self.q_mat, self.dims, self.k = q_ids, q_mat, list(dims), k
        nq = len(q_ids)
        # empty slots: score -inf, id max (sorted last, dropped at the end)
        self.best_s = {d: np.full((nq, k), -np.inf) for d in self.dims}
        self.best_c = {d: np.full((nq, k), np.iinfo(np.int64).max, dtype=np.int64)
                       for d in self.dims}
        self.best_k = {d: np.full((nq, k), None, dtype=object) for d in self.dims} if keyed else None

    def feed(self, c_ids: np.ndarray, c_mat: np.ndarray, c_keys=None) -> None:
        if len(c_ids) == 0 or len(self.q_ids) == 0:
            return
        keys = np.asarray(c_keys if c_keys is not None else [None] * len(c_ids), dtype=object) \
            if self.best_k is not None else None
        for at in range(0, len(c_ids), self.C_CHUNK):
            part = slice(at, at + self.C_CHUNK)
            for d in self.dims:
                cu = _unit_prefix(c_mat[part], d)
                for lo in range(0, len(self.q_ids), self.Q_CHUNK):
                    hi = min(lo + self.Q_CHUNK, len(self.q_ids))
                    s = _unit_prefix(self.q_mat[lo:hi], d) @ cu.T
                    np.round(s, 12, out=s)
                    self._merge(d, lo, hi, s, c_ids[part], None if keys is None else keys[part])

    def _merge(self, d, lo, hi, s, c_ids, keys):
        k = self.k
        # columns below the k-th best of every query change nothing
        near = np.flatnonzero((s >= self.best_s[d][lo:hi, k - 1:]).any(axis=0))
        if len(near) == 0:
            return
        if len(near) < s.shape[1]:
            s, c_ids, keys = s[:, near], c_ids[near], None if keys is None else keys[near]
        if s.shape[1] > k:
            # keep every column tied with the k-th best so ties resolve by cid
            part = np.argpartition(-s, k - 1, axis=1)[:, :k]
            thr = np.take_along_axis(s, part, 1).min(axis=1, keepdims=True)
            width = int((s >= thr).sum(axis=1).max())
            cols = np.argpartition(-s, width - 1, axis=1)[:, :width] if width > k else part
        else:
            cols = np.broadcast_to(np.arange(s.shape[1]), s.shape)
        all_s = np.concatenate([self.best_s[d][lo:hi], np.take_along_axis(s, cols, 1)], axis=1)
        all_c = np.concatenate([self.best_c[d][lo:hi], c_ids[cols]], axis=1)
        order = np.lexsort((all_c, -all_s), axis=1)[:, :k]
        self.best_s[d][lo:hi] = np.take_along_axis(all_s, order, 1)
        self.best_c[d][lo:hi] = np.take_along_axis(all_c, order, 1)
        if keys is not None:
            all_k = np.concatenate([self.best_k[d][lo:hi], keys[cols]], axis=1)
            self.best_k[d][lo:hi] = np.take_along_axis(all_k, order, 1)

    def batches(self, q_keys=None):
        """The hits as record batches, some queries at a time."""
        for d in self.dims:
            for lo in range(0, len(self.q_ids), self.OUT_CHUNK):
                at = slice(lo, lo + self.OUT_CHUNK)
                bs = self.best_s[d][at]
                rows, cols = np.nonzero(np.isfinite(bs))
                out = {"dim": pa.array(np.full(len(rows), d, np.int32)), "qid": pa.array(self.q_ids[at][rows]),
                       "cid": pa.array(self.best_c[d][at][rows, cols]), "score": pa.array(bs[rows, cols])}
                if self.best_k is not None:
                    out["q_key"] = pa.array([q_keys[lo + r] for r in rows.tolist()], pa.string())
                    out["c_key"] = pa.array(self.best_k[d][at][rows, cols].tolist(), pa.string())
                yield pa.RecordBatch.from_pydict(out)


def _stack(vectors) -> np.ndarray:
    if len(vectors) == 0:
        return np.zeros((0, 0))
    return np.vstack([np.asarray(v, dtype=np.float64) for v in vectors])


def _matrix(vectors) -> np.ndarray:
    """An Arrow column of vectors as a matrix, without Python numbers."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    if len(sizes) and sizes[0] > 0 and (sizes == sizes[0]).all():
        return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(sizes), -1)
    return _stack(vectors.to_pylist())


def _ids(column) -> np.ndarray:
    return column.fill_null(np.iinfo(np.int64).min).to_numpy()


def score_top_k(queries: DataFrame, corpus: DataFrame, dims: Sequence[int], k: int = 10,
                q_id: str = "qid", c_id: str = "cid", vec: str = "embedding",
                broadcast_limit: int = BROADCAST_LIMIT_BYTES, query_block: int | None = None,
                corpus_buckets: int | None = None, rel_key: str | None = None,
                block_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """Exact top-``k`` corpus rows per query by cosine similarity, for every
    truncation width in ``dims``. Returns ``dim, qid, cid, score, rank``
    (+ ``q_key, c_key`` as strings when ``rel_key`` names a relevance key
    column on both sides: it travels with the vectors, so marking hits
    relevant needs no join back to either table).

    Vectors are cut to the widest width in ``dims`` before anything moves.
    On the blocked path a query block holds about ``block_bytes`` of
    vectors and hits (unless ``query_block`` fixes its row count). Small
    blocks share a stripe of about ``block_bytes``: the corpus is copied once
    per stripe, so the shuffle grows with the rows of both sides until a
    stripe is full. Corpus rows are dealt to ``corpus_buckets`` (else one per
    core), which are streamed and never held.
    Rows without a vector find nothing and are never found."""
    dims = [int(d) for d in dims]
    width = max(dims)
    kq = [F.col(rel_key).cast("string").alias("key")] if rel_key else []
    q = queries.select(F.col(q_id).cast("bigint").alias("qid"), F.slice(vec, 1, width).alias("v"), *kq) \
        .where("v is not null")
    c = corpus.select(F.col(c_id).cast("bigint").alias("cid"), F.slice(vec, 1, width).alias("v"), *kq) \
        .where("v is not null")
    if _fits_broadcast(q, max(dims), broadcast_limit):
        partial = _broadcast_path(q, c, dims, k, bool(rel_key))
    else:
        partial = _blocked_path(q, c, dims, k, query_block, corpus_buckets, bool(rel_key), block_bytes)
    return top_k_per_key(partial, ["dim", "qid"], "score", k, tiebreak="cid")


def _fits_broadcast(q: DataFrame, width: int, limit: int) -> bool:
    """Proven bound for the query block: a bounded row count (at most
    ``max_rows + 1`` rows are read) times the bytes of one vector."""
    if limit <= 0:
        return False
    max_rows = max(1, limit // (width * 8 + 64))
    return q.limit(max_rows + 1).count() <= max_rows


def _broadcast_path(q: DataFrame, c: DataFrame, dims, k, keyed: bool) -> DataFrame:
    spark = q.sparkSession
    # size-checked above; the query block travels once per executor
    rows = q.toArrow() if hasattr(q, "toArrow") else pa.Table.from_pandas(q.toPandas())
    q_ids = np.asarray(rows.column("qid").to_pylist(), dtype=np.int64)
    q_mat = _matrix(rows.column("v"))
    q_keys = rows.column("key").to_pylist() if keyed else None
    bq = spark.sparkContext.broadcast((q_ids, q_mat, q_keys))

    def run(batches):
        qi, qm, qk = bq.value
        top = _RunningTopK(qi, qm, dims, k, keyed)
        for b in batches:
            if b.num_rows:
                top.feed(np.asarray(b.column("cid").to_pylist(), dtype=np.int64), _matrix(b.column("v")),
                         b.column("key").to_pylist() if keyed else None)
        yield from top.batches(qk)

    # one partial list per task: input partitions are read in groups, so the
    # lists follow the session's partition count, not the number of files
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    return c.coalesce(tasks).mapInArrow(run, KEYED_SCHEMA if keyed else HITS_SCHEMA)


def _blocked_path(q: DataFrame, c: DataFrame, dims, k, query_block, corpus_buckets,
                  keyed: bool, block_bytes: int) -> DataFrame:
    # a query in a task: its vector, and its best k of every width
    query_bytes = max(dims) * 8 + 64 + len(dims) * k * (24 if keyed else 16)
    query_block = query_block or max(1024, block_bytes // query_bytes)
    cores = q.sparkSession.sparkContext.defaultParallelism
    # by the cores, not the data: every bucket gives k hits of a query
    nb = corpus_buckets or cores
    qpos = with_positions(q, ["qid"], pos_col="_pos")
    qb = qpos.select("qid", "v", *(["key"] if keyed else []),
                     F.floor(F.col("_pos") / query_block).alias("qblock"))
    n_blocks = qb.agg(F.max("qblock")).first()[0]
    n_blocks = 0 if n_blocks is None else int(n_blocks) + 1
    full = max(1, block_bytes // (query_bytes * query_block))  # blocks of a stripe
    stripes = max(1, min(n_blocks, max(-(-2 * cores // nb), -(-n_blocks // full))))
    groups = stripes * nb
    q_rep = qb.withColumn("stripe", F.pmod("qblock", F.lit(stripes))).drop("qblock") \
        .withColumn("cbucket", F.explode(F.sequence(F.lit(0), F.lit(nb - 1)))).withColumn("corpus", F.lit(False))
    c_rep = c.withColumnRenamed("cid", "qid").withColumn("cbucket", F.pmod(F.xxhash64("qid"), F.lit(nb))) \
        .withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))).withColumn("corpus", F.lit(True))
    at = (F.col("stripe") * nb + F.col("cbucket")).alias("at")
    rows = q_rep.unionByName(c_rep).select(at, "corpus", F.col("qid").alias("id"), "v", *(["key"] if keyed else []))

    def run(batches):
        group, queries, top, q_keys = None, [], None, None
        for b in batches:
            ats = b.column("at").to_numpy()
            sides = b.column("corpus").to_numpy(zero_copy_only=False)
            turns = np.flatnonzero((ats[1:] != ats[:-1]) | (sides[1:] != sides[:-1])) + 1
            for lo, hi in zip([0, *turns.tolist()], [*turns.tolist(), len(ats)], strict=True):
                if hi == lo:
                    continue
                if ats[lo] != group:
                    if top is not None:
                        yield from top.batches(q_keys)
                    group, queries, top = ats[lo], [], None
                part = b.slice(lo, hi - lo)
                if not sides[lo]:
                    queries.append(part)
                elif queries or top is not None:
                    if top is None:
                        held = pa.Table.from_batches(queries)
                        q_keys = held.column("key").to_pylist() if keyed else None
                        top = _RunningTopK(_ids(held.column("id")), _matrix(held.column("v")), dims, k, keyed)
                        queries = []
                    top.feed(_ids(part.column("id")), _matrix(part.column("v")),
                             part.column("key").to_pylist() if keyed else None)
        if top is not None:
            yield from top.batches(q_keys)

    # more ranges than groups, so that each group is a range and a task
    return (rows.repartitionByRange(4 * groups, "at").sortWithinPartitions("at", "corpus")
            .mapInArrow(run, KEYED_SCHEMA if keyed else HITS_SCHEMA))


# WIN-2 ---------------------------------------------------------------
def top_k_per_key(df: DataFrame, key: Sequence[str] | str, score: str, k: int,
                  tiebreak: str | None = None, rank_col: str = "rank") -> DataFrame:
    """Top ``k`` rows per key by descending score (1-based ``rank``).
    Spark plans a window-group limit: each task keeps ``k`` rows per key
    before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(score).desc()] + ([F.col(tiebreak).asc()] if tiebreak else [])
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


# JON-1 ---------------------------------------------------------------
def qrels_join(hits: DataFrame, qrels: DataFrame, on: Sequence[str] = ("qid", "rel_key")) -> DataFrame:
    """Mark each retrieved row relevant when (qid, rel_key) is in ``qrels``."""
    marks = qrels.select(*on).distinct().withColumn("relevant", F.lit(1))
    return hits.join(marks, list(on), "left").fillna(0, subset=["relevant"])


# MET-1 … MET-5 ------------------------------------------------------------
def ir_metrics(hits: DataFrame, n_relevant: DataFrame, k: int = 10,
               by: Sequence[str] = ("dim",)) -> DataFrame:
    """NDCG, MRR, MAP, recall, precision and hit rate at ``k`` per group,
    averaged over all queries of ``n_relevant``: a query without a relevant
    row, without a relevant hit or without any hit counts 0 in all of them.

    ``hits``: ``by…, qid, rank, relevant``; ``n_relevant``: ``qid, n_rel``.
    """
    keys = list(by)
    n_relevant = materialize(n_relevant)
    n_queries = n_relevant.count()
    h = hits.where(F.col("rank") <= k)
    rel = F.col("relevant")
    # running count of relevant hits up to each rank (per query: <= k rows)
    w = Window.partitionBy(*keys, "qid").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumn("_cum", F.sum(rel).over(w))
    per_q = h.groupBy(*keys, "qid").agg(
        F.sum(rel / F.log2(F.col("rank") + 1)).alias("dcg"),
        F.max(rel / F.col("rank")).alias("rr"),
        F.sum(rel * F.col("_cum") / F.col("rank")).alias("ap_sum"),
        F.sum(rel).alias("n_hit"))
    per_q = per_q.join(broadcast_if_bounded(n_relevant, 2_000_000), "qid")
    ideal = F.when(F.col("n_rel") > 0, F.aggregate(
        F.sequence(F.lit(1), F.least(F.col("n_rel"), F.lit(k)).cast("int")),
        F.lit(0.0), lambda acc, i: acc + 1.0 / F.log2(i + 1))).otherwise(F.lit(0.0))
    per_q = per_q.select(
        *keys, "qid",
        (F.col("dcg") / F.nullif(ideal, F.lit(0.0))).alias("ndcg"),
        F.col("rr").alias("mrr"),
        (F.col("ap_sum") / F.nullif(F.least(F.col("n_rel"), F.lit(k)).cast("double"), F.lit(0.0)))
        .alias("map"),
        (F.col("n_hit") / F.nullif(F.col("n_rel").cast("double"), F.lit(0.0))).alias("recall"),
        (F.col("n_hit") / F.lit(float(k))).alias("precision"),
        (F.col("n_hit") > 0).cast("double").alias("accuracy"))
    # one denominator for all metrics
    return per_q.groupBy(*keys).agg(*[
        (F.sum(F.coalesce(m, F.lit(0.0))) / F.lit(float(max(1, n_queries)))).alias(f"{m}_at_{k}")
        for m in ("ndcg", "mrr", "map", "recall", "precision", "accuracy")])


def matryoshka_eval(queries: DataFrame, corpus: DataFrame, dims: Sequence[int], k: int = 10,
                    q_id: str = "qid", c_id: str = "cid", vec: str = "embedding",
                    rel_key: str = "rel_key", qrels: DataFrame | None = None, **kw) -> DataFrame:
    """All metrics at every truncation width in one pass over the corpus;
    ``key`` is the result name ``dim_{d}_cosine_ndcg@{k}``. Relevant are the
    pairs of ``qrels(qid, cid)``, or, without it, rows of the same
    ``rel_key`` (counted once per key on the corpus)."""
    if qrels is not None:
        q = F.col("qid").cast("bigint").alias("qid")
        pairs = qrels.select(q, F.col("cid").cast("bigint").alias("cid"))
        # dealt before repeats go: a task holds its share of the pairs, however many there are
        n_tasks = max(1, -(-pairs.count() // PAIRS_PER_TASK))
        dealt = pairs.repartition(n_tasks, "qid", "cid")
        hits = materialize(score_top_k(queries, corpus, dims, k, q_id, c_id, vec, **kw))
        asked = hits.select("qid", "cid").distinct()
        rows, size = bounded_size(asked, MAX_ASKED)
        # only pairs that were hit are marks
        met = (pairs.join(F.broadcast(asked), ["qid", "cid"], "left_semi") if rows <= MAX_ASKED and size <= BROADCAST_LIMIT_BYTES
               else dealt.join(asked, ["qid", "cid"], "left_semi"))
        marked = qrels_join(hits, met, ("qid", "cid"))
        pairs = dealt.distinct()
        n_rel = (queries.select(F.col(q_id).cast("bigint").alias("qid")).distinct()
                 .join(pairs.groupBy("qid").agg(F.count(F.lit(1)).alias("n_rel")), "qid", "left").fillna(0, subset=["n_rel"]))
        return _named(ir_metrics(marked, n_rel, k), k)
    hits = score_top_k(queries, corpus, dims, k, q_id, c_id, vec, rel_key=rel_key, **kw)
    marked = hits.withColumn("relevant", (F.col("c_key") == F.col("q_key")).cast("int"))
    per_key = corpus.groupBy(F.col(rel_key).cast("string").alias("q_key")) \
        .agg(F.count(F.lit(1)).alias("n_rel"))
    q_keys = queries.select(F.col(q_id).cast("bigint").alias("qid"),
                            F.col(rel_key).cast("string").alias("q_key"))
    n_rel = q_keys.join(per_key, "q_key", "left").fillna(0, subset=["n_rel"]).select("qid", "n_rel")
    return _named(ir_metrics(marked, n_rel, k), k)


def _named(m: DataFrame, k: int) -> DataFrame:
    return m.withColumn("key", F.concat(F.lit("dim_"), F.col("dim").cast("string"),
                                        F.lit(f"_cosine_ndcg@{k}")))


# RUN-5 ---------------------------------------------------------------
def retention(metrics: DataFrame, dim: str, value: str, full_dim: int) -> DataFrame:
    """Score at each width divided by the score at the full width (the
    metrics table has one row per width: a one-partition window is fine)."""
    full = F.max(F.when(F.col(dim) == full_dim, F.col(value))).over(Window.partitionBy(F.lit(0)))
    return metrics.select(dim, value, (F.col(value) / full).alias("retention"))


# JON-5 ---------------------------------------------------------------
def in_batch_negatives(df: DataFrame, batch: str, id_col: str) -> DataFrame:
    """For each row the ids of the other rows of its batch (batches are
    bounded by the batch size, so the lists are too)."""
    members = df.groupBy(batch).agg(F.collect_list(id_col).alias("_tm_m"))
    j = df.join(members, batch)
    return j.withColumn("negatives", F.array_sort(F.filter("_tm_m", lambda x: x != F.col(id_col)))) \
        .drop("_tm_m")


# WIN-5 ---------------------------------------------------------------
def no_duplicate_batches(df: DataFrame, text: str, order: str, size: int) -> DataFrame:
    """Batches of ``size`` rows in which no text repeats.

    Each row gets its occurrence number among equal texts (``occ``), rows
    are laid out stripe by stripe (all first occurrences, then all second
    ones, …) and batches are cut inside a stripe, so two copies of a text
    never share a batch. Occurrence numbers come from global positions in
    (text hash, order) minus the first position of the text: a hot text is
    spread over many buckets instead of one window partition.
    """
    # rows are numbered in (text hashes, order): copies of a text are
    # consecutive; a hot text is split across buckets by its order values.
    # Two hashes (124 bits) stand for the text.
    named = df.withColumn("_tm_th", F.xxhash64(text)).withColumn("_tm_md", hash_key(F.coalesce(F.col(text), F.lit(""))))
    pos = with_positions(named, ["_tm_th", "_tm_md", order], pos_col="_tm_p")
    first = pos.groupBy("_tm_th", "_tm_md").agg(F.min("_tm_p").alias("_tm_p0"))
    occ = pos.join(first, ["_tm_th", "_tm_md"]).withColumn("occ", F.col("_tm_p") - F.col("_tm_p0")) \
        .drop("_tm_p", "_tm_p0", "_tm_th", "_tm_md")
    occ = materialize(occ)  # read three times below
    laid = with_positions(occ, ["occ", order], pos_col="_tm_g")
    stripe0 = laid.groupBy("occ").agg(F.min("_tm_g").alias("_tm_g0"))
    # one row per occurrence number (max occ + 1 rows, read off the
    # checkpointed table): broadcast only when that bound is small
    n_stripes = (occ.agg(F.max("occ")).first()[0] or 0) + 1
    out = laid.join(F.broadcast(stripe0) if n_stripes <= 1_000_000 else stripe0, "occ")
    return out.withColumn("batch_idx", F.floor((F.col("_tm_g") - F.col("_tm_g0")) / size).cast("bigint")) \
        .drop("_tm_g", "_tm_g0")
