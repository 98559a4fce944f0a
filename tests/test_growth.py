"""Steps whose share of a task must not grow with the table."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenmill.operators import cubes as C
from tokenmill.operators import metrics as M
from tokenmill.operators import retrieval as V
from tokenmill.operators import tokens as T
from tokenmill.sources import io


def test_tasks_for_distinct_values_follow_their_number(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert C.value_tasks(spark.range(10), 3) == 1
    assert C.value_tasks(spark.range(3_000_000), 3) == max(parts, -(-9_000_000 // C.TASK_VALUES))


def test_distinct_counts_with_a_hot_value_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(C, "TASK_VALUES", 50)
    rows = [(None if i % 7 == 0 else i % 3, None if i % 11 == 0 else 5 if i % 2 else i % 40, i % 4) for i in range(400)]
    df = spark.createDataFrame(rows, "a int, x int, y int")
    got = {(r["grouping_id"], r["a"]): (r["n"], r["xs"], r["xys"]) for r in C.grouping_sets(
        df, ["a"], [("a",), ()], {"n": ("count", None)}, {"xs": "x", "xys": ["x", "y"]}).collect()}
    want = {}
    for key, mine in [((1, None), rows), *[((0, a), [r for r in rows if r[0] == a]) for a in (None, 0, 1, 2)]]:
        known = [r for r in mine if r[1] is not None]
        want[key] = (len(mine), len({r[1] for r in known}), len({r[1:] for r in known}))
    assert got == want


def test_a_file_for_each_row_in_one_folder(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tokenmill-files-"), "f")
    io.write_files(spark.createDataFrame([("a",), ("",), ("äö\nb",)], "value string").repartition(2), path)
    assert not any(os.path.isdir(os.path.join(path, x)) for x in os.listdir(path))
    files = io.read_images(spark, path, "*.txt").where("length > 0")
    assert sorted(r["length"] for r in files.collect()) == [1, 2, 7]


def test_ids_are_the_same_however_many_tokens_are_looked_up_at_once(spark, monkeypatch):
    d = spark.createDataFrame([(1, ["a", "b", "x"]), (2, None), (3, []), (4, ["b"] * 9), (5, ["c", "a"])], "k int, t array<string>")
    vocab = spark.createDataFrame([("a", 3), ("b", 4)], "token string, id int")
    want = {1: [3, 4, T.UNK_ID], 2: None, 3: [], 4: [4] * 9, 5: [T.UNK_ID, 3]}
    for n in (2, 5, T.LOOKUP_TOKENS):
        monkeypatch.setattr(T, "LOOKUP_TOKENS", n)
        got = T.encode(d.coalesce(1), "k", "t", vocab, method="broadcast").collect()
        assert {r["k"]: r["input_ids"] for r in got} == want


def test_packing_one_column_makes_no_struct_for_each_token(spark):
    d = spark.createDataFrame([(1, "a b c"), (2, ""), (3, "d e")], "k int, t string")
    p = T.pack_texts(d, ["k"], "t", 4)
    assert "transform(_tm_tokens" not in p._jdf.queryExecution().analyzed().toString()
    assert {r["block_id"]: r["input_ids"] for r in p.collect()} == {0: ["a", "b", "c", "<eos>"], 1: ["<eos>", "d", "e", "<eos>"]}


def test_lines_that_cover_no_further_place_are_not_compared(monkeypatch):
    calls = []
    real = M._lcs_positions
    monkeypatch.setattr(M, "_lcs_positions", lambda *a: calls.append(a) or real(*a))
    p = [(x, M._places(x)) for x in (("a", "b", "c"), ("b", "a"), ("c", "z"), ("q",))]
    assert M._union_positions(("a", "b", "c"), p) == [0, 1, 2] and len(calls) == 1


def test_hits_leave_a_task_some_queries_at_a_time(monkeypatch):
    monkeypatch.setattr(V._RunningTopK, "OUT_CHUNK", 2)
    monkeypatch.setattr(V._RunningTopK, "C_CHUNK", 16)
    rnd = np.random.default_rng(1)
    q, c = rnd.normal(size=(5, 4)), rnd.normal(size=(100, 4))
    top = V._RunningTopK(np.arange(5), q, (4, 2), 3)
    top.feed(np.arange(100), c, [str(i) for i in range(100)])
    got = list(top.batches([f"q{i}" for i in range(5)]))
    assert max(b.num_rows for b in got) == 6
    for d in (4, 2):
        s = (q[:, :d] / np.linalg.norm(q[:, :d], axis=1, keepdims=True)) @ (c[:, :d] / np.linalg.norm(c[:, :d], axis=1, keepdims=True)).T
        want = {(i, int(j), f"q{i}", str(j)) for i in range(5) for j in np.argsort(-s[i])[:3]}
        rows = [r for b in got for r in b.to_pylist() if r["dim"] == d]
        assert {(r["qid"], r["cid"], r["q_key"], r["c_key"]) for r in rows} == want


def _vectors(spark, n, name, seed):
    rnd = np.random.default_rng(seed)
    return spark.createDataFrame([(i, rnd.normal(size=8).tolist(), f"k{i % 7}") for i in range(n)],
                                 f"{name} long, embedding array<double>, rel_key string")


def _shuffled_rows(plan):
    """Rows that the exchanges of a plan that has run have written."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return _shuffled_rows(plan.executedPlan())
    if name.endswith("QueryStage"):
        return _shuffled_rows(plan.plan())
    written = plan.metrics().get("shuffleRecordsWritten")
    rows = written.get().value() if name == "Exchange" and written.isDefined() else 0
    return rows + sum(_shuffled_rows(plan.children().apply(i)) for i in range(plan.children().size()))


def test_small_query_blocks_share_a_copy_of_the_corpus(spark):
    q, c = _vectors(spark, 300, "qid", 3), _vectors(spark, 300, "cid", 4)
    hits = V.score_top_k(q, c, (8, 4), 2, broadcast_limit=0, query_block=1, corpus_buckets=2)
    assert len(hits.collect()) == 300 * 2 * 2
    assert 300 < _shuffled_rows(hits._jdf.queryExecution().executedPlan()) < 300 * 300 / 2


@pytest.mark.parametrize("kw", [{"query_block": 3, "corpus_buckets": 3}, {"block_bytes": 1}, {"query_block": 2, "block_bytes": 4000}])
def test_every_query_block_meets_every_bucket_on_many_partitions(spark, kw):
    """Blocked hits are those of the broadcast path, also when no shuffle is put together again."""
    q, c = _vectors(spark, 70, "qid", 5), _vectors(spark, 90, "cid", 6)
    q, c = q.union(q.where("qid < 4")), c.union(c.where("cid < 9")).union(c.where("cid = 1").selectExpr("100", "null", "'k'"))
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    was = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        want, got = (sorted((r.dim, r.qid, r["rank"], r.cid, round(r.score, 9), r.q_key, r.c_key) for r in V.score_top_k(
            q, c, (8, 4), 5, rel_key="rel_key", **path).collect()) for path in ({}, {"broadcast_limit": 0, **kw}))
    finally:
        spark.conf.set(conf, was)
    assert len(want) == 70 * 2 * 5 and got == want
    for a, b in ((q.limit(0), c), (q, c.limit(0))):
        assert V.score_top_k(a, b, (8, 4), 5, broadcast_limit=0, **kw).count() == 0


def test_columns_below_every_queries_hits_are_skipped():
    """Fed in any order and in pieces, with ties, the hits are those of one sort."""
    rnd = np.random.default_rng(8)
    q, c = rnd.integers(-2, 3, size=(6, 3)).astype(float), rnd.integers(-2, 3, size=(400, 3)).astype(float)
    for ids in (np.arange(400), rnd.permutation(400)):
        top = V._RunningTopK(np.arange(6), q, (3,), 4, keyed=False)
        for lo in range(0, 400, 60):
            top.feed(ids[lo:lo + 60], c[lo:lo + 60])
        s = np.round(V._unit_prefix(q, 3) @ V._unit_prefix(c, 3).T, 12)
        want = [sorted(zip(-s[i], ids, strict=True))[:4] for i in range(6)]
        got = [r for b in top.batches() for r in b.to_pylist()]
        assert [(r["qid"], r["cid"]) for r in got] == [(i, x) for i in range(6) for _, x in want[i]]


def test_repeated_relevant_pairs_count_once_on_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(V, "PAIRS_PER_TASK", 5)
    rnd = np.random.default_rng(2)
    q = spark.createDataFrame([(i, rnd.normal(size=4).tolist()) for i in range(6)], "qid long, embedding array<double>")
    c = spark.createDataFrame([(i, rnd.normal(size=4).tolist()) for i in range(40)], "cid long, embedding array<double>")
    pairs = q.select("qid").join(c.select("cid"), (F.col("qid") + F.col("cid")) % 3 == 0)
    once, twice = (V.matryoshka_eval(q, c, (4, 2), 5, qrels=x).orderBy("dim").collect() for x in (pairs, pairs.union(pairs)))
    assert once == twice and once[0]["recall_at_5"] > 0
    monkeypatch.setattr(V, "MAX_ASKED", 1)  # too many hits to broadcast
    assert V.matryoshka_eval(q, c, (4, 2), 5, qrels=pairs).orderBy("dim").collect() == once
