"""Correctness with one key holding a third of all rows (the operators
split or pre-aggregate hot groups; results must stay exact)."""

import random
import statistics

import pytest

from tokenmill.operators import rewards as W
from tokenmill.operators.offsets import with_positions
from tokenmill.operators import sample as S


def _cands(n=3000):
    rnd = random.Random(9)
    rows = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rnd.randint(1, 300)  # key 0: a third of the rows
        rows.append((key, i, rnd.choice(["", "7", "x 7", "8", "no"]), "7"))
    return rows


def test_pairs_with_hot_prompt(spark):
    rows = _cands()
    df = spark.createDataFrame(rows, "k int, idx int, text string, truth string")
    df = df.withColumn("correct", W.score_last_int("text", "truth"))
    got = {r.k: (r.chosen, r.rejected) for r in
           W.preference_pairs(df, "k", "idx", "text", "correct").collect()}
    want = {}
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        ok = [r[2] for r in mine if r[2].split()[-1:] == ["7"]]
        bad = [r[2] for r in mine if r[2].split()[-1:] != ["7"]]
        if ok and bad and ok[0] and bad[0]:
            want[k] = (ok[0], bad[0])
    assert got == want


def test_group_advantage_with_hot_prompt(spark):
    rows = [(0 if i % 3 == 0 else i % 50 + 1, i, float(i % 7)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, i int, r double")
    got = {x.i: x.advantage for x in W.group_advantage(df, "k", "r").collect()}
    groups = {}
    for k, i, r in rows:
        groups.setdefault(k, []).append(r)
    for k, i, r in rows:
        g = groups[k]
        assert got[i] == pytest.approx((r - statistics.mean(g)) / (statistics.stdev(g) + 1e-4))


def test_positions_with_hot_order_value(spark):
    rows = [(0 if i % 3 == 0 else i, (i * 7919) % 3001) for i in range(3000)]  # a third share k = 0
    df = spark.createDataFrame(rows, "k long, id long")
    pos = with_positions(df, ["k", "id"], n_buckets=16)
    got = {(r.k, r.id): r.row_id for r in pos.collect()}
    assert got == {key: p for p, key in enumerate(sorted(rows))}
    # the hot value is spread over several buckets (level-2 split)
    from tokenmill.operators.offsets import _bucketize
    from pyspark.sql import functions as F
    b = _bucketize(df, [F.col("k"), F.col("id")], 16)
    hot_buckets = b.where("k = 0").select("_tm_bucket").distinct().count()
    assert hot_buckets >= 8


def test_exact_split_sizes(spark):
    df = spark.range(0, 1003).withColumnRenamed("id", "doc_id")
    s = S.split_fraction(df, 0.1, 42, "doc_id")
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"test": 101, "train": 902}


def test_first_n_matches_sort(spark):
    from tokenmill.operators.offsets import first_n
    rows = [((i * 7919) % 1009, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, id long")
    for n in (0, 1, 137, 1999, 2000, 5000):
        got = {r.id for r in first_n(df, ["k", "id"], n=n, n_buckets=16).where("_tm_first").collect()}
        assert got == {i for _, i in sorted(rows)[:n]}
    got = {r.id for r in first_n(df, ["k", "id"], fraction=0.1, n_buckets=16).where("_tm_first").collect()}
    assert got == {i for _, i in sorted(rows)[:200]}


def test_rows_at_matches_sort(spark):
    from tokenmill.operators.offsets import rows_at
    rows = [((i * 7919) % 1009, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, id long")
    order = sorted(rows)
    got = {r.row_id: r.id for r in rows_at(df, ["k", "id"], [0, 17, 999, 1999, 2500], n_buckets=16).collect()}
    assert got == {p: order[p][1] for p in (0, 17, 999, 1999)}
