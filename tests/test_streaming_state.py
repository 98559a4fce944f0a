"""State that expires (STR-4…6): several arrivals against plain models, late
rows, restarts, empty arrivals, NULLs, a third of the rows on one key."""

import collections
import datetime as dt
import os
import random
import tempfile

from pyspark.sql import functions as F

from tokenmill.streaming import streams as S

T0 = dt.datetime(2024, 3, 1)
minutes = lambda m: T0 + dt.timedelta(minutes=m)


def write(spark, base, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(base, "in", name))


def read(spark, base, sub=""):
    return spark.read.parquet(os.path.join(base, "out", sub))


def source(spark, base, schema):
    return S.file_stream(spark, os.path.join(base, "in", "*"), "*.parquet", schema)


def test_sessions_close_once_and_late_rows_stay_out(spark):
    base, schema = tempfile.mkdtemp(prefix="tokenmill-stream-"), "user string, ts timestamp, v long, n string"

    def run():
        S.sessions_stream(source(spark, base, schema), os.path.join(base, "out"), os.path.join(base, "ckpt"), ("user",), "ts",
                          "10 minutes", "5 minutes", "v", state_partitions=2).awaitTermination()
        return {(r.user, r.session_start): (r.session_end, r.n, r.total, r.highest) for r in read(spark, base).collect()}

    rows = [("hot", minutes(m), m, "x") for m in range(0, 40, 4)] + [(None, minutes(1), 1, "x"), (None, minutes(9), None, "x")]
    rows += [("p", minutes(0), 1, "x"), ("p", minutes(25), 2, "x"), ("q", None, 5, "x")]
    write(spark, base, "a", rows, schema)
    done = run()  # watermark 31: sessions whose end is at most that
    assert done == {("p", minutes(0)): (minutes(10), 1, 1, 1), (None, minutes(1)): (minutes(19), 2, 1, 1)}
    write(spark, base, "b", [], schema)
    assert run() == done
    # p's open session goes on; a row of minute 2 is behind the watermark; hot's session is extended
    write(spark, base, "c", [("p", minutes(34), 3, "x"), ("p", minutes(2), 100, "x"), ("hot", minutes(45), 9, "x"), ("z", minutes(90), 1, "x")], schema)
    done |= {("p", minutes(25)): (minutes(44), 2, 5, 3), ("hot", minutes(0)): (minutes(55), 11, sum(range(0, 40, 4)) + 9, 36)}
    assert run() == done
    assert run() == done and read(spark, base).count() == len(done)  # nothing twice after a restart


def test_judgements_within_the_bound_and_rows_without_one(spark):
    base = tempfile.mkdtemp(prefix="tokenmill-stream-")
    schema = "side string, id long, k string, at timestamp"
    rng = random.Random(4)
    rows = []
    for i in range(240):
        k = "hot" if i % 3 == 0 else rng.choice(["p", "q", "r", None])
        rows.append((rng.choice("lr"), i, k, minutes(i // 2 + rng.randrange(3))))
    seen = rows[:160], rows[160:]

    def run():
        s = source(spark, base, schema)
        left = s.where("side = 'l'").select(F.col("id").alias("lid"), "k", F.col("at").alias("lt"))
        right = s.where("side = 'r'").select(F.col("id").alias("rid"), "k", F.col("at").alias("rt"))
        S.judged_stream(left, right, os.path.join(base, "out"), os.path.join(base, "ckpt"), "k", "lt", "rt", "10 minutes",
                        state_partitions=2).awaitTermination()
        return collections.Counter((r.lid, r.k, r.lt, r.rid, r.rt) for r in read(spark, base).collect())

    def model(rows):
        out = collections.Counter()
        left, right = ([r for r in rows if r[0] == s] for s in "lr")
        mark = min(max(r[3] for r in left), max(r[3] for r in right)) - dt.timedelta(minutes=5)
        for _, i, k, at in left:
            hits = [(j, t) for _, j, k2, t in right if k is not None and k == k2 and at <= t <= at + dt.timedelta(minutes=10)]
            for j, t in hits:
                out[i, k, at, j, t] += 1
            if not hits and at + dt.timedelta(minutes=10) < mark:
                out[i, k, at, None, None] += 1
        return out

    write(spark, base, "a", seen[0], schema)
    first = run()
    assert first == model(seen[0]) and any(x[3] is None for x in first)
    write(spark, base, "b", seen[1], schema)
    second = run()
    assert second == model(rows) and not first - second
    write(spark, base, "c", [("l", 999, "p", minutes(3)), ("r", 998, "hot", minutes(4))], schema)  # both behind the watermark
    assert run() == second


def dedup_model(arrivals, delay):
    kept, late, latest, state = [], [], None, {}
    for rows in arrivals:
        mark = None if latest is None else latest - delay
        first = {}
        for r in sorted((r for r in rows if r[2] is not None), key=lambda r: (r[2], r[0])):
            if mark is not None and r[2] < mark:
                late.append(r[0])
            else:
                first.setdefault(r[1], r)
        late += [r[0] for r in rows if r[2] is None]
        for k, r in first.items():
            if not any(t + delay >= mark for t in state.get(k, [])):
                kept.append(r[0])
        for k, r in first.items():
            if r[0] in kept:
                state.setdefault(k, []).append(r[2])
        latest = max([r[2] for r in rows if r[2] is not None] + ([latest] if latest else []), default=None)
    return sorted(kept), sorted(late)


def test_first_rows_and_late_rows_over_arrivals(spark):
    base, schema = tempfile.mkdtemp(prefix="tokenmill-stream-"), "id long, k string, ts timestamp, batch_id string, latest string, _k0 map<string,int>"
    rng = random.Random(6)
    arrivals = [[]]
    for n in range(4):
        rows = []
        for i in range(90):
            k = "hot" if i % 3 == 0 else rng.choice([None, "", *[f"k{j}" for j in range(60)]])
            ts = None if rng.random() < 0.03 else minutes(30 * n + rng.randrange(-40, 30))
            rows.append((1000 * n + i, k, ts))
        arrivals.append(rows + [(r[0] + 500, *r[1:]) for r in rows[:5]])
        if n == 1:
            arrivals.append([])
    delay = dt.timedelta(minutes=30)

    def run():
        S.dedup_stream(source(spark, base, schema), os.path.join(base, "out"), os.path.join(base, "ckpt"), ("k",), "ts", ("id",),
                       "30 minutes", state_partitions=2).awaitTermination()

    for n, rows in enumerate(arrivals):
        write(spark, base, f"a{n}", [(*r, "x", None, {"a": 1}) for r in rows], schema)
        run()
    want = dedup_model(arrivals, delay)
    one = lambda kind: sorted(r.id for r in spark.read.schema("id long").parquet(os.path.join(base, "out", kind)).collect())
    assert (one("kept"), one("late")) == want and len(want[1]) > 20
    run()  # nothing new
    assert (one("kept"), one("late")) == want


def test_a_batch_that_is_run_again_gives_the_same_rows(spark):
    """The second batch fails after its first sink; its retry sees earlier batches only."""
    base, schema = tempfile.mkdtemp(prefix="tokenmill-stream-"), "id long, k string, ts timestamp"
    out = os.path.join(base, "out")

    def run():
        S.dedup_stream(source(spark, base, schema), out, os.path.join(base, "ckpt"), ("k",), "ts", ("id",), "30 minutes").awaitTermination()

    write(spark, base, "a", [(1, "x", minutes(0)), (2, "y", minutes(50))], schema)
    run()
    write(spark, base, "b", [(3, "w", minutes(60)), (6, "x", minutes(61)), (4, "y", minutes(55)), (5, "z", minutes(1))], schema)
    # what a lost run of batch 1 may have left behind
    for kind in ("kept", "clock"):
        left = spark.createDataFrame([(9, "z", minutes(900))], schema) if kind == "kept" else \
            spark.createDataFrame([(minutes(900),)], "latest timestamp")
        left.write.parquet(os.path.join(out, kind, "batch_id=1"))
    run()
    kept = {(r.id, r.batch_id) for r in read(spark, base, "kept").collect()}
    assert kept == {(1, 0), (2, 0), (3, 1)}
    assert [(r.id, r.batch_id) for r in read(spark, base, "late").collect()] == [(5, 1)]
