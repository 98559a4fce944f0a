"""Streaming semantics: late rows are dropped by the watermark, a window
is emitted once the watermark passes it, and a re-started query with the
same checkpoint does not emit the same input twice."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from tokenmill.streaming import streams as S

SCHEMA = "event_id BIGINT, ts TIMESTAMP, total_time DOUBLE, failed BOOLEAN"


def _write(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(os.path.join(folder, name))


def test_latency_windows_watermark_and_late_rows(spark):
    base = tempfile.mkdtemp(prefix="tokenmill-stream-")
    src = os.path.join(base, "in")
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    first = [(i, t0 + dt.timedelta(seconds=30 * i), float(i), False) for i in range(40)]  # 0 .. 19.5 min
    _write(spark, src, "a", first)
    q = S.latency_windows(S.file_stream(spark, src + "/*", "*.parquet", SCHEMA), os.path.join(base, "out"),
                          os.path.join(base, "ckpt"), "60 seconds", "2 minutes", available_now=True,
                          state_partitions=2)
    q.awaitTermination()
    # a late row for minute 1 arrives after the watermark (19.5 - 2 min) passed it
    _write(spark, src, "b", [(999, t0 + dt.timedelta(seconds=70), 1000.0, True)])
    q = S.latency_windows(S.file_stream(spark, src + "/*", "*.parquet", SCHEMA), os.path.join(base, "out"),
                          os.path.join(base, "ckpt"), "60 seconds", "2 minutes", available_now=True,
                          state_partitions=2)
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(base, "out"))
    rows = {r.window_start.replace(tzinfo=None): r for r in out.collect()}
    minute1 = rows[t0 + dt.timedelta(minutes=1)]
    assert minute1.n == 2 and minute1.failures == 0 and minute1.max == 3.0  # late row dropped
    # windows ending after the watermark (17.5 min) are still open
    assert max(rows) <= t0 + dt.timedelta(minutes=16)
    assert sum(r.n for r in rows.values()) == 34


def test_score_stream_exactly_once(spark):
    base = tempfile.mkdtemp(prefix="tokenmill-stream-")
    src = os.path.join(base, "in")
    schema = "task_id BIGINT, gen_idx INT, nums ARRAY<BIGINT>, target BIGINT, completion STRING"
    rows = [(i, 0, [1, i], 1 + i, f" x</think>\n<answer>1 + {i}</answer>") for i in range(1, 30)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(src, "a"))
    for _ in range(2):  # second start: nothing new to process
        q = S.score_stream(S.file_stream(spark, src + "/*", "*.parquet", schema), os.path.join(base, "out"),
                           os.path.join(base, "ckpt"))
        q.awaitTermination()
    out = spark.read.parquet(os.path.join(base, "out"))
    assert out.count() == len(rows)
    assert out.agg(F.min("equation_reward"), F.min("format_reward")).first() == (1.0, 1.0)


def test_pairs_stream_bounded_state(spark):
    base = tempfile.mkdtemp(prefix="tokenmill-stream-")
    src = os.path.join(base, "in")
    schema = "prompt_id BIGINT, cand_idx BIGINT, text STRING, ground_truth STRING, prompt STRING, at TIMESTAMP"
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for p in range(20):
        for i, txt in enumerate(["no", "it is 5", "maybe 4"]):
            rows.append((p, i, txt, "5", f"q{p}", t0 + dt.timedelta(minutes=3 * p, seconds=i)))
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(src, "a"))
    c = S.file_stream(spark, src + "/*", "*.parquet", schema)
    from tokenmill.operators import rewards as W
    c = c.withColumn("correct", W.score_last_int("text", "ground_truth"))
    q = S.pairs_stream(c, os.path.join(base, "out"), os.path.join(base, "ckpt"), carry=("prompt",),
                       arrival="at", window="10 minutes", delay="5 minutes", state_partitions=2)
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(base, "out")).collect()
    # windows that closed under the watermark (max 57 min - 5 min) are emitted, the rest stay open
    assert 0 < len(out) < 20
    assert all(r.chosen == "it is 5" and r.rejected == "no" for r in out)
