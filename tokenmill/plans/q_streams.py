"""Registered queries: the streaming operators, run to completion with an
``availableNow`` trigger over the driver's Parquet files; the result is
the sink they wrote."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tokenmill.operators import rewards as W
from tokenmill.plans import tables
from tokenmill.plans.q_rewards import EQ_SQL, RAW_PAIRS
from tokenmill.plans.registry import query, r6
from tokenmill.session import scratch_path
from tokenmill.streaming import streams as S


def _run_dir(spark, name):
    return scratch_path(spark, f"stream-{name}-{uuid.uuid4().hex[:12]}")


def _schema(spark, sf, name):
    return tables.table(spark, sf, name).schema


@query("str1_score_stream", f"WITH {EQ_SQL} SELECT task_id, gen_idx, format_reward, equation_reward FROM r",
       views=True)
def str1(spark, sf):
    base = _run_dir(spark, "score")
    li = S.file_stream(spark, sf, "lineitem.parquet", _schema(spark, sf, "lineitem"))
    q = S.score_stream(tables.countdown_from(li), os.path.join(base, "out"), os.path.join(base, "ckpt"),
                       log_path=os.path.join(base, "log"))
    q.awaitTermination()
    return spark.read.parquet(os.path.join(base, "out")).select(
        "task_id", "gen_idx", "format_reward", "equation_reward")


@query("str2_pairs_stream", f"WITH {RAW_PAIRS} SELECT prompt_id, prompt, ground_truth, chosen, rejected FROM pairs",
       views=True)
def str2(spark, sf):
    base = _run_dir(spark, "pairs")
    li = S.file_stream(spark, sf, "lineitem.parquet", _schema(spark, sf, "lineitem"))
    c = tables.candidates_from(li, tables.table(spark, sf, "orders"))
    c = c.withColumn("correct", W.score_last_int("text", "ground_truth"))
    q = S.pairs_stream(c, os.path.join(base, "out"), os.path.join(base, "ckpt"),
                       state_partitions=spark.sparkContext.defaultParallelism)
    q.awaitTermination()
    return spark.read.parquet(os.path.join(base, "out")).select(
        "prompt_id", "prompt", "ground_truth", "chosen", "rejected")


@query("str3_latency_windows", """
, w AS (SELECT time_bucket(INTERVAL 60 SECOND, ts) AS window_start, * FROM load_samples),
mx AS (SELECT max(ts) - INTERVAL 5 MINUTE AS wm FROM load_samples)
SELECT window_start, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(failed AS INTEGER)) AS BIGINT) AS failures,
       round(avg(total_time), 6) AS avg, max(total_time) AS max, quantile_disc(total_time, 0.95) AS p95
FROM w, mx GROUP BY window_start, wm HAVING window_start + INTERVAL 60 SECOND <= wm""", views=True)
def str3(spark, sf):
    base = _run_dir(spark, "latency")
    ev = S.file_stream(spark, sf, "events.parquet", _schema(spark, sf, "events"))
    q = S.latency_windows(tables.load_samples_from(ev), os.path.join(base, "out"),
                          os.path.join(base, "ckpt"), "60 seconds", "5 minutes",
                          state_partitions=spark.sparkContext.defaultParallelism)
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(base, "out"))
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n", "failures",
                      r6("avg").alias("avg"), "max", "p95")


@query("str4_sessions", """
WITH g AS (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS nr FROM g),
w AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 2 HOUR AS session_end, count(*) AS n, round(sum(value), 6) AS total,
  max(value) AS highest FROM s GROUP BY user_id, nr)
SELECT * FROM w WHERE session_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def str4(spark, sf):
    base = _run_dir(spark, "sessions")
    ev = S.file_stream(spark, sf, "events.parquet", _schema(spark, sf, "events"))
    q = S.sessions_stream(ev, os.path.join(base, "out"), os.path.join(base, "ckpt"), ("user_id",), "ts", "2 hours", "10 minutes",
                          value="value", state_partitions=spark.sparkContext.defaultParallelism)
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(base, "out"))
    return out.select("user_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("session_start", "session_end")],
                      "n", r6("total").alias("total"), "highest")


@query("str5_judged_stream", """
WITH c AS (SELECT event_id AS click_id, user_id, ts AS clicked FROM events WHERE event_type = 'click'),
p AS (SELECT event_id AS purchase_id, user_id, ts AS bought FROM events WHERE event_type = 'purchase'),
m AS (SELECT least((SELECT max(clicked) FROM c), (SELECT max(bought) FROM p)) - INTERVAL 5 MINUTE AS wm),
j AS (SELECT c.*, purchase_id, bought FROM c LEFT JOIN p ON c.user_id = p.user_id AND bought >= clicked AND bought <= clicked + INTERVAL 6 HOUR)
SELECT click_id, user_id, clicked, purchase_id, bought FROM j, m WHERE purchase_id IS NOT NULL OR clicked + INTERVAL 6 HOUR < wm""")
def str5(spark, sf):
    """Clicks with the purchases of the next six hours, and clicks that had none."""
    base = _run_dir(spark, "judged")
    ev = S.file_stream(spark, sf, "events.parquet", _schema(spark, sf, "events"))
    clicks = ev.where("event_type = 'click'").select(F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("clicked"))
    bought = ev.where("event_type = 'purchase'").select(F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("bought"))
    q = S.judged_stream(clicks, bought, os.path.join(base, "out"), os.path.join(base, "ckpt"), "user_id", "clicked", "bought",
                        "6 hours", state_partitions=spark.sparkContext.defaultParallelism)
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(base, "out"))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("clicked", "bought")})


def _dedup_sql() -> str:
    """The three arrivals of str6, one after the other."""
    parts, kept = [], []
    for n in range(3):
        mark = f"(SELECT max(ts) - INTERVAL 1 HOUR FROM a WHERE slice < {n})"
        late = f"coalesce(ts < {mark}, false)"
        seen = " UNION ALL ".join(f"SELECT * FROM k{i}" for i in kept)
        gone = (f" AND NOT EXISTS (SELECT 1 FROM ({seen}) s WHERE s.user_id = f.user_id AND s.event_type = f.event_type "
                f"AND s.day = f.day AND s.ts + INTERVAL 1 HOUR >= {mark})") if kept else ""
        parts.append(f"l{n} AS (SELECT * FROM a WHERE slice = {n} AND {late})")
        parts.append(f"k{n} AS (SELECT * FROM (SELECT * FROM a WHERE slice = {n} AND NOT {late} QUALIFY row_number() OVER "
                     f"(PARTITION BY user_id, event_type, day ORDER BY ts, event_id) = 1) f WHERE true{gone})")
        kept.append(n)
    rows = " UNION ALL ".join(f"SELECT event_id, '{kind}' AS kind, CAST({n} AS INTEGER) AS batch FROM {kind[0]}{n}"
                              for kind in ("kept", "late") for n in range(3))
    return f"""
WITH t AS (SELECT *, CAST(ts AS DATE) AS day, ts + to_hours(CAST(CASE WHEN event_id % 5 = 0 THEN 12 ELSE 0 END AS INTEGER)) AS arrived FROM events),
b AS (SELECT epoch_us(min(arrived)) AS lo, epoch_us(max(arrived)) - epoch_us(min(arrived)) + 1 AS span FROM t),
a AS (SELECT t.*, 3 * (epoch_us(arrived) - lo) // span AS slice FROM t, b), {", ".join(parts)}
{rows}"""


@query("str6_dedup_stream", _dedup_sql())
def str6(spark, sf):
    """First event of a user, type and day over three arrivals; each fifth event arrives twelve hours late."""
    base = _run_dir(spark, "dedup")
    e = tables.table(spark, sf, "events")
    arrived = F.timestamp_add("HOUR", F.when(F.col("event_id") % 5 == 0, 12).otherwise(0), F.col("ts").cast("timestamp"))
    t = e.withColumn("day", F.to_date("ts")).withColumn("arrived", F.unix_micros(arrived))
    lo, hi = t.agg(F.min("arrived"), F.max("arrived")).first()
    src = os.path.join(base, "in")
    for n in range(3):
        if lo is not None or n == 0:
            own = F.floor((F.col("arrived") - (lo or 0)).cast("decimal(20,0)") * 3 / ((hi or 0) - (lo or 0) + 1)) == n
            t.where(own).drop("arrived").write.parquet(os.path.join(src, f"arrival-{n}"))
        stream = S.file_stream(spark, os.path.join(src, "*"), "*.parquet", t.drop("arrived").schema)
        q = S.dedup_stream(stream, os.path.join(base, "out"), os.path.join(base, "ckpt"), ("user_id", "event_type", "day"), "ts",
                           ("event_id",), "1 hour", state_partitions=spark.sparkContext.defaultParallelism)
        q.awaitTermination()
    sides = [spark.read.schema("event_id long, batch_id int").parquet(os.path.join(base, "out", kind)).select(
        "event_id", F.lit(kind).alias("kind"), F.col("batch_id").alias("batch")) for kind in ("kept", "late")]
    return sides[0].unionByName(sides[1])
