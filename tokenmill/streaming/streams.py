"""Structured Streaming forms of three batch loops (STR-1…3), and sessions,
judged completions and deduplication with state that expires (STR-4…6).

* ``score_stream``: stateless — rewards over arriving completions; each
  micro-batch is written under its own ``batch_id`` folder (overwrite, so
  a retried batch replaces its output: idempotent), plus a sampled log.
* ``pairs_stream``: stateful — running preference pairs per prompt with a
  streaming ``min_by … FILTER`` aggregate (state grows with the number of
  prompts; bound it with a watermark on an arrival column when there is
  one).
* ``latency_windows``: event-time windows with a watermark; late rows are
  dropped, a window is emitted once the watermark passes its end.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.operators import rewards as W
from tokenmill.sources import io
from tokenmill.sources.io import LOG_SEPARATOR


def _start(writer, spark: SparkSession, state_partitions: int | None):
    """Start a stream; ``state_partitions`` fixes the number of state-store
    partitions of a stateful query (captured at start and kept in its
    checkpoint), without changing the session for other queries."""
    if not state_partitions:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, old)


def file_stream(spark: SparkSession, folder: str, pattern: str, schema,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of ``folder`` matching ``pattern`` as a stream."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder)


# STR-1 ---------------------------------------------------------------
def score_stream(completions: DataFrame, out_path: str, checkpoint: str, log_path: str | None = None,
                 log_fraction: float = 0.1, key: tuple[str, ...] = ("task_id", "gen_idx"),
                 available_now: bool = True, reward_fns: dict | None = None, success: str = "equation_reward"):
    """Score arriving completions and append them; ``log_fraction`` of all
    completions and, separately, of the successes go to two text logs.

    ``reward_fns`` are functions as for ``rewards.rewards`` (format and
    equation reward by default); a reward ``success`` of 1 is a success."""
    fns = reward_fns or {"format_reward": lambda d: W.format_reward("completion"),
                         "equation_reward": lambda d: W.equation_value("completion", "target", "nums")}

    def write(batch: DataFrame, batch_id: int) -> None:
        scored = W.rewards(batch, fns, total=None)
        scored = scored.withColumn("batch_id", F.lit(batch_id))
        # three sinks read the micro-batch: score it once (a lost block is
        # recomputed from the batch's own input)
        scored = scored.persist()
        scored.write.mode("overwrite").parquet(os.path.join(out_path, f"batch_id={batch_id}"))
        if log_path:
            text = F.concat(F.lit(LOG_SEPARATOR + "<think>"), F.col("completion")).alias("value")
            io.sample_fraction(scored, log_fraction, "completion", *key).select(text) \
                .write.mode("overwrite").text(os.path.join(log_path, "completion_samples", f"batch_id={batch_id}"))
            good = scored.where(F.col(success) >= 1.0)
            io.sample_fraction(good, log_fraction, "success", *key).select(text) \
                .write.mode("overwrite").text(os.path.join(log_path, "success_completion_samples",
                                                           f"batch_id={batch_id}"))
        scored.unpersist()

    w = completions.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


# STR-2 ---------------------------------------------------------------
def pairs_stream(candidates: DataFrame, out_path: str, checkpoint: str, key: str = "prompt_id",
                 idx: str = "cand_idx", text: str = "text", correct: str = "correct",
                 carry: tuple[str, ...] = ("prompt", "ground_truth"), available_now: bool = True,
                 state_partitions: int | None = None, arrival: str | None = None,
                 window: str = "10 minutes", delay: str = "10 minutes"):
    """Running first-correct / first-wrong candidate per prompt.

    Without ``arrival`` each trigger rewrites the complete pair table
    (complete mode; one state row per prompt, kept forever). With an
    ``arrival`` time column, candidates are grouped per prompt and
    event-time ``window`` under a watermark: a prompt's pair is appended
    once its window closes and its state is dropped (bounded state)."""
    aggs = [W.first_by(text, idx, correct).alias("chosen"),
            W.first_by(text, idx, f"NOT {correct}").alias("rejected"),
            *[F.any_value(c).alias(c) for c in carry]]
    if arrival is None:
        agg = candidates.groupBy(key).agg(*aggs)

        def write(batch: DataFrame, batch_id: int) -> None:
            W.filter_complete(batch).write.mode("overwrite").parquet(out_path)

        w = agg.writeStream.outputMode("complete").foreachBatch(write)
    else:
        c = candidates
        if c.schema[arrival].dataType.typeName() == "timestamp_ntz":
            c = c.withColumn(arrival, F.col(arrival).cast("timestamp"))
        agg = (c.withWatermark(arrival, delay)
               .groupBy(key, F.window(arrival, window).alias("w")).agg(*aggs)
               .select(key, F.col("w.start").alias("window_start"), "chosen", "rejected", *carry))

        def write(batch: DataFrame, batch_id: int) -> None:
            W.filter_complete(batch).write.mode("overwrite").parquet(
                os.path.join(out_path, f"batch_id={batch_id}"))

        w = agg.writeStream.outputMode("append").foreachBatch(write)
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return _start(w, candidates.sparkSession, state_partitions)


# STR-3 ---------------------------------------------------------------
def latency_windows(samples: DataFrame, out_path: str, checkpoint: str, window: str = "60 seconds",
                    delay: str = "0 seconds", ts: str = "ts", value: str = "total_time",
                    failed: str = "failed", by: tuple[str, ...] = (), available_now: bool = True,
                    state_partitions: int | None = None):
    """Per event-time window: requests, failures, mean/max latency and an
    approximate p95 (a bounded sketch per window). Append mode: a window
    is written once the watermark passes its end."""
    if samples.schema[ts].dataType.typeName() == "timestamp_ntz":
        samples = samples.withColumn(ts, F.col(ts).cast("timestamp"))
    agg = (samples.withWatermark(ts, delay)
           .groupBy(F.window(ts, window).alias("w"), *by)
           .agg(F.count(F.lit(1)).alias("n"),
                F.sum(F.col(failed).cast("int")).alias("failures"),
                F.avg(value).alias("avg"), F.max(value).alias("max"),
                F.percentile_approx(value, 0.95, 10000).alias("p95"))
           .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
                   "n", "failures", "avg", "max", "p95"))
    w = agg.writeStream.outputMode("append").format("parquet").option("path", out_path) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return _start(w, samples.sparkSession, state_partitions)


def _timestamp(df: DataFrame, ts: str) -> DataFrame:
    """``ts`` as the time-zone type that watermarks take."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")) if df.schema[ts].dataType.typeName() == "timestamp_ntz" else df


def _append(df: DataFrame, out_path: str, checkpoint: str, available_now: bool, state_partitions: int | None):
    w = df.writeStream.outputMode("append").format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return _start(w, df.sparkSession, state_partitions)


# STR-4 ---------------------------------------------------------------
def sessions_stream(events: DataFrame, out_path: str, checkpoint: str, by: tuple[str, ...] = ("user_id",), ts: str = "ts",
                    gap: str = "30 minutes", delay: str = "10 minutes", value: str | None = None,
                    available_now: bool = True, state_partitions: int | None = None):
    """Sessions of each key: rows less than ``gap`` apart. A session is state
    until the watermark passes its last row by ``gap``; then it is appended
    once (``session_start``, ``session_end`` = last row + ``gap``, ``n``, and
    the sum and maximum of ``value``) and its state is dropped. State is one
    row per open session. NULL keys are a key; rows without a time are dropped."""
    e = _timestamp(events, ts).withWatermark(ts, delay)
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs += [F.sum(value).alias("total"), F.max(value).alias("highest")]
    s = e.groupBy(*by, F.session_window(ts, gap).alias("w")).agg(*aggs)
    s = s.select(*by, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *s.columns[len(by) + 1:])
    # rows of a task are merged before the shuffle, so a hot key sends sessions, not rows
    conf, key = events.sparkSession.conf, "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    old = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return _append(s, out_path, checkpoint, available_now, state_partitions)
    finally:
        conf.set(key, old)


# STR-5 ---------------------------------------------------------------
def judged_stream(left: DataFrame, right: DataFrame, out_path: str, checkpoint: str, key: str, left_ts: str, right_ts: str,
                  within: str = "10 minutes", left_delay: str = "5 minutes", right_delay: str = "5 minutes",
                  available_now: bool = True, state_partitions: int | None = None):
    """Each left row with every right row of its key that follows it by 0 to
    ``within``; a left row without one is appended with NULLs once the
    watermark shows that none can come. Both sides' state is bounded in time:
    a right row is kept until no left row can precede it, a left row until
    ``within`` behind it has passed. Rows whose key is NULL match nothing.
    Columns of the two sides must have different names, the key's apart."""
    l = _timestamp(left, left_ts).withWatermark(left_ts, left_delay)
    r = _timestamp(right, right_ts).withWatermark(right_ts, right_delay).withColumnRenamed(key, "_key")
    on = (F.col(key) == F.col("_key")) & (F.col(right_ts) >= F.col(left_ts)) \
        & (F.col(right_ts) <= F.col(left_ts) + F.expr(f"INTERVAL {within}"))
    return _append(l.join(r, on, "left_outer").drop("_key"), out_path, checkpoint, available_now, state_partitions)


# STR-6 ---------------------------------------------------------------
def dedup_stream(events: DataFrame, out_path: str, checkpoint: str, keys: tuple[str, ...], ts: str = "ts",
                 order: tuple[str, ...] = (), delay: str = "1 hour", available_now: bool = True,
                 state_partitions: int | None = None):
    """First row of each key within the watermark, and a side output of what
    the watermark drops.

    A batch's watermark is the largest ``ts`` of the batches before it, less
    ``delay``. Rows older than it, or without a time, go to
    ``late/batch_id=<n>``. Of the others, the first of each key by (``ts``,
    ``order``, other columns) goes to ``kept/batch_id=<n>``, unless an earlier
    batch kept that key in a row which the watermark has not passed by
    ``delay``. Further rows of a key are dropped. NULL keys are equal.

    The kept rows are the state: a batch reads their keys and times, of those
    batches only that hold rows within the bound. Every folder is overwritten
    by a retry of its batch, which reads earlier batches only, so a restart
    gives the same rows. ``clock`` holds the largest time of every batch."""
    spark = events.sparkSession
    bound = F.expr(f"INTERVAL {delay}")
    at = lambda kind, n: os.path.join(out_path, kind, f"batch_id={n}")

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        mark, live = None, []
        if io.exists(session, os.path.join(out_path, "clock")):
            clock = session.read.schema("latest timestamp, batch_id long").parquet(os.path.join(out_path, "clock"))
            before = clock.where(F.col("batch_id") < batch_id)
            # as microseconds, which no time zone of the driver changes
            mark = before.agg(F.unix_micros(F.max("latest") - bound)).first()[0]
        if mark is not None:
            mark = F.timestamp_micros(F.lit(mark))
            # ids of the batches within two delays, one row each
            live = [r[0] for r in before.where(F.col("latest") + bound >= mark).select("batch_id").collect()]
        # three sinks read the micro-batch
        rows = batch.persist()
        late = F.col(ts).isNull() if mark is None else F.col(ts).isNull() | (F.col(ts) < mark)
        rows.where(late).write.mode("overwrite").parquet(at("late", batch_id))
        others = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString() and f.name not in (ts, *order)]
        rank = F.struct(*[F.col(f"`{c}`") for c in (ts, *order, *others)])
        whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
        values = [F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]
        kept = rows.where(~late).groupBy(*values).agg(F.min_by(whole, rank).alias("_row"))
        if live:
            seen = session.read.schema(rows.schema).parquet(*[at("kept", n) for n in sorted(live)])
            seen = seen.where(F.col(ts) + bound >= mark).select(*[F.col(f"`{k}`").alias(f"_s{i}") for i, k in enumerate(keys)])
            kept = kept.join(seen, [F.col(f"_k{i}").eqNullSafe(F.col(f"_s{i}")) for i in range(len(keys))], "left_anti")
        kept = kept.select("_row.*")
        kept.write.mode("overwrite").parquet(at("kept", batch_id))
        rows.agg(F.max(ts).alias("latest")).where(F.col("latest").isNotNull()).write.mode("overwrite").parquet(at("clock", batch_id))
        rows.unpersist()

    w = _timestamp(events, ts).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return _start(w, spark, state_partitions)
