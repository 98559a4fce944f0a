"""Registered queries: aggregations and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenmill.functions import text as X
from tokenmill.operators import metrics as M
from tokenmill.operators import tokens as T
from tokenmill.plans import tables
from tokenmill.plans.q_records import PREF_CHAT, preference_chat
from tokenmill.plans.registry import query, r6
from tokenmill.plans.q_tokens import VOCAB, docs_ids, docs_tokens

WS = r"'\S+'"


@query("agg1_row_count", "SELECT role, CAST(count(*) AS BIGINT) AS num_rows FROM conversations GROUP BY role")
def agg1(spark, sf):
    return M.row_count(tables.table(spark, sf, "conversations"), by="role")


@query("agg2_max_length", rf"""
SELECT lang, CAST(least(max(len(regexp_extract_all(text, {WS}))), 512) AS INTEGER) AS max_length
FROM documents GROUP BY lang""")
def agg2(spark, sf):
    d = T.tokenize(tables.table(spark, sf, "documents").select("lang", "text"), "text")
    return M.max_length(d, "tokens", 512, by="lang")


@query("agg3_length_percentile", rf"""
SELECT lang,
  CAST(trunc(quantile_cont(len(regexp_extract_all(text, {WS})), 0.85)) AS INTEGER) AS p85,
  CAST(trunc(quantile_cont(len(regexp_extract_all(text, {WS})), 0.90)) AS INTEGER) AS p90,
  CAST(trunc(quantile_cont(len(regexp_extract_all(text, {WS})), 0.95)) AS INTEGER) AS p95
FROM documents GROUP BY lang""")
def agg3(spark, sf):
    d = tables.table(spark, sf, "documents").select("lang", F.size(T.tokenize_col("text")).alias("n"))
    return M.length_percentile(d, "n", (0.85, 0.90, 0.95), "lang")


@query("agg3_exact_percentiles", """
SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90,
       round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY event_type""")
def agg3b(spark, sf):
    """Continuous values: exact percentiles by rank, hot groups split."""
    e = tables.table(spark, sf, "events")
    p = M.exact_percentiles(e, "value", (0.5, 0.9, 0.95), ["event_type"])
    return p.select("event_type", r6("p50").alias("p50"), r6("p90").alias("p90"), r6("p95").alias("p95"))


PREF_LENS = rf"""
WITH {PREF_CHAT},
l AS (SELECT len(regexp_extract_all(array_to_string(list_transform(chosen[1:len(chosen) - 1], lambda x: x.content), ' '), {WS})) AS pl,
             len(regexp_extract_all(chosen[len(chosen)].content, {WS})) AS cl,
             len(regexp_extract_all(rejected[len(rejected)].content, {WS})) AS rl FROM pref)"""


@query("agg4_length_budget", PREF_LENS + """
SELECT CAST(((CAST(trunc(quantile_cont(pl, 0.95)) AS BIGINT) + 1) // 2) * 2 AS BIGINT) AS max_prompt_length,
       CAST(((CAST(trunc(greatest(quantile_cont(pl + cl, 0.95), quantile_cont(pl + rl, 0.95))) AS BIGINT) + 1) // 2) * 2 AS BIGINT) AS max_length
FROM l""")
def agg4(spark, sf):
    p = preference_chat(spark, sf)
    content = lambda m: F.array_join(F.transform(m, lambda x: x["content"]), " ")
    lens = p.select(
        F.size(T.tokenize_col(content(X.all_but_last("chosen")))).alias("pl"),
        F.size(T.tokenize_col(F.element_at("chosen", -1)["content"])).alias("cl"),
        F.size(T.tokenize_col(F.element_at("rejected", -1)["content"])).alias("rl"))
    return M.length_budget(lens, "pl", "cl", "rl")


TEMPLATE = "Summarize the following news article:\n{input}\nSummary:\n"


@query("agg5_prompt_overhead", rf"""
SELECT doc_id, CAST(506 AS INTEGER) AS budget,
       CAST(least(len(regexp_extract_all(text, {WS})), 506) AS INTEGER) AS source_tokens FROM documents""")
def agg5(spark, sf):
    d = tables.table(spark, sf, "documents")
    budget = M.prompt_overhead(TEMPLATE, 512, T.tokenize_col)
    return d.select("doc_id", budget.alias("budget"),
                    F.least(F.size(T.tokenize_col("text")), budget).alias("source_tokens"))


@query("agg6_accuracy", r"""
SELECT round(avg(CASE WHEN regexp_extract_all(text, '\b\d+\b')[-1] = ground_truth THEN 1 ELSE 0 END), 6) AS accuracy
FROM candidates""", views=True)
def agg6(spark, sf):
    c = tables.candidates(spark, sf)
    a = M.accuracy(c, X.last_match("text", r"\b\d+\b"), "ground_truth")
    return a.select(r6("accuracy").alias("accuracy"))


@query("agg7_nonpad_length", f"""
WITH {VOCAB} SELECT round(avg(len(ids)), 6) AS gen_len FROM enc""")
def agg7(spark, sf):
    d = docs_ids(spark, sf)
    # padded to the next multiple of 64 of each document's own length
    padded = T.pad("input_ids", X.round_up_to(F.size("input_ids"), 64).cast("int"))
    return d.agg(r6(F.avg(M.nonpad_length(padded))).alias("gen_len"))


@query("agg8_weighted_f1", """
WITH p AS (SELECT toxic AS pred, quality AS truth, count(*) AS n FROM labels GROUP BY ALL),
t AS (SELECT truth AS cls, sum(n) AS support, sum(CASE WHEN pred = truth THEN n ELSE 0 END) AS tp FROM p GROUP BY truth),
q AS (SELECT pred AS cls, sum(n) AS predicted FROM p GROUP BY pred),
c AS (SELECT coalesce(t.cls, q.cls) AS cls, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp,
             coalesce(predicted, 0) AS predicted FROM t FULL JOIN q ON t.cls = q.cls),
f AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS pr,
             CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rc FROM c)
SELECT round(sum(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END * support) / sum(support), 6) AS f1_weighted
FROM f""")
def agg8(spark, sf):
    f = M.weighted_f1(tables.table(spark, sf, "labels"), "toxic", "quality")
    return f.select(r6("f1_weighted").alias("f1_weighted"))


@query("agg9_class_names", """
SELECT CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS id, lang AS name
FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)""")
def agg9(spark, sf):
    return M.class_names(tables.table(spark, sf, "documents"), "lang")


@query("jon6_label_join", """
WITH m AS (SELECT CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS id, lang
           FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL))
SELECT doc_id, id AS label_id FROM documents LEFT JOIN m USING (lang)""")
def jon6(spark, sf):
    d = tables.table(spark, sf, "documents").select("doc_id", "lang")
    return M.label_join(d, "lang", M.class_names(d, "lang")).select("doc_id", "label_id")


RUN_METRICS = "m AS (SELECT event_type AS run, CAST(day(ts) AS INTEGER) AS step, avg(value) AS metric FROM events GROUP BY ALL)"


def run_metrics(spark, sf):
    e = tables.table(spark, sf, "events")
    return e.groupBy(F.col("event_type").alias("run"), F.dayofmonth("ts").alias("step")) \
        .agg(F.avg("value").alias("metric"))


@query("agg10_best_run", f"""
WITH {RUN_METRICS}
SELECT run, first(step ORDER BY metric DESC, step) AS best_step, round(max(metric), 6) AS best_metric FROM m GROUP BY run""")
def agg10(spark, sf):
    b = M.best_run(run_metrics(spark, sf), "step", "metric", "max", by="run")
    return b.select("run", "best_step", r6("best_metric").alias("best_metric"))


@query("agg11_latency_summary", """
SELECT vus, CAST(count(*) AS BIGINT) AS n, round(min(total_time), 6) AS min, round(max(total_time), 6) AS max,
       round(avg(total_time), 6) AS avg, round(quantile_cont(total_time, 0.5), 6) AS p50,
       round(quantile_cont(total_time, 0.9), 6) AS p90, round(quantile_cont(total_time, 0.95), 6) AS p95,
       CAST(sum(generated_tokens) AS BIGINT) AS generated_tokens_sum
FROM load_samples GROUP BY vus""", views=True)
def agg11(spark, sf):
    s = M.latency_summary(tables.load_samples(spark, sf), "total_time", ["vus"],
                          counter="generated_tokens")
    return s.select("vus", "n", *[r6(c).alias(c) for c in ("min", "max", "avg", "p50", "p90", "p95")],
                    "generated_tokens_sum")


@query("agg12_failure_rate", """
SELECT vus, round(avg(CAST(failed AS INTEGER)), 6) AS failure_rate, avg(CAST(failed AS INTEGER)) <= 0 AS passed,
       bool_and(NOT failed) AS all_ok FROM load_samples GROUP BY vus""", views=True)
def agg12(spark, sf):
    f = M.failure_rate(tables.load_samples(spark, sf), "failed", by="vus")
    return f.select("vus", r6("failure_rate").alias("failure_rate"), "passed", "all_ok")


RATES = """r AS (SELECT variant, vus, count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) AS rps,
                 sum(generated_tokens) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) AS tps
          FROM load_samples GROUP BY variant, vus)"""


def rates(spark, sf):
    s = tables.load_samples(spark, sf)
    span = (F.unix_micros(F.max("ts").cast("timestamp"))
            - F.unix_micros(F.min("ts").cast("timestamp"))) / 1e6
    return s.groupBy("variant", "vus").agg((F.count(F.lit(1)) / span).alias("rps"),
                                           (F.sum("generated_tokens") / span).alias("tps"))


@query("agg13_peak_by", f"""
WITH {RATES}
SELECT variant, round(max(rps), 6) AS peak_rps, first(vus ORDER BY rps DESC, vus) AS rps_peak_vus,
       round(max(tps), 6) AS peak_tps, first(vus ORDER BY tps DESC, vus) AS tps_peak_vus FROM r GROUP BY variant""",
       views=True)
def agg13(spark, sf):
    p = M.peak_by(rates(spark, sf), ["rps", "tps"], "vus", "variant")
    return p.select("variant", r6("peak_rps").alias("peak_rps"), "rps_peak_vus",
                    r6("peak_tps").alias("peak_tps"), "tps_peak_vus")


@query("agg16_win_rates", """
WITH b AS (SELECT model_a AS model, outcome AS o FROM judgements
           UNION ALL SELECT model_b, CASE outcome WHEN 'win' THEN 'loss' WHEN 'loss' THEN 'win' ELSE outcome END FROM judgements),
g AS (SELECT model, count(*) FILTER (WHERE o = 'win') AS win, count(*) FILTER (WHERE o = 'loss') AS loss,
             count(*) FILTER (WHERE o = 'tie') AS tie, count(*) AS n FROM b GROUP BY model)
SELECT model, CAST(win AS BIGINT) AS win, CAST(loss AS BIGINT) AS loss, CAST(tie AS BIGINT) AS tie, CAST(n AS BIGINT) AS n,
       round(win / n, 6) AS win_rate, round(loss / n, 6) AS loss_rate, round((win + tie / 2) / n, 6) AS win_rate_adjusted
FROM g""", views=True)
def agg16(spark, sf):
    w = M.win_rates(tables.judgements(spark, sf))
    return w.select("model", "win", "loss", "tie", "n", r6("win_rate").alias("win_rate"),
                    r6("loss_rate").alias("loss_rate"), r6("win_rate_adjusted").alias("win_rate_adjusted"))


# MET -------------------------------------------------------------------------------
def summaries(spark, sf):
    """pred = the first half of a document's lines, ref = the other lines ('' if none)."""
    d = tables.spread_table(spark, sf, "documents", "doc_id", "text")
    lines = F.split("text", "\n")
    half = F.ceil(F.size("l") / 2).cast("int")
    return d.select("doc_id", lines.alias("l")).select(
        "doc_id", F.array_join(F.slice("l", F.lit(1), half), "\n").alias("pred"),
        F.array_join(F.slice("l", half + 1, F.size("l")), "\n").alias("ref"))


def RTOK(x: str) -> str:
    return f"list_filter(string_split(trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g')), ' '), lambda t: t <> '')"


SUMM = f"""l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
s AS (SELECT doc_id, array_to_string(l[1:CAST(ceil(len(l) / 2) AS INTEGER)], chr(10)) AS pred,
             array_to_string(l[CAST(ceil(len(l) / 2) AS INTEGER) + 1:], chr(10)) AS ref FROM l),
w AS (SELECT doc_id, {RTOK('pred')} AS pw, {RTOK('ref')} AS rw FROM s)"""


def NGR(x: str, n: int) -> str:
    return (f"CASE WHEN len({x}) >= {n} THEN list_transform(range(len({x}) - {n} + 1), "
            f"lambda i: array_to_string(list_slice({x}, i + 1, i + {n}), ' ')) ELSE [] END")


def ROUGE_SQL(n: int, name: str) -> str:
    return f"""
WITH {SUMM},
g AS (SELECT doc_id, {NGR('pw', n)} AS p, {NGR('rw', n)} AS r FROM w),
pc AS (SELECT doc_id, g, count(*) AS cp FROM (SELECT doc_id, unnest(p) AS g FROM g) GROUP BY ALL),
rc AS (SELECT doc_id, g, count(*) AS cr FROM (SELECT doc_id, unnest(r) AS g FROM g) GROUP BY ALL),
ov AS (SELECT doc_id, sum(least(cp, cr)) AS overlap FROM pc JOIN rc USING (doc_id, g) GROUP BY doc_id),
f AS (SELECT g.doc_id, len(p) AS np, len(r) AS nr, coalesce(overlap, 0) AS overlap FROM g LEFT JOIN ov USING (doc_id)),
x AS (SELECT CASE WHEN np > 0 THEN overlap / np ELSE 0.0 END AS pr, CASE WHEN nr > 0 THEN overlap / nr ELSE 0.0 END AS rc FROM f)
SELECT round(avg(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END) * 100, 4) AS {name} FROM x"""


@query("met6_rouge1", ROUGE_SQL(1, "rouge1"))
def met6a(spark, sf):
    return M.rouge_summary(M.rouge_n(summaries(spark, sf), "doc_id", "pred", "ref", 1), "rouge1")


@query("met6_rouge2", ROUGE_SQL(2, "rouge2"))
def met6b(spark, sf):
    return M.rouge_summary(M.rouge_n(summaries(spark, sf), "doc_id", "pred", "ref", 2), "rouge2")


@query("met7_rouge_l")
def met7(spark, sf):
    """LCS F per row (Arrow batch function); no SQL form — checked against
    a brute-force LCS in tests."""
    return M.rouge_summary(M.rouge_l(summaries(spark, sf), "doc_id", "pred", "ref"), "rougeL")


@query("met7_rouge_lsum")
def met7b(spark, sf):
    s = summaries(spark, sf).select("doc_id", M.sentence_lines("pred").alias("pred"),
                                    M.sentence_lines("ref").alias("ref"))
    return M.rouge_summary(M.rouge_l(s, "doc_id", "pred", "ref", summary_level=True), "rougeLsum")


@query("met8_sentence_lines", r"""
SELECT doc_id, regexp_replace(text, '([.!?])\s+', '\1' || chr(10), 'g') AS lines FROM documents""")
def met8(spark, sf):
    d = tables.table(spark, sf, "documents")
    return d.select("doc_id", M.sentence_lines("text").alias("lines"))


@query("met12_latency_per_token", """
SELECT event_id, total_time / 1000 / CAST(nullif(generated_tokens, 0) AS DOUBLE) * 1000 AS ms_per_token
FROM load_samples""", views=True)
def met12(spark, sf):
    s = tables.load_samples(spark, sf)
    # compared unrounded: per-row arithmetic is bit-identical across
    # engines, while rounding binary doubles at exact halves is not
    v = M.latency_per_token(F.col("total_time") / 1000, "generated_tokens", decimals=None)
    return s.select("event_id", v.alias("ms_per_token"))


@query("jon7_compare_runs", """
WITH p AS (SELECT variant, vus, quantile_cont(total_time, 0.95) AS p95 FROM load_samples GROUP BY ALL),
s AS (SELECT vus, max(p95) FILTER (WHERE variant = 'fp16') AS b, max(p95) FILTER (WHERE variant = 'fp8') AS c FROM p GROUP BY vus)
SELECT vus, round(b, 6) AS p95_fp16, round(c, 6) AS p95_fp8, round((c - b) / b * 100, 6) AS improvement_pct FROM s""",
       views=True)
def jon7(spark, sf):
    p = M.exact_percentiles(tables.load_samples(spark, sf), "total_time", (0.95,), ["variant", "vus"])
    c = M.compare_runs(p, ["vus"], "variant", "p95", "fp16", "fp8")
    return c.select("vus", r6("p95_fp16").alias("p95_fp16"), r6("p95_fp8").alias("p95_fp8"),
                    r6("improvement_pct").alias("improvement_pct"))


@query("run3_improvement", f"""
WITH {RATES},
s AS (SELECT vus, max(tps) FILTER (WHERE variant = 'fp16') AS b, max(tps) FILTER (WHERE variant = 'fp8') AS c FROM r GROUP BY vus)
SELECT vus, round((c - b) / b * 100, 6) AS tokens_per_s_change_pct FROM s""", views=True)
def run3(spark, sf):
    c = M.compare_runs(rates(spark, sf), ["vus"], "variant", "tps", "fp16", "fp8")
    return c.select("vus", r6("improvement_pct").alias("tokens_per_s_change_pct"))



