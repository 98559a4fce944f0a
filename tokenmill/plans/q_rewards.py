"""Registered queries: rewards, preference pairs, group statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenmill.operators import metrics as M
from tokenmill.operators import records as R
from tokenmill.operators import rewards as W
from tokenmill.plans import tables
from tokenmill.plans.registry import query, r6

SYSTEM = "Answer with the number only."

# SQL building blocks -------------------------------------------------------------
CORRECT = r"coalesce(regexp_extract_all(text, '\b\d+\b')[-1] = ground_truth, false)"
RAW_PAIRS = f"""raw AS (SELECT prompt_id, any_value(prompt) AS prompt, any_value(ground_truth) AS ground_truth,
       arg_min(text, cand_idx) FILTER (WHERE {CORRECT}) AS chosen,
       arg_min(text, cand_idx) FILTER (WHERE NOT {CORRECT}) AS rejected
FROM candidates GROUP BY prompt_id),
pairs AS (SELECT * FROM raw WHERE length(chosen) > 0 AND length(rejected) > 0)"""

FORMAT_SQL = """CASE WHEN instr(completion, '</think>') > 0
  AND instr(substr(completion, 1, instr(completion, '</think>') - 1), '<think>') = 0
  AND substr(completion, instr(completion, '</think>'), 17) = '</think>' || chr(10) || '<answer>'
  AND (CASE WHEN ends_with(completion, '</answer>' || chr(10)) THEN length(completion) - 10
            WHEN ends_with(completion, '</answer>') THEN length(completion) - 9 END)
      >= instr(completion, '</think>') - 1 + 17
  THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END"""

EQ_SQL = r"""e AS (SELECT *, regexp_replace(regexp_extract('<think>' || completion, '<answer>(.*?)</answer>', 1), '^\s+|\s+$', '', 'g') AS eq,
                 regexp_matches('<think>' || completion, '<answer>(.*?)</answer>') AS has FROM countdown),
g AS (SELECT *, has AND list_sort(list_transform(regexp_extract_all(eq, '\d+'), lambda d: CAST(d AS BIGINT))) = list_sort(nums)
                AND regexp_full_match(eq, '[\d+\-*/().\s]+') AS gate FROM e),
v AS (SELECT *, CASE WHEN gate AND regexp_full_match(eq, '\s*\d+\s*[+-]\s*\d+\s*')
                     THEN CASE WHEN regexp_extract(eq, '[+-]') = '+'
                               THEN CAST(regexp_extract(eq, '(\d+)', 1) AS BIGINT) + CAST(regexp_extract(eq, '\d+\s*[+-]\s*(\d+)', 1) AS BIGINT)
                               ELSE CAST(regexp_extract(eq, '(\d+)', 1) AS BIGINT) - CAST(regexp_extract(eq, '\d+\s*[+-]\s*(\d+)', 1) AS BIGINT) END
                END AS val FROM g),
r AS (SELECT task_id, gen_idx, CASE WHEN abs(val - target) < 1e-5 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS equation_reward,
             """ + FORMAT_SQL + """ AS format_reward FROM v)"""


def scored(spark, sf):
    c = tables.candidates(spark, sf)
    return c.withColumn("correct", W.score_last_int("text", "ground_truth"))


def raw_pairs(spark, sf):
    c = scored(spark, sf)
    return c.groupBy("prompt_id").agg(
        W.first_by("text", "cand_idx", "correct").alias("chosen"),
        W.first_by("text", "cand_idx", "NOT correct").alias("rejected"),
        F.any_value("prompt").alias("prompt"), F.any_value("ground_truth").alias("ground_truth"))


def pairs(spark, sf):
    return W.preference_pairs(scored(spark, sf), "prompt_id", "cand_idx", "text", "correct",
                              carry=("prompt", "ground_truth"))


@query("rwd1_score_last_int", f"SELECT prompt_id, cand_idx, {CORRECT} AS correct FROM candidates", views=True)
def rwd1(spark, sf):
    return scored(spark, sf).select("prompt_id", "cand_idx", "correct")


@query("rwd2_preference_pairs", f"WITH {RAW_PAIRS} SELECT prompt_id, prompt, ground_truth, chosen, rejected FROM pairs",
       views=True)
def rwd2(spark, sf):
    return pairs(spark, sf).select("prompt_id", "prompt", "ground_truth", "chosen", "rejected")


@query("flt3_filter_complete_pairs", f"""
WITH {RAW_PAIRS} SELECT prompt_id FROM raw WHERE length(chosen) > 0 AND length(rejected) > 0""", views=True)
def flt3(spark, sf):
    return R.filter_complete_pairs(raw_pairs(spark, sf)).select("prompt_id")


@query("rwd3_limit_pairs", f"WITH {RAW_PAIRS} SELECT prompt_id, chosen FROM pairs ORDER BY prompt_id LIMIT 100",
       views=True)
def rwd3(spark, sf):
    return W.limit_pairs(pairs(spark, sf), 100, "prompt_id").select("prompt_id", "chosen")


@query("rwd4_explode_candidates", """
SELECT prompt_id, cand_idx AS request_idx, CAST(i - 1 AS INTEGER) AS out_idx, t AS text
FROM (SELECT prompt_id, cand_idx, unnest([text, text || ' (again)', upper(prompt)]) AS t,
             unnest(range(1, 4)) AS i FROM candidates)""", views=True)
def rwd4(spark, sf):
    """Generator output shape: each request row holds its n = 3 sampled
    texts (a list bounded by n, built per row) -> one row per text."""
    c = tables.candidates(spark, sf)
    outs = c.select("prompt_id", F.col("cand_idx").alias("request_idx"),
                    F.array("text", F.concat("text", F.lit(" (again)")), F.upper("prompt")).alias("outputs"))
    return W.explode_candidates(outs, ["prompt_id", "request_idx"], "outputs", idx="out_idx")


def _chatml_sql(role: str, content: str) -> str:
    return f"'<|im_start|>{role}' || chr(10) || {content} || '<|im_end|>' || chr(10)"


@query("fmt21_preference_columns", f"""
WITH {RAW_PAIRS}
SELECT {_chatml_sql('system', "'" + SYSTEM + "'")} || {_chatml_sql('user', 'prompt')} AS prompt,
       {_chatml_sql('assistant', 'chosen')} AS chosen, {_chatml_sql('assistant', 'rejected')} AS rejected
FROM pairs""", views=True)
def fmt21(spark, sf):
    p = pairs(spark, sf).withColumn("system_prompt", F.lit(SYSTEM))
    return R.preference_columns(p)


@query("win1_first_by", f"""
SELECT prompt_id, arg_min(cand_idx, cand_idx) FILTER (WHERE {CORRECT}) AS first_correct
FROM candidates GROUP BY prompt_id""", views=True)
def win1(spark, sf):
    return scored(spark, sf).groupBy("prompt_id").agg(
        W.first_by("cand_idx", "cand_idx", "correct").alias("first_correct"))


def countdown_rewards(spark, sf):
    c = tables.countdown(spark, sf)
    c = c.withColumn("format_reward", W.format_reward("completion"))
    return W.equation_reward(c, "completion", "target", "nums")


@query("rwd5_format_reward", f"SELECT task_id, gen_idx, {FORMAT_SQL} AS format_reward FROM countdown", views=True)
def rwd5(spark, sf):
    c = tables.countdown(spark, sf)
    return c.select("task_id", "gen_idx", W.format_reward("completion").alias("format_reward"))


@query("rwd6_equation_reward", f"WITH {EQ_SQL} SELECT task_id, gen_idx, equation_reward FROM r", views=True)
def rwd6(spark, sf):
    return countdown_rewards(spark, sf).select("task_id", "gen_idx", "equation_reward")


@query("rwd7_rewards", f"""
WITH {EQ_SQL} SELECT task_id, gen_idx, format_reward, equation_reward, format_reward + equation_reward AS reward FROM r""",
       views=True)
def rwd7(spark, sf):
    c = tables.countdown(spark, sf)
    out = W.rewards(c, {"format_reward": lambda d: W.format_reward("completion"),
                        "equation_reward": lambda d: W.equation_value("completion", "target", "nums")})
    return out.select("task_id", "gen_idx", "format_reward", "equation_reward", "reward")


@query("win3_group_advantage", f"""
WITH {EQ_SQL}, t AS (SELECT task_id, gen_idx, format_reward + equation_reward AS reward FROM r)
SELECT task_id, gen_idx, round((reward - avg(reward) OVER (PARTITION BY task_id))
       / (stddev_samp(reward) OVER (PARTITION BY task_id) + 0.0001), 6) AS advantage FROM t""", views=True)
def win3(spark, sf):
    r = countdown_rewards(spark, sf).withColumn(
        "reward", F.col("format_reward") + F.col("equation_reward"))
    a = W.group_advantage(r, "task_id", "reward")
    return a.select("task_id", "gen_idx", r6("advantage").alias("advantage"))


@query("agg15_mean_reward", f"""
WITH {EQ_SQL} SELECT CAST(gen_idx AS INTEGER) AS step, round(avg(equation_reward), 6) AS mean_reward,
       round(avg(CASE WHEN equation_reward >= 1.0 THEN 1 ELSE 0 END), 6) AS solve_rate FROM r GROUP BY gen_idx""",
       views=True)
def agg15(spark, sf):
    r = countdown_rewards(spark, sf).withColumnRenamed("gen_idx", "step")
    m = M.mean_reward(r, "equation_reward", by="step")
    return m.select("step", r6("mean_reward").alias("mean_reward"), r6("solve_rate").alias("solve_rate"))
