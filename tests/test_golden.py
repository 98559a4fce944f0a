"""Golden vectors of the reference (FIXTURES.md §2)."""

import math

import pytest
from pyspark.sql import functions as F

from tokenmill.functions import text as X
from tokenmill.operators import metrics as M
from tokenmill.operators import rewards as W
from tokenmill.operators import runs as U

CORRECT_1 = """We need to find an equation using the numbers 19, 36, 55, and 7
exactly once, with basic arithmetic operations, that equals 65. One possible
combination is 55 + 36 - 19 + 7... </think>
<answer> 55 + 36 - 7 - 19 </answer>"""
CORRECT_2 = """ ... </think>
<answer> 55 + 36 - 7 - 19 </answer>"""
WRONG_FORMAT = """User: Using the numbers [19, 36, 55, 7], create an equation that equals 65."""
WRONG_FORMAT_2 = """To find the equation that equals 79 using the numbers 95, 78, 6, 88, I'll start by adding 88 and 95:
95 + 88 = 183
Now, let's subtract 104 from 183 to get 79:
183 - 104 = 79
<think> 183 - 104 = 79 </think><think> 183 - 104 = 79 </think><answer> 183 - 104 = 79 </answer>"""
WRONG_RESULT = """ ... </think>
<answer> 55 + 36 - 7 - 18 </answer>"""
FIVE = [CORRECT_1, CORRECT_2, WRONG_FORMAT, WRONG_FORMAT_2, WRONG_RESULT]


def _completions(spark):
    rows = [(i, c, 65, [19, 36, 55, 7]) for i, c in enumerate(FIVE)]
    return spark.createDataFrame(rows, "i int, completion string, target bigint, nums array<bigint>")


def test_format_reward_golden(spark):
    df = _completions(spark).select("i", W.format_reward("completion").alias("r")).orderBy("i")
    assert [r.r for r in df.collect()] == [1.0, 1.0, 0.0, 0.0, 1.0]


def test_equation_reward_golden(spark):
    df = W.equation_reward(_completions(spark), "completion", "target", "nums").orderBy("i")
    assert [r.equation_reward for r in df.collect()] == [1.0, 1.0, 0.0, 0.0, 0.0]


def test_format_reward_stack_safety(spark):
    body = "<" * 100_000 + "</think>\n<answer>1 + 2</answer>"
    df = spark.createDataFrame([(body,)], "completion string")
    assert df.select(W.format_reward("completion").alias("r")).first().r == 1.0


def test_win_rate_golden(spark):
    rows = [("tuned", "base", "win")] * 45 + [("tuned", "base", "loss")] * 17 + \
        [("tuned", "base", "tie")] * 98
    df = spark.createDataFrame(rows, "model_a string, model_b string, outcome string")
    r = {x.model: x for x in M.win_rates(df).collect()}
    assert (r["tuned"].win, r["tuned"].loss, r["tuned"].tie) == (45, 17, 98)
    assert r["tuned"].win_rate == pytest.approx(0.28125)
    assert r["tuned"].loss_rate == pytest.approx(0.10625)
    assert r["tuned"].win_rate_adjusted == pytest.approx(0.5875)
    assert r["base"].win_rate_adjusted == pytest.approx(0.4125)


def test_optimizer_steps_golden(spark):
    df = spark.createDataFrame([(10000, 1, 2, 1), (5408, 4, 4, 1), (5408, 8, 2, 4)],
                               "rows long, b int, a int, d int")
    got = [r.s for r in df.select(U.optimizer_steps("rows", "b", "a", "d").alias("s")).collect()]
    assert got == [5000, 338, 84]


def test_improvement_golden(spark):
    df = spark.createDataFrame([(0.7684, 0.8254), (0.6440, 0.7892)], "b double, c double")
    got = [round(r.i, 2) for r in df.select(M.improvement("b", "c").alias("i")).collect()]
    assert got == [7.42, 22.55]


def test_peak_with_argument_golden(spark):
    fp8 = [(1, 0.88), (2, 1.32), (4, 1.53), (8, 2.54), (16, 2.26), (64, 2.49), (128, 2.54)]
    fp16 = [(1, 0.76), (2, 1.37), (4, 1.02), (8, 0.94), (16, 1.25), (64, 0.89), (128, 1.00)]
    rows = [("fp8", r, v) for r, v in fp8] + [("fp16", r, v) for r, v in fp16]
    df = spark.createDataFrame(rows, "variant string, rate int, rps double")
    got = {r.variant: (r.peak_rps, r.peak_rate) for r in M.peak_by(df, "rps", "rate", "variant").collect()}
    assert got == {"fp8": (2.54, 8), "fp16": (1.37, 2)}


def test_last_int_rule_golden(spark):
    rows = [("total 1,234", "234"), ("about 3.5", "5"), ("minus -7", "7"), ("none", "0"),
            ("07", "7")]
    df = spark.createDataFrame(rows, "t string, truth string")
    got = [r.ok for r in df.select(W.score_last_int("t", "truth").alias("ok")).collect()]
    assert got == [True, True, True, False, False]


def test_evaluate_arithmetic_is_safe():
    assert W.evaluate_arithmetic("(1 + 2) * 3") == 9.0
    assert W.evaluate_arithmetic("7 // 2 + 2 ** 3") == 11.0
    assert W.evaluate_arithmetic("1 / 0") is None
    assert W.evaluate_arithmetic("2 ** 100000") is None
    assert W.evaluate_arithmetic("__import__('os')") is None
    assert W.evaluate_arithmetic("(1)(2)") is None
    assert W.evaluate_arithmetic("1.5 + 1") == 2.5


def test_parse_timings(spark):
    line = ('chat_completions{total_time="2.360607542s" validation_time="256.541µs" '
            'queue_time="37.931µs" inference_time="2.36031324s" time_per_token="12.166563ms"}')
    df = spark.createDataFrame([(line,)], "line string")
    m = df.select(X.parse_timings("line").alias("m")).first().m
    assert m["time_per_token"] == pytest.approx(12.166563)
    assert m["total_time"] == pytest.approx(2360.607542)
    assert m["queue_time"] == pytest.approx(0.037931)


def test_percentile_truncates(spark):
    df = spark.createDataFrame([(x,) for x in (1, 2, 3, 4)], "n int")
    assert M.length_percentile(df, "n", 0.95).first().p_length == 3  # 3.85 -> 3
    ex = M.exact_percentiles(df, "n", (0.95,)).first()
    assert math.isclose(ex.p95, 3.85)


def test_strip_is_python_strip(spark):
    df = spark.createDataFrame([("\t\n  a b \r\n",)], "s string")
    assert df.select(X.strip("s").alias("x")).first().x == "a b"
    assert df.select(X.last_match(F.lit("x"), r"\d+").alias("x")).first().x is None
