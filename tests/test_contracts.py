"""Contracts that hold at any size: no caps, no lost rows, one order, one result per path."""

import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tokenmill.functions import chat
from tokenmill.operators import metrics as M
from tokenmill.operators import offsets as O
from tokenmill.operators import records as R
from tokenmill.operators import retrieval as V
from tokenmill.operators import rewards as W
from tokenmill.operators import sample as S
from tokenmill.operators import tokens as T
from tokenmill.session import bounded_size, broadcast_if_bounded


def test_arithmetic_has_no_length_or_depth_limit():
    assert W.evaluate_arithmetic("1**100") == 1.0
    assert W.evaluate_arithmetic("+".join(["1"] * 5000)) == 5000.0
    assert W.evaluate_arithmetic("(" * 3000 + "7" + ")" * 3000) == 7.0
    assert W.evaluate_arithmetic("-" * 3001 + "2") == -2.0
    assert W.evaluate_arithmetic("2**70 // 2**60") == 1024.0
    assert W.evaluate_arithmetic("10**10**10") is None  # result too large to take


def test_arithmetic_agrees_with_python():
    rng = random.Random(1)
    bits = ["1", "2", "07", "0", "00", "1.5", ".5", "3.", "+", "-", "*", "/", "**", "//", "(", ")", " ", "%", "12"]
    for _ in range(20000):
        expr = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 9)))
        try:
            if "**" in expr and sum(c == "*" for c in expr) > 4:
                continue
            v = eval(expr.strip(), {"__builtins__": None}, {})  # noqa: S307
            want = float(v) if isinstance(v, (int, float)) and not isinstance(v, complex) else None
            want = want if want is not None and want - want == 0 else None
        except Exception:
            want = None
        assert W.evaluate_arithmetic(expr) == want, expr


@pytest.mark.parametrize("n", [10_000, 10_001])
def test_head_keeps_its_order_on_a_string_key(spark, n):
    d = spark.range(12_000).select(F.md5(F.col("id").cast("string")).alias("k"), "id").repartition(5)
    got = [r["k"] for r in S.head(d, n, ["k", "id"]).collect()]
    assert got == sorted(r["k"] for r in d.select("k").collect())[:n]


def test_positions_over_strings_timestamps_and_descending_keys(spark):
    d = spark.range(500).select(
        "id", F.when(F.col("id") % 7 != 0, F.md5(F.col("id").cast("string"))).alias("s"),
        F.expr("timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,0,id % 50)").alias("t"))
    for keys, order in ((["s", "id"], lambda r: (r["s"] is not None, r["s"] or "", r["id"])), (["t", "id"], lambda r: (r["t"], r["id"]))):
        rows = O.with_positions(d, keys).orderBy("row_id").collect()
        assert [r["id"] for r in rows] == [r["id"] for r in sorted(d.collect(), key=order)]
        assert [r["row_id"] for r in rows] == list(range(500))
    down = O.with_positions(d, [F.col("t").desc(), F.col("id")]).orderBy("row_id").collect()
    assert [r["id"] for r in down] == [r["id"] for r in sorted(d.collect(), key=lambda r: (-r["t"].timestamp(), r["id"]))]


def test_a_hot_first_key_is_cut_by_a_string_second_key(spark):
    d = spark.range(8_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(5)).alias("k"),
                                  F.md5(F.col("id").cast("string")).alias("s"))
    b = O._bucketize(d, [F.col("k"), F.col("s")], 16).groupBy(O._BUCKET).count()
    assert b.agg(F.max("count")).first()[0] < 8_000 / 16 * 3


def test_fractions_below_a_millionth_are_kept():
    assert O.hash_cut(1e-9) == int(Fraction(1e-9) * (1 << 60)) > 0
    assert O.hash_cut(1.0) == 1 << 60


def test_any_number_of_patterns(spark):
    d = spark.createDataFrame([("layer.17.w",), ("other",), ("p2500",), (None,)], "name string")
    pats = spark.createDataFrame([(f"p{i}$",) for i in range(12_000)] + [("layer\\.\\d+",), (None,)], "entry string")
    assert sorted(r[0] for r in R.match_any_pattern(d, pats, "name").collect()) == ["layer.17.w", "p2500"]


def test_a_long_list_of_patterns_is_matched_in_blocks(spark):
    """Beyond the bound on rules or bytes: the rows of the other path, a third of them one value."""
    names = ["hot" if i % 3 == 0 else f"layer.{i % 50}.w" if i % 3 == 1 else ["", None, "p7x", "x\ny", "(z"][i % 5] for i in range(600)]
    d = spark.createDataFrame([(i, n, "x", 1) for i, n in enumerate(names)], "id int, name string, _v string, _block int")
    rules = [f"p{i}$" for i in range(400)] + ["layer\\.1\\d", "ho", "ho", "\\(z", "x$", None]
    for more in ([], [""]):
        pats = spark.createDataFrame([(r,) for r in rules + more], "entry string")
        want = sorted(r[0] for r in R.match_any_pattern(d, pats, "name").select("id").collect())
        kept = [i for i, n in enumerate(names) if n is not None and any(
            re.match(r.replace("$", r"(?=\n?\Z)"), n) for r in rules + more if r is not None)]
        assert want == kept and len(kept) > 200
        for limits in ({"max_patterns": 20}, {"max_bytes": 100}):
            out = R.match_any_pattern(d, pats, "name", block=30, buckets=5, **limits)
            assert out.columns == d.columns and sorted(r["id"] for r in out.collect()) == want
    none = spark.createDataFrame([(None,)] * 30, "entry string")
    assert R.match_any_pattern(d, none, "name", max_patterns=3).count() == 0
    assert R.match_any_pattern(d.limit(0), pats, "name", max_patterns=3).count() == 0


def test_null_groups_and_repeated_values_in_percentiles(spark):
    rng = random.Random(3)
    rows = [(g, rng.choice([0.0, 0.0, rng.random()])) for g in ("a", None, "b") for _ in range(301)] + [("c", None)]
    d = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["p50"], r["p90"]) for r in M.exact_percentiles(d, "v", (0.5, 0.9), ["g"], sub_ranges=16).collect()}
    assert set(got) == {"a", "b", None}
    for g in got:
        v = sorted(x for k, x in rows if k == g and x is not None)
        for p, x in zip((0.5, 0.9), got[g], strict=True):
            at = p * (len(v) - 1)
            lo = int(at)
            assert abs(x - (v[lo] + (v[min(lo + 1, len(v) - 1)] - v[lo]) * (at - lo))) < 1e-12
    s = {r["g"]: r["p50"] for r in M.latency_summary(d, "v", ["g"]).collect()}
    assert s[None] == got[None][0] and s["c"] is None


def test_repeated_values_leave_few_rows_per_task(spark):
    d = spark.range(20_000).select(F.lit("g").alias("g"), F.when(F.col("id") % 2 == 0, F.lit(0.0)).otherwise(F.rand(1)).alias("v"))
    p = M.exact_percentiles(d, "v", (0.25, 0.75), ["g"]).first()
    assert p["p25"] == 0.0 and 0.4 < p["p75"] < 0.6


def test_advantage_keeps_rows_without_a_key(spark):
    d = spark.createDataFrame([(None, 1.0), (None, 3.0), (1, 5.0)], "k int, r double")
    got = sorted((r["k"] or 0, r["r"], r["advantage"]) for r in W.group_advantage(d, "k", "r").collect())
    assert len(got) == 3 and got[0][2] == -got[1][2]


def test_messages_without_content_stay_in_the_prompt(spark):
    m = spark.createDataFrame([([("user", None), ("assistant", "x")],)], "m array<struct<role string, content string>>")
    assert m.select(chat.chatml("m")).first()[0] == "<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n"
    for style in ("chatml", "human_assistant", "llama3_header", "gemma_chatml", "starchat", "llama2_inst", "idefics"):
        assert m.select(chat.render("m", style)).first()[0] is not None


def test_both_encoding_paths_agree_on_null_lists_and_repeated_keys(spark):
    d = spark.createDataFrame([(1, ["a", "zz", "b"]), (1, ["b"]), (2, None), (3, []), (None, ["a", None])], "k int, t array<string>")
    vocab = T.build_vocab(d.where("t is not null"), "t", 10)
    got = [sorted((str(r["k"]), str(r["input_ids"])) for r in T.encode(d, "k", "t", vocab, method=m).collect())
           for m in ("broadcast", "join")]
    assert got[0] == got[1] and ("2", "None") in got[0] and ("3", "[]") in got[0]


def test_vocabulary_is_the_same_by_heap_and_by_ranks(spark, monkeypatch):
    d = spark.range(300).select(F.array(*[(F.col("id") % m).cast("string") for m in (2, 7, 40, 250)]).alias("t"))
    want = sorted(map(tuple, T.build_vocab(d, "t", 100).collect()))
    monkeypatch.setattr(T, "TAKE_ORDERED_MAX", 10)
    monkeypatch.setattr(S, "TAKE_ORDERED_MAX", 10)
    assert sorted(map(tuple, T.build_vocab(d, "t", 100).collect())) == want


def test_broadcast_bound_counts_bytes(spark):
    wide = spark.range(3).select(F.repeat(F.lit("x"), 1_000_000).alias("s"))
    rows, size = bounded_size(wide, 10)
    assert rows == 3 and size >= 3_000_000
    hinted = broadcast_if_bounded(wide, 10, limit=1_000_000)._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" not in hinted and "UnresolvedHint" not in hinted


def test_best_run_breaks_ties_for_names(spark):
    d = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", None), ("d", 1.0)], "run string, m double")
    assert M.best_run(d, "run", "m").first()["best_run"] == "a"
    assert M.best_run(d, "run", "m", mode="min").first()["best_run"] == "d"


def test_retrieval_counts_queries_without_relevant_rows_in_every_metric(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0], "x"), (2, [0.0, 1.0], "none"), (3, None, "x")], "qid long, embedding array<double>, rel_key string")
    c = spark.createDataFrame([(10, [1.0, 0.1], "x"), (11, [0.1, 1.0], "y"), (12, None, "x")], "cid long, embedding array<double>, rel_key string")
    by_key = V.matryoshka_eval(q.where("qid < 3"), c, [2], 2).first()
    pairs = spark.createDataFrame([(1, 10), (1, 12)], "qid long, cid long")
    by_pairs = V.matryoshka_eval(q.where("qid < 3"), c, [2], 2, qrels=pairs).first()
    assert by_key["mrr_at_2"] == by_pairs["mrr_at_2"] == 0.5 and by_key["accuracy_at_2"] == 0.5
    assert by_key["recall_at_2"] == by_pairs["recall_at_2"] == 0.25  # one of two relevant rows, then none
    assert V.matryoshka_eval(q, c, [2], 2).first()["mrr_at_2"] == pytest.approx(1 / 3)  # a query without a vector finds nothing


def test_rewards_see_target_and_numbers(spark):
    d = spark.createDataFrame([("x</think>\n<answer>1+2</answer>", 3, [1, 2]), ("no", 3, [1, 2])], "completion string, target long, nums array<long>")

    def user(completions, target, nums):
        return [float(t) + len(n) + len(c) for c, t, n in zip(completions, target, nums, strict=True)]

    own = W.reward_udf(user, "target", "nums")
    out = W.rewards(d, {"f": lambda x: W.format_reward("completion"), "e": lambda x: W.equation_value("completion", "target", "nums"),
                        "u": lambda x: own("completion", "target", "nums")})
    rows = out.select("f", "e", "u", "reward").collect()
    n = len(d.first()["completion"])
    assert [tuple(r) for r in rows] == [(1.0, 1.0, 5.0 + n, 7.0 + n), (0.0, 0.0, 7.0, 7.0)]


def _lsum(pred, ref):
    """ROUGE-Lsum by a full table for every pair of lines."""
    import re
    tok = lambda s: re.sub("[^a-z0-9]+", " ", s.lower()).split()
    ps, rs = ([w for w in map(tok, x.split("\n")) if w] for x in (pred, ref))
    np_, nr = sum(map(len, ps)), sum(map(len, rs))
    if not np_ or not nr:
        return 0.0
    left = [[t for x in s for t in x] for s in (ps, rs)]
    hits = 0
    for r in rs:
        union = set()
        for p in ps:
            dp = [[0] * (len(p) + 1) for _ in range(len(r) + 1)]
            for i, a in enumerate(r):
                for j, b in enumerate(p):
                    dp[i + 1][j + 1] = dp[i][j] + 1 if a == b else max(dp[i][j + 1], dp[i + 1][j])
            i, j = len(r), len(p)
            while i and j:
                if r[i - 1] == p[j - 1]:
                    union.add(i - 1)
                    i, j = i - 1, j - 1
                elif dp[i - 1][j] >= dp[i][j - 1]:
                    i -= 1
                else:
                    j -= 1
        for i in sorted(union):
            if r[i] in left[0] and r[i] in left[1]:
                left[0].remove(r[i])
                left[1].remove(r[i])
                hits += 1
    p, r = hits / np_, hits / nr
    return 2 * p * r / (p + r) if hits else 0.0


def test_rouge_lsum_matches_the_full_table(spark):
    rng = random.Random(5)
    line = lambda: " ".join(rng.choice("a b c d e f g".split()) for _ in range(rng.randrange(0, 14)))
    rows = [(i, "\n".join(line() for _ in range(rng.randrange(1, 5))), "\n".join(line() for _ in range(rng.randrange(1, 5))))
            for i in range(150)] + [(150, None, "a"), (151, "", "")]
    d = spark.createDataFrame(rows, "id int, p string, r string")
    got = {r["id"]: r["fmeasure"] for r in M.rouge_l(d, "id", "p", "r", summary_level=True).collect()}
    assert all(abs(got[i] - _lsum(p or "", r or "")) < 1e-12 for i, p, r in rows)
