"""Operator paths that the registered queries do not exercise."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tokenmill.functions import chat
from tokenmill.operators import metrics as M
from tokenmill.operators import records as R
from tokenmill.operators import runs as U
from tokenmill.operators import tokens as T
from tokenmill.sources import io


def test_publish_and_logs(spark):
    root = tempfile.mkdtemp(prefix="tokenmill-api-")
    df = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "id long, text string")
    path = io.publish(df, root, "org/some-model-with-a-very-long-name-indeed-xxxxx", "team/data")
    assert os.path.basename(path) == "org-some-model-with-a-very-long-name-ind-team-data-candidates"
    assert spark.read.parquet(path).count() == 200
    log = os.path.join(root, "log")
    io.sample_log(df, log, "text", 0.1, "s", "id")
    io.sample_log(df, log, "text", 0.1, "s", "id")  # append mode: twice the lines
    n = spark.read.text(log).where(F.col("value").startswith("text")).count()
    assert n == 2 * io.sample_fraction(df, 0.1, "s", "id").count() and n > 0
    m = io.run_metrics(df, model="m")
    io.append_metrics(m, os.path.join(root, "metrics"))
    assert spark.read.json(os.path.join(root, "metrics")).first().train_samples == 200


def test_record_shapes(spark):
    df = spark.createDataFrame([("a", "p", "n", 0.5), (None, "p", "n", 0.1)],
                               "q string, pos string, neg string, s double")
    assert R.pair_records(df, "triplet", "q", "pos", negative="neg").columns == ["anchor", "positive", "negative"]
    scored = R.pair_records(df, "scored", "q", "pos", score="s")
    assert scored.count() == 1 and scored.first().score == 0.5
    with pytest.raises(ValueError):
        R.pair_records(df, "bad", "q", "pos")
    m = R.to_messages(df, None, "q", None).first().messages
    assert [x.role for x in m] == ["user"]


def test_chat_render_dispatch(spark):
    msgs = F.array(chat.message("user", F.lit("hi")))
    r = spark.range(1).select(*[chat.render(msgs, s).alias(s) for s in
                                ("chatml", "human_assistant", "llama3_header", "gemma_chatml", "starchat")]).first()
    assert r.chatml == "<|im_start|>user\nhi<|im_end|>\n"
    assert r.gemma_chatml.startswith("<bos>") and r.starchat.endswith("<|assistant|>")
    with pytest.raises(ValueError):
        chat.render(msgs, "nope")


def test_fixed_tensor_columns_rejects_ragged(spark):
    df = spark.createDataFrame([([1, 2],), ([1],)], "ids array<int>")
    with pytest.raises(Exception):
        T.fixed_tensor_columns(df, ["ids"], 2).collect()


def test_grid_folder_and_max_length(spark):
    g = U.param_grid(spark.range(1), {"bits": [4], "group_size": [128], "desc_act": [True, False],
                                      "damp": [0.1]})
    names = sorted(r.f for r in g.select(U.grid_folder().alias("f")).collect())
    assert names == ["4bits-128g-desc_act_False-damp_0.1", "4bits-128g-desc_act_True-damp_0.1"]
    df = spark.createDataFrame([([1, 2, 3],), ([1],)], "ids array<int>")
    assert M.max_length(df, "ids").first().max_length == 3
    assert M.max_length(df, "ids", cap=2).first().max_length == 2


def test_spread_deals_small_scans_only(spark):
    from tokenmill.sources import io

    df = spark.range(0, 1000, 1, 2).selectExpr("id", "id % 2 AS k")
    wide = io.spread(df, 6)
    assert wide.rdd.getNumPartitions() == 6 and wide.orderBy("id").collect() == df.orderBy("id").collect()
    assert io.spread(df, 2) is df and io.spread(df.limit(0), 3).count() == 0


def test_equation_is_read_once(spark):
    """The answer's pattern stands once in the plan of the reward."""
    from tokenmill.operators import rewards as W

    df = spark.createDataFrame([(" a</think>\n<answer>3 + 4</answer>", 7, [4, 3]), ("<answer>3+4</answer>", 7, None),
                                (None, 7, [3, 4]), ("<answer>99999999999999999999</answer>", 7, [3])],
                               "c string, t long, n array<long>")
    out = W.equation_reward(df, "c", "t", "n")
    assert [r.equation_reward for r in out.collect()] == [1.0, 0.0, 0.0, 0.0]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("<answer>") == 1


def test_powers_beyond_the_default_limit_on_request(spark):
    from tokenmill.operators import rewards as W

    df = spark.createDataFrame([("<answer>2**5000000//2**4999999</answer>", 2, [2, 5000000, 2, 4999999])], "c string, t long, n array<long>")
    assert W.equation_reward(df, "c", "t", "n").first().equation_reward == 0.0
    assert W.equation_reward(df, "c", "t", "n", max_power_bits=None).first().equation_reward == 1.0
