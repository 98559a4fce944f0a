"""The composed end-to-end jobs on the smallest driver tables."""

import os
import tempfile

from pyspark.sql import functions as F

from tokenmill.plans import jobs, tables

SF = "/root/testdata/sf0.001"


def test_supervised_dataset(spark):
    d = tables.table(spark, SF, "documents")
    parts = F.split("text", "\n")
    art = d.select(F.when(F.col("doc_id") % 10 == 0, "test").otherwise("train").alias("split"),
                   F.get(parts, 0).alias("article"), F.coalesce(F.get(parts, 1), F.lit("")).alias("highlights"))
    out_dir = os.path.join(tempfile.mkdtemp(prefix="tokenmill-job-"), "prepared")
    feats = jobs.supervised_dataset(art, "article", "highlights", max_source=512, vocab_size=500,
                                    out_dir=out_dir)
    rows = spark.read.parquet(out_dir).collect()
    assert len(rows) == d.count()
    widths = {(len(r.input_ids), len(r.attention_mask), len(r.labels)) for r in rows}
    assert len(widths) == 1
    w = widths.pop()
    assert w[0] == w[1] <= 512
    assert all(x == -100 or x >= 1 for r in rows for x in r.labels)
    assert feats.columns == ["split", "input_ids", "attention_mask", "labels"]


def test_preference_and_reward_jobs(spark):
    c = tables.candidates(spark, SF)
    pairs = jobs.preference_dataset(c, system_prompt="Answer.", sample_size=25)
    got = pairs.collect()
    assert len(got) == 25 and all(r.chosen and r.rejected for r in got)
    t = jobs.reward_tasks(tables.countdown(spark, SF), "task_id", n=None)
    assert t.where("split = 'test'").count() > 0 and "prompt" in t.columns
