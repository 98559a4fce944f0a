"""Pairwise quality ranking: held-out accuracy, pairs, quantile, odd rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.corpus import frame, odd_texts
from tokenmill.llm import quality as Q

DATA = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, Q.score_quality(docs, labels).cache()


def test_held_out_accuracy(scored):
    _, labels, got = scored
    rows = got.join(labels.where("quality is not null"), "doc_id").where("held_out").collect()
    y, s = np.array([r["quality"] for r in rows]), np.array([r["score"] for r in rows])
    above = (s[y == 1][:, None] > s[y == 0]).mean() + 0.5 * (s[y == 1][:, None] == s[y == 0]).mean()
    assert above > 0.98
    predicted = np.array([r["predicted"] for r in rows])
    assert (predicted == y).mean() > 0.97 and predicted[y == 1].mean() > 0.97
    assert (predicted == (s >= 0.3)).all() and s.min() >= 0 and s.max() <= 1


def test_held_out_labels_and_other_columns_do_not_count(spark, scored):
    docs, labels, got = scored
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality"))
                               .otherwise(F.col("quality")))
    other = Q.score_quality(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")), turned)
    far = got.select("doc_id", "score").join(other.select("doc_id", F.col("score").alias("s2")), "doc_id")
    assert far.agg(F.max(F.abs(F.col("score") - F.col("s2")))).first()[0] < 1e-6
    assert got.count() == docs.count()


def test_pairs_differ_in_label_and_spread(spark):
    rows = [(i, int(i % 4 > 0), True, [float(i % 4 > 0), float(i)]) for i in range(100)]
    table = spark.createDataFrame(rows, "doc_id long, label int, fit boolean, features array<double>")
    pairs = Q.preference_pairs(table, [[0.5], [10.0, 50.0]]).collect()
    assert len(pairs) == 75 * Q.ROUNDS
    # the first step is 1 for the preferred document only; pairs of y = 0 are turned round
    assert all(p["vector"][0] == (1.0 if p["y"] == 1 else -1.0) for p in pairs)
    assert 0.4 < np.mean([p["y"] for p in pairs]) < 0.6
    turned = Q.preference_pairs(table.withColumn("label", 1 - F.col("label")), [[0.5], [10.0, 50.0]]).collect()
    assert all(p["vector"][0] == (-1.0 if p["y"] == 1 else 1.0) for p in turned)


@pytest.mark.parametrize("strength,label,errors", [
    ([1, 2, 3, 4], [0, 0, 1, 1], 0), ([1, 1, 2, 2], [0, 1, 1, 1], 1), ([5, 5, 5], [0, 1, 1], 1), ([3, 1, 2], [0, 1, 1], 1)])
def test_quantile_has_the_fewest_errors(strength, label, errors):
    place, q = Q.best_quantile(np.array(strength, float), np.array(label))
    got = sum((s > place) != bool(y) for s, y in zip(strength, label, strict=True))
    assert got == errors and 0 <= q <= 1


def test_score_at_the_quantile():
    m = Q.QualityModel([np.array([0.0])], [np.array([0.0, 2.0])], place=2.0)
    low, at = m.scores(np.array([[0.0], [1.0]]))
    assert at == 0.3 and math.isclose(low, 1 / (1 + math.exp(2 + math.log(0.7 / 0.3))))


def test_odd_rows(spark):
    texts = odd_texts()
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, i % 2, 5) for i in range(0, 120)] + [(3, None, 1), (None, 1, 1), (5, 0, 1)],
                                   "doc_id long, quality int, score int")
    got = Q.score_quality(docs, labels).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(texts)))
    assert all(0 <= r["score"] <= 1 for r in got)
    same = {r["doc_id"]: r["score"] for r in got}
    assert same[0] == same[1] == same[3]  # null and blank texts
    assert Q.score_quality(frame(spark, []), labels).count() == 0
    none = Q.score_quality(docs, labels.limit(0)).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.0, 0)}
    ones = Q.score_quality(docs, labels.where("quality = 1")).collect()
    assert {(r["score"], r["predicted"]) for r in ones} == {(1.0, 1)}
    assert [math.isfinite(x) for t in texts for x in Q.features(t)].count(False) == 0
