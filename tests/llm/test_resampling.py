"""Importance resampling against a plain model."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np

from tests.llm.corpus import frame, odd_texts, words
from tokenmill.llm import resampling as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def model(ids, texts, target):
    corpus, wanted = collections.Counter(), collections.Counter()
    docs = [(i, *features(t)) for i, t in zip(ids, texts, strict=True)]
    for _, _, f in docs:
        corpus.update(f)
    for t in target:
        wanted.update(features(t)[1])
    s, t = sum(corpus.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + 10000) / ((corpus[b] + 1) * (t + 10000)))) for b in range(10000)]
    out = []
    for i, n, f in docs:
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((-x[4], x[0]) for x in out if x[1] >= 20)
    rank = {i: k + 1 for k, (_, i) in enumerate(order[:5 * len(order) // 100])}
    return {(*x, rank.get(x[0])) for x in out}


def corpus():
    rng = random.Random(8)
    return odd_texts() + [" ".join(words(rng, rng.randrange(5, 60), 400)) + ", É-x 9." for _ in range(900)]


def test_against_plain_model(spark):
    texts = corpus()
    target = spark.createDataFrame([(0, " ".join(words(random.Random(8), 500, 400)), 1), (1, None, 2), (2, "", 3)],
                                   "item_id long, text string, score long")
    got = R.resample(frame(spark, texts).repartition(7), target)
    want = model(range(len(texts)), texts, [r["text"] for r in target.collect()])
    assert {tuple(r) for r in got.collect()} == want
    assert sorted(r["rank"] for r in got.where("rank is not null").collect()) == list(range(1, 1 + max(x[5] or 0 for x in want)))


def test_ranks_need_every_segment(spark, monkeypatch):
    """All rows drawn, few samples, a segment of a third of all rows (one id and one text)."""
    monkeypatch.setattr(R, "SAMPLES", 8)
    monkeypatch.setattr(R, "SEGMENT_ROWS", 5)
    rng = random.Random(1)
    texts = [" ".join(words(rng, 30, 50)) for _ in range(400)] + ["same text " * 12] * 200
    ids = [*range(400), *[7] * 200]
    rows = R.resample(frame(spark, texts, ids=ids).repartition(9), frame(spark, texts[:3]), percent=100).collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, 601))
    by_rank = sorted(rows, key=lambda r: r["rank"])
    assert [(-r["score"], r["doc_id"]) for r in by_rank] == sorted((-r["score"], r["doc_id"]) for r in rows)


def test_no_candidates_nulls_and_empty_tables(spark):
    few = R.resample(frame(spark, ["a b", None, ""], ids=[1, None, 2]), frame(spark, [])).collect()
    assert {(r["doc_id"], r["n_features"], r["rank"]) for r in few} == {(1, 3, None), (None, 0, None), (2, 0, None)}
    assert R.resample(frame(spark, []), frame(spark, ["a"])).count() == 0
    many = R.resample(frame(spark, ["x y z " * 9] * 40, ids=[None] * 40), frame(spark, [])).collect()
    assert sorted(r["rank"] for r in many if r["rank"]) == [1, 2]


def test_hashes_of_runs():
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abc0é") for _ in range(rng.choice([1, 3, 62, 63, 64, 65, 126, 127, 500, 4000])))
                      for _ in range(rng.randrange(6))) for _ in range(60)] + [None, ""]
    sizes, runs = R.hashed(texts)
    at = 0
    for n, text in zip(sizes.tolist(), texts, strict=True):
        count, want = features(text)
        assert n == count
        assert [b for run in runs for b in run[at:at + n].tolist() if b >= 0] == want
        at += n


def test_splitters_are_balanced():
    rng = np.random.default_rng(0)
    samples = sorted(((float(x), False, 0, 0), 10) for x in rng.normal(size=3000))
    cuts = R.splitters(samples, 50)
    sizes = np.diff([0, *np.searchsorted([s[0][0] for s in samples], [c[0] for c in cuts]), 3000])
    assert len(cuts) in (49, 50) and sizes[1:].max() <= 2 * 60
