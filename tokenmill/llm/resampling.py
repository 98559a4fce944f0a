"""Importance resampling of documents towards a target distribution.

Features are runs of one to three words, hashed to ``BUCKETS`` buckets by
crc32. Two passes over the texts: the first counts buckets in the corpus
and in the target texts (a task adds up one array and sends it once); the
second scores each text by looking its buckets up in an array of whole
gains, so a weight is exact. Hashes of runs come from the hashes of their
words: ``crc(A + B)`` is ``crc(A)`` carried over the length of ``B`` by a
table, xor ``crc(B)``, for all words of a run of rows at once.

Weight plus seeded Gumbel noise is the score; the highest scores are drawn.
They are ranked by parallel sorting by regular sampling: every task sorts
its run and keeps samples at regular places; the weighted samples give
splitters; rows move to the segment between two splitters, which is sorted
there; and the prefix sums of the segments' counts make places in a segment
exact ranks. Segments wholly behind the last drawn rank are counted but not
moved. The driver holds bucket counts, at most ``RUNS * SAMPLES`` samples
and ``SEGMENTS`` counts.

Edge cases: null and empty texts and texts without words have no features,
weight 0 and are never among the candidates (fewer than ``min_words``); a
null id is hashed as empty and comes last among ties; rows that repeat an
id and a score have consecutive ranks in any order; an empty target makes
every feature count once there; an empty table gives an empty result; extra
columns are ignored. A text is held whole, one at a time if it is long.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tokenmill.llm.common import slices, written

BUCKETS = 10_000
WIDEST = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
RUNS, SAMPLES = 512, 256  # sorted runs, and samples of a run
SEGMENTS, SEGMENT_ROWS = 4096, 200  # most segments, and rows of one while there are fewer
STEPS = 64  # lengths that a table carries a crc over at once

# A-Z to a-z, other ASCII but digits and letters to blanks, the rest as it is
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                    for b in range(256))


def _carry_tables() -> np.ndarray:
    """[n][k][v]: the crc with byte ``v`` at place ``k`` after ``n`` more zero bytes (no final inversion)."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0xEDB88320), one >> 1).astype(np.uint32)
    out = np.empty((STEPS, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for n in range(1, STEPS):
        out[n] = one[out[n - 1] & 0xFF] ^ (out[n - 1] >> 8)
    return out


_CARRY = _carry_tables()


def carried(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The part of ``crc32(A + B)`` that comes from ``crc32(A)``, for B of ``length`` bytes."""
    step = np.minimum(length, STEPS - 1)
    out = _CARRY[step, 0, crc & 0xFF]
    for k in (1, 2, 3):
        out = out ^ _CARRY[step, k, (crc >> np.uint32(8 * k)) & 0xFF]
    more = np.flatnonzero(length > STEPS - 1)
    if len(more):
        out[more] = carried(out[more], length[more] - (STEPS - 1))
    return out


def hashed(texts: list[str | None]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(words of every text, for each run length the bucket that starts at every word or -1)."""
    words = [t.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if t else [] for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    total = int(sizes.sum())
    crc = np.fromiter(map(zlib.crc32, chain.from_iterable(words)), np.uint32, total)
    length = np.fromiter(map(len, chain.from_iterable(words)), np.int64, total)
    behind = np.repeat(np.cumsum(sizes), sizes) - np.arange(1, total + 1)  # words of the same text that follow
    spaced = carried(np.full(total, zlib.crc32(b" "), np.uint32), length) ^ crc  # of a blank and the word
    out, run = [], crc
    for n in range(WIDEST):
        if n:
            run = carried(run[:max(0, total - n)], length[n:] + 1) ^ spaced[n:]
        at = np.full(total, -1, np.int64)
        at[:len(run)] = run % np.uint32(BUCKETS)
        at[behind < n] = -1
        out.append(at)
    return sizes, out


def bucket_counts(df: DataFrame, text_col: str) -> np.ndarray:
    """Features of all texts by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in slices(batches):
            for at in hashed(b.column(0).to_pylist())[1]:
                total += np.bincount(at[at >= 0], minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for r in df.select(F.col(text_col)).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole log ratios (thousandths) of the smoothed target and corpus frequencies."""
    s_all, t_all = float(int(corpus.sum()) + BUCKETS), float(int(target.sum()) + BUCKETS)
    return np.array([math.floor(1000 * math.log((float(t + 1) * s_all) / (float(s + 1) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weighed(df: DataFrame, id_col: str, text_col: str, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    lookup = np.append(gain, 0)  # -1: no feature

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sizes, runs = hashed(b.column(1).to_pylist())
            each = np.concatenate([[0], np.cumsum(sum(lookup[at] for at in runs))]).astype(np.int64)
            ends = np.cumsum(sizes)
            features = sum(np.maximum(0, sizes - n) for n in range(WIDEST))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), pa.array(features),
                                              pa.array(each[ends] - each[ends - sizes])],
                                             ["doc_id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def with_noise(df: DataFrame, seed: int) -> DataFrame:
    """Adds ``score``: weight plus Gumbel noise of the id, whole thousandths."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return df.withColumn("score", F.col("weight") + gumbel)


def key(score, doc_id, tie) -> tuple:
    """Places rows: high scores first, then small ids, nulls last."""
    return -score, doc_id is None, 0 if doc_id is None else doc_id, tie


def regular_samples(rows: DataFrame) -> list[tuple[tuple, int]]:
    """(key, rows it stands for) of rows at regular places of locally sorted runs, in order."""
    id_type = to_arrow_type(rows.schema["doc_id"].dataType)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        kept, stride, seen = [], 1, 0
        for b in batches:
            cols = b.to_pydict()
            for row in zip(cols["score"], cols["doc_id"], cols["tie"], strict=True):
                if seen % stride == 0:
                    kept.append(row)
                    if len(kept) == SAMPLES:  # a longer run: every other place
                        kept, stride = kept[::2], 2 * stride
                seen += 1
        score, doc_id, tie = zip(*kept) if kept else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(score, pa.int64()), pa.array(doc_id, id_type), pa.array(tie, pa.int64()),
                                          pa.array([stride] * len(kept), pa.int64())], ["score", "doc_id", "tie", "stride"])

    # at most RUNS runs of fewer than SAMPLES samples
    runs = rows.coalesce(RUNS).sortWithinPartitions(F.desc("score"), F.asc_nulls_last("doc_id"), "tie")
    got = runs.mapInArrow(run, f"score long, doc_id {kind}, tie long, stride long").collect()
    return sorted((key(r["score"], r["doc_id"], r["tie"]), r["stride"]) for r in got)


def splitters(samples: list[tuple[tuple, int]], pieces: int) -> list[tuple]:
    """Keys that cut the weighted samples into about ``pieces`` equal parts."""
    total, seen, out = sum(n for _, n in samples), 0, []
    for k, n in samples:
        if seen * pieces >= (len(out) + 1) * total:
            out.append(k)
        seen += n
    return out


def ranked(candidates: DataFrame, n: int, draw: int) -> DataFrame:
    """``candidates`` (score, doc_id, tie and others) with ``rank``: 1.. for the ``draw`` first, else null."""
    cuts = splitters(regular_samples(candidates.select("score", "doc_id", "tie")),
                     max(1, min(SEGMENTS, n // SEGMENT_ROWS)))

    def place(batches):
        for b in batches:
            cols = b.to_pydict()
            at = [bisect.bisect_right(cuts, key(*row)) for row in zip(cols["score"], cols["doc_id"], cols["tie"], strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int32())], [*b.schema.names, "segment"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in candidates.schema.fields)
    placed = written(candidates.mapInArrow(place, f"{kinds}, segment int"), "placed")
    counts = {r["segment"]: r["count"] for r in placed.groupBy("segment").count().collect()}
    before, last, total = {}, -1, 0
    for s in sorted(counts):
        if total < draw:
            last = s
        before[s] = total
        total += counts[s]
    spark = candidates.sparkSession
    # one row per segment
    offsets = F.broadcast(spark.createDataFrame(sorted(before.items()), "segment int, before long"))
    order = Window.partitionBy("segment").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "tie")
    moved = (placed.where(F.col("segment") <= last).withColumn("place", F.row_number().over(order)).join(offsets, "segment")
             .withColumn("rank", F.col("before") + F.col("place")))
    rank = F.when(F.col("rank") <= draw, F.col("rank")).cast("long")
    rest = placed.where(F.col("segment") > last).withColumn("rank", F.lit(None).cast("long"))
    return moved.select(*candidates.columns, rank.alias("rank")).unionByName(rest.drop("segment"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of
    ``docs``; ``percent`` of those with ``min_words`` words are drawn."""
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_col))
    scored = written(with_noise(weighed(docs, id_col, text_col, gain), seed)
                     .withColumn("tie", F.monotonically_increasing_id()), "scored")
    candidates = scored.where(F.col("n_words") >= min_words)
    n = candidates.count()
    draw = percent * n // 100
    rest = scored
    if draw:
        rest = scored.where(F.col("n_words") < min_words)
    out = rest.withColumn("rank", F.lit(None).cast("long"))
    if draw:
        out = ranked(candidates, n, draw).unionByName(out)
    return out.select("doc_id", "n_words", "n_features", "weight", "score", "rank")
