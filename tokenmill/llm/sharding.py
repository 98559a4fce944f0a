"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Rows with equal texts form a group and stay together. Groups are hashed
into buckets; inside a bucket, k-way differencing starts from one partial
partition per group and repeatedly combines the two with the largest
spread (largest minus smallest sum), one in descending and the other in
ascending order, until one partial partition is left. The buckets' partial
partitions (k sums each) are then combined the same way on the driver,
which sees k numbers per bucket and never a group or a row.

Edge cases: null texts are one group of size 1 per row (no bytes plus 1);
empty texts likewise form one group; repeated rows and null ids are
ordinary rows; an empty table gives an empty result; extra columns are
ignored. A group larger than a shard's share cannot be divided: it then
fills its shard alone as far as differencing allows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tokenmill.llm.common import written

GROUPS_PER_BUCKET = 50_000
ROWS_PER_NUMBERING = 500_000


def difference(parts: list[tuple[int, ...]], k: int) -> tuple[list[tuple[int, ...]], tuple[int, ...]]:
    """Combine partial partitions (k sums each) into one.

    Returns, per input, the final position of each of its k places, and
    the k final sums."""
    if not parts:
        return [], (0,) * k
    children: list[tuple | None] = [None] * len(parts)
    heap = []
    for i, p in enumerate(parts):
        order = tuple(sorted(range(k), key=lambda j: -p[j]))
        sums = tuple(p[j] for j in order)
        heap.append((-(sums[0] - sums[-1]), i, sums, order, i))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a, pa, na = heapq.heappop(heap)
        _, _, b, pb, nb = heapq.heappop(heap)
        joined = [(a[j] + b[k - 1 - j], j) for j in range(k)]
        joined.sort(key=lambda x: -x[0])
        node = len(children)
        # place j of the new partition holds place left[j] of a and right[j] of b
        left = tuple(pa[j] for _, j in joined)
        right = tuple(pb[k - 1 - j] for _, j in joined)
        children.append((na, left, nb, right))
        sums = tuple(s for s, _ in joined)
        heapq.heappush(heap, (-(sums[0] - sums[-1]), node, sums, tuple(range(k)), node))
    _, _, sums, order, root = heap[0]
    place: list[list[int] | None] = [None] * len(children)
    at = [0] * k
    for j, o in enumerate(order):
        at[o] = j
    place[root] = at
    for node in range(len(children) - 1, -1, -1):
        if children[node] is None:
            continue
        na, left, nb, right = children[node]
        here = place[node]
        for child, places in ((na, left), (nb, right)):
            to = [0] * k
            for j, p in enumerate(places):
                to[p] = here[j]
            place[child] = to
        place[node] = None
    return [tuple(place[i]) for i in range(len(parts))], sums


def assign_groups(groups: DataFrame, k: int, n_groups: int,
                  groups_per_bucket: int = GROUPS_PER_BUCKET) -> DataFrame:
    """(key, shard) for ``groups(key, bytes)``, one row per group."""
    buckets = max(8, -(-n_groups // groups_per_bucket))

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key", ignore_index=True)
        parts = [(int(b),) + (0,) * (k - 1) for b in pdf["bytes"]]
        places, sums = difference(parts, k)
        out = pdf[["key", "bucket"]].assign(place=np.array([p[0] for p in places], "int32"), sums=None)
        out.at[0, "sums"] = list(sums)
        return out

    bucketed = groups.select("key", "bytes", F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"))
    placed = written(bucketed.groupBy("bucket").applyInPandas(
        local, "key binary, bucket long, place int, sums array<long>"), "kk")
    tops = placed.where("sums is not null").select("bucket", "sums").orderBy("bucket").collect()
    places, _ = difference([tuple(r["sums"]) for r in tops], k)
    spark = groups.sparkSession
    to = spark.createDataFrame([(r["bucket"], list(p)) for r, p in zip(tops, places, strict=True)],
                               "bucket long, places array<int>")
    # k numbers per bucket of tens of thousands of groups: bounded by the bucket count above
    to = F.broadcast(to) if buckets <= 100_000 else to
    return placed.join(to, "bucket").select("key", F.element_at("places", F.col("place") + 1).alias("shard"))


def numbered(df: DataFrame, by: str, part: str, out: str) -> DataFrame:
    """Gapless numbers from 0 within ``by``; ``part`` cuts every value of
    ``by`` into row blocks that are counted, then numbered on their own."""
    counts = df.groupBy(by, part).count()
    before = W.partitionBy(by).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(by, part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy(by, part).orderBy(F.lit(0))
    return (df.withColumn("_in", F.row_number().over(inside) - 1)
            .join(counts, [by, part]).withColumn(out, (F.col("_before") + F.col("_in")).cast("long"))
            .drop("_before", "_in", part))


def shard_documents(df: DataFrame, k: int = 8, id_col: str = "doc_id", text_col: str = "text",
                    groups_per_bucket: int = GROUPS_PER_BUCKET) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``df``.

    ``size`` is the UTF-8 byte count plus 1, ``slot`` a gapless number from
    0 within the shard. Equal texts share a shard.
    """
    text = F.col(text_col)
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0).cast("long")).alias("text_crc32"),
        F.coalesce(F.unhex(F.md5(text.cast("binary"))), F.lit(b"").cast("binary")).alias("key"))
    groups = written(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "groups")
    n_groups, n_rows = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    placed = assign_groups(groups, k, n_groups, groups_per_bucket)
    blocks = max(1, -(-n_rows // ROWS_PER_NUMBERING))
    # the block of a row is drawn once and written, so repeated keys spread and later reads agree
    joined = written(rows.join(placed, "key").drop("key")
                     .withColumn("_part", F.pmod(F.monotonically_increasing_id(), F.lit(blocks))), "shards")
    return numbered(joined, "shard", "_part", "slot")


def spread(sums: Iterator[int]) -> int:
    """Largest minus smallest of the shard sizes."""
    s = list(sums)
    return max(s) - min(s) if s else 0
