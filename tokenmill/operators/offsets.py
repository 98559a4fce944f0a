"""Global positions and running offsets without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` pulls every row into one
task. Instead rows are cut into quantile buckets of the ordering key:

1. ``approxQuantile`` of the key gives ``n_buckets - 1`` cut points
   (a bounded list on the driver),
2. a ``Bucketizer`` maps every row to its bucket (binary search, JVM side),
3. a tiny per-bucket count/size table is prefix-summed and broadcast
   (one row per bucket: a proven size bound),
4. inside each bucket a partitioned window numbers rows and sums sizes.

Other key types, descending order and hot first-key values take a range
partitioning on all keys, written once, in place of steps 1 and 2.

Buckets are balanced by construction, so a hot ordering value range is
spread over many tasks; the bucket of a row is a pure function of its
key (or read from the written table), so a recomputed (lost) task lands
rows in the same bucket again.

``first_n`` and ``rows_at`` need a position for a few rows only: the
bucket counts settle every bucket but the boundary one(s), which alone
are ranked.
"""

from __future__ import annotations

import math
import uuid
from fractions import Fraction

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.session import scratch_path

_BUCKET = "_tm_bucket"
_KEYD = "_tm_keyd"


MAX_BUCKETS = 16384


def default_buckets(df: DataFrame) -> int:
    """Four buckets per shuffle partition (the session's partition count is
    sized for the data volume), capped."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    return min(MAX_BUCKETS, max(4, parts * 4))


def hash_key(*cols: Column | str, seed: str = "") -> Column:
    """Reproducible 60-bit integer from an md5 of ``seed`` and the columns.

    The same value is computable in any SQL engine with md5 (the first
    15 hex digits of ``md5(seed || '-' || col...)``).
    """
    parts = [F.lit(seed)] + [F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                             for c in cols]
    h = F.md5(F.concat_ws("-", *parts))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def hash_cut(fraction: float) -> int:
    """The ``hash_key`` below which ``fraction`` of all keys lie (60-bit resolution)."""
    return int(Fraction(fraction) * (1 << 60))


def _is_numeric(df: DataFrame, c: Column) -> bool:
    t = df.select(c).schema.fields[0].dataType.typeName()
    return t in ("byte", "short", "integer", "long", "float", "double") or t.startswith("decimal")


def _range_buckets(df: DataFrame, keys: list[Column], n_buckets: int) -> DataFrame:
    """Bucket id per row from a range partitioning on the whole key list:
    any types, ascending or descending, nulls included. A value that many
    rows share is cut by the keys behind it. The rows are written once, so
    every later step sees the same buckets."""
    # sampled ranges are less even than quantile cuts: twice as many of them
    cut = df.repartitionByRange(2 * n_buckets, *keys).withColumn(_BUCKET, F.spark_partition_id().cast("bigint"))
    path = scratch_path(df.sparkSession, f"ranges-{uuid.uuid4().hex}")
    cut.write.parquet(path)
    return df.sparkSession.read.schema(cut.schema).parquet(path)


def _descends(c: Column) -> bool:
    return " DESC" in str(c).upper()


def _bucketize(df: DataFrame, keys: list[Column], n_buckets: int) -> DataFrame:
    """Bucket id per row, monotone in the order of ``keys``.

    A numeric ascending first key without hot values takes quantile cut
    points and a ``Bucketizer`` (no shuffle). Any other order, and a first
    key with a value that fills several quantile slots, is cut by a range
    partitioning on all keys."""
    if _descends(keys[0]) or not _is_numeric(df, keys[0]):
        return _range_buckets(df, keys, n_buckets)
    with_key = df.withColumn(_KEYD, F.coalesce(keys[0].cast("double"), F.lit(-1.0e308)))
    cuts: list[float] = []
    if n_buckets > 1:
        probs = [i / n_buckets for i in range(1, n_buckets)]
        cuts = with_key.approxQuantile(_KEYD, probs, 1.0 / (4 * n_buckets))
    if len(set(cuts)) < len(cuts) and len(keys) > 1:
        return _range_buckets(df, keys, n_buckets)
    splits = [-math.inf] + sorted({c for c in cuts if math.isfinite(c)}) + [math.inf]
    if len(splits) < 3:
        out = with_key.withColumn(_BUCKET, F.lit(0).cast("double"))
    else:
        bz = Bucketizer(splits=splits, inputCol=_KEYD, outputCol=_BUCKET, handleInvalid="keep")
        out = bz.transform(with_key)
    return out.withColumn(_BUCKET, F.col(_BUCKET).cast("bigint")).drop(_KEYD)


def with_positions(df: DataFrame, order: list[Column | str], *,
                   size: Column | str | None = None,
                   pos_col: str = "row_id", start_col: str = "start",
                   total_col: str | None = None, total_size_col: str | None = None,
                   n_buckets: int | None = None) -> DataFrame:
    """Add a dense 0-based position in ``order`` and, if ``size`` is given,
    the running total of ``size`` over all earlier rows (``start_col``).

    ``order`` columns may be of any type and direction; the full list must
    make rows unique for a deterministic result.
    ``total_col`` / ``total_size_col`` add the grand row count / size sum,
    taken from the same per-bucket table (no extra action, no cross join).
    """
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    n_buckets = n_buckets or default_buckets(df)
    b = _bucketize(df, order_cols, n_buckets)
    size_c = None if size is None else (F.col(size) if isinstance(size, str) else size)

    aggs = [F.count(F.lit(1)).alias("_tm_n")]
    if size_c is not None:
        aggs.append(F.coalesce(F.sum(size_c), F.lit(0)).cast("bigint").alias("_tm_sz"))
    per_bucket = b.groupBy(_BUCKET).agg(*aggs)
    # one row per bucket: a single-partition window is fine here
    wb = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    wall = Window.partitionBy(F.lit(0))
    extra = []
    if total_col:
        extra.append(F.sum("_tm_n").over(wall).cast("bigint").alias(total_col))
    if total_size_col and size_c is not None:
        extra.append(F.sum("_tm_sz").over(wall).cast("bigint").alias(total_size_col))
    prefix = per_bucket.select(
        _BUCKET,
        F.coalesce(F.sum("_tm_n").over(wb), F.lit(0)).alias("_tm_n0"),
        *([F.coalesce(F.sum("_tm_sz").over(wb), F.lit(0)).alias("_tm_sz0")]
          if size_c is not None else []), *extra)
    joined = b.join(F.broadcast(prefix), _BUCKET)
    w = Window.partitionBy(_BUCKET).orderBy(*order_cols)
    out = joined.withColumn(pos_col, (F.col("_tm_n0") + F.row_number().over(w) - 1).cast("bigint"))
    if size_c is not None:
        run = F.sum(size_c).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        out = out.withColumn(start_col, (F.col("_tm_sz0") + run - size_c).cast("bigint"))
    return out.drop(_BUCKET, "_tm_n0", "_tm_sz0")


def first_n(df: DataFrame, order: list[Column | str], n: int | None = None,
            fraction: float | None = None, flag_col: str = "_tm_first",
            n_buckets: int | None = None) -> DataFrame:
    """Flag the first ``n`` rows (or the first ``ceil(fraction * count)``)
    in ``order`` without ranking every row.

    With per-bucket counts and their prefix sums (one tiny table), every
    bucket lies wholly inside or wholly outside the first ``n`` rows,
    except one boundary bucket. Only that bucket's rows are shuffled and
    numbered; all other rows keep their partitions.
    """
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    n_buckets = n_buckets or default_buckets(df)
    b = _bucketize(df, order_cols, n_buckets)
    per_bucket = b.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("_tm_k"))
    wb = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    prefix = per_bucket.select(
        _BUCKET, "_tm_k", F.coalesce(F.sum("_tm_k").over(wb), F.lit(0)).alias("_tm_n0"),
        F.sum("_tm_k").over(Window.partitionBy(F.lit(0))).alias("_tm_total"))
    if n is not None:
        target = F.least(F.lit(int(n)).cast("bigint"), F.col("_tm_total"))
    else:
        target = F.ceil(F.col("_tm_total") * F.lit(float(fraction))).cast("bigint")
    prefix = prefix.withColumn("_tm_target", target)
    j = b.join(F.broadcast(prefix), _BUCKET)
    decided = F.when(F.col("_tm_n0") + F.col("_tm_k") <= F.col("_tm_target"), F.lit(True)) \
        .when(F.col("_tm_n0") >= F.col("_tm_target"), F.lit(False))
    j = j.withColumn(flag_col, decided)
    settled = j.where(F.col(flag_col).isNotNull())
    w = Window.partitionBy(_BUCKET).orderBy(*order_cols)
    boundary = j.where(F.col(flag_col).isNull()).withColumn(
        flag_col, F.col("_tm_n0") + F.row_number().over(w) - 1 < F.col("_tm_target"))
    drop = [_BUCKET, "_tm_k", "_tm_n0", "_tm_total", "_tm_target"]
    return settled.drop(*drop).unionByName(boundary.drop(*drop))


def rows_at(df: DataFrame, order: list[Column | str], positions: list[int],
            pos_col: str = "row_id", n_buckets: int | None = None) -> DataFrame:
    """The rows at the given 0-based positions in ``order``; only the
    buckets containing those positions are shuffled and numbered."""
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    n_buckets = n_buckets or default_buckets(df)
    b = _bucketize(df, order_cols, n_buckets)
    per_bucket = b.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("_tm_k"))
    wb = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    prefix = per_bucket.select(_BUCKET, "_tm_k",
                               F.coalesce(F.sum("_tm_k").over(wb), F.lit(0)).alias("_tm_n0"))
    wanted = None
    for p in positions:
        c = (F.col("_tm_n0") <= p) & (F.lit(p) < F.col("_tm_n0") + F.col("_tm_k"))
        wanted = c if wanted is None else (wanted | c)
    prefix = prefix.where(wanted if wanted is not None else F.lit(False))
    j = b.join(F.broadcast(prefix), _BUCKET)
    w = Window.partitionBy(_BUCKET).orderBy(*order_cols)
    out = j.withColumn(pos_col, (F.col("_tm_n0") + F.row_number().over(w) - 1).cast("bigint"))
    return out.where(F.col(pos_col).isin([int(p) for p in positions])) \
        .drop(_BUCKET, "_tm_k", "_tm_n0")


def running_offset(df: DataFrame, order: list[Column | str], size: Column | str,
                   col: str = "offset") -> DataFrame:
    """WIN-4: the sum of ``size`` over all rows before this one in
    ``order`` (the carry of earlier rows), computed bucket-wise."""
    return with_positions(df, order, size=size, start_col=col, pos_col="_tm_pos").drop("_tm_pos")
