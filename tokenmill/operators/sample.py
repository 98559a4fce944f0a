"""Ordering, sampling, splitting and concatenation (ORD, SPL, SET).

Randomness is a pure function of the data: an md5 of ``seed-id``. The
same rows come out on every recomputation and in any SQL engine with md5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.operators.offsets import first_n, hash_cut, hash_key, rows_at

ColumnOrName = Column | str

# Largest n for which ``orderBy().limit(n)`` (a top-n heap per task) is
# used: its final merge takes up to n rows from every input partition into
# one task. Beyond it rows are ranked with bucketed positions.
TAKE_ORDERED_MAX = 10_000


def shuffle_key(id_col: ColumnOrName, seed: int | str) -> Column:
    return hash_key(id_col, seed=str(seed))


# ORD-1 ---------------------------------------------------------------
def shuffle(df: DataFrame, seed: int | str, id_col: str) -> DataFrame:
    """Reproducible random order (a global range-partitioned sort)."""
    return df.orderBy(shuffle_key(id_col, seed), F.col(id_col))


# ORD-2 ---------------------------------------------------------------
def head(df: DataFrame, n: int, order_by: list[ColumnOrName], method: str = "auto") -> DataFrame:
    """First ``n`` rows in ``order_by`` order.

    ``method="heap"``: ``orderBy().limit(n)`` (a top-n heap per task, then
    one merge of at most ``n`` rows per partition); ``"rank"``: bucket
    counts decide every bucket but the one straddling ``n``, which alone
    is ranked, and the ``n`` rows are then sorted (any n); ``"auto"`` picks
    the heap up to ``TAKE_ORDERED_MAX`` rows. Rows and their order are the
    same either way.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    if method == "heap" or (method == "auto" and n <= TAKE_ORDERED_MAX):
        return df.orderBy(*cols).limit(n)
    return first_n(df, cols, n=n, flag_col="_tm_in").where("_tm_in").drop("_tm_in").orderBy(*cols)


# ORD-3 / ORD-4 -------------------------------------------------------
def sample_n(df: DataFrame, n: int, seed: int | str, id_col: str,
             method: str = "auto") -> DataFrame:
    """Shuffle, then take ``n`` rows (exactly ``min(n, count)``)."""
    return head(df, n, [shuffle_key(id_col, seed), F.col(id_col)], method=method)


def random_rows(df: DataFrame, n: int, seed: int | str, id_col: str) -> DataFrame:
    return sample_n(df, n, seed, id_col)


# ORD-5 ---------------------------------------------------------------
def row_at(df: DataFrame, i: int, order_by: list[ColumnOrName]) -> DataFrame:
    """Positional access ``ds[i]``: only the bucket holding position ``i``
    is ranked."""
    return rows_at(df, order_by, [i], pos_col="row_id")


# ORD-6 ---------------------------------------------------------------
def keep_latest(df: DataFrame, n: int, key: str, order: ColumnOrName,
                tie: tuple[str, ...] = ()) -> DataFrame:
    """Last ``n`` records per ``key`` by ``order``, then by the ``tie``
    columns, largest first (window group limit: each task pre-filters to
    ``n`` rows per key before the shuffle)."""
    o = F.col(order) if isinstance(order, str) else order
    w = Window.partitionBy(key).orderBy(o.desc(), *[F.desc(t) for t in tie])
    return df.withColumn("_tm_rn", F.row_number().over(w)).where(F.col("_tm_rn") <= n) \
        .drop("_tm_rn")


# SPL-1 ---------------------------------------------------------------
def test_size(n_rows: Column, test: float | int) -> Column:
    """Exact test count: ``ceil(test * n)`` for a fraction, ``test`` for a count."""
    if isinstance(test, float) and test < 1.0:
        return F.ceil(n_rows * F.lit(test)).cast("bigint")
    return F.least(F.lit(int(test)).cast("bigint"), n_rows)


def split_fraction(df: DataFrame, test: float | int, seed: int | str, id_col: str,
                   col: str = "split") -> DataFrame:
    """Exact-size train/test split: the first ``n_test`` rows in md5 order
    are ``test``; the rest ``train``. Only the rows of the one bucket that
    straddles the cut are ranked (see ``offsets.first_n``)."""
    order = [shuffle_key(id_col, seed), F.col(id_col)]
    if isinstance(test, float) and test < 1.0:
        flagged = first_n(df, order, fraction=test, flag_col="_tm_in")
    else:
        flagged = first_n(df, order, n=int(test), flag_col="_tm_in")
    return flagged.withColumn(col, F.when(F.col("_tm_in"), F.lit("test")).otherwise(F.lit("train"))) \
        .drop("_tm_in")


# SPL-2 ---------------------------------------------------------------
def split_by_hash(df: DataFrame, test: float, seed: int | str, id_col: str,
                  col: str = "split") -> DataFrame:
    """Approximate-size split, stable under appends and in streams."""
    return df.withColumn(col, F.when(shuffle_key(id_col, seed) < F.lit(hash_cut(test)), "test")
                         .otherwise("train"))


# SPL-3 ---------------------------------------------------------------
def train_part(df: DataFrame, test_rows: DataFrame, id_col: str) -> DataFrame:
    """Complement of the test rows."""
    return df.join(test_rows.select(id_col), id_col, "left_anti")


# SET-1 ---------------------------------------------------------------
def concat(*dfs: DataFrame) -> DataFrame:
    """Concatenate tables by column name; duplicates kept."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
