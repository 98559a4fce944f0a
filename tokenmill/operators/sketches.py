"""Mergeable distinct sketches as columns, with set operations (AGG-14).

A state is a binary theta sketch of at most ``2^lg`` hashes (8 bytes each).
States are written as tables, one per run, merged later without the rows,
and intersected or subtracted. A count is exact while the values of all
sides together number at most ``2^lg``; beyond that its standard error is
about ``1 / sqrt(2^lg)`` of the union (0.4 % for ``lg`` 16). NULL is no value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG = 16


def sketch_states(df: DataFrame, keys: Sequence[str], sides: dict[str, tuple[Column | str, Column | None]],
                  lg: int = LG) -> DataFrame:
    """One state per group and side. ``sides`` maps a column name to (value,
    condition or None). Partial states combine before the shuffle, so a hot
    group sends one state a task."""
    aggs = []
    for name, (value, only) in sides.items():
        v = F.col(value) if isinstance(value, str) else value
        aggs.append(F.theta_sketch_agg(v if only is None else F.when(only, v), lg).alias(name))
    return df.groupBy(*keys).agg(*aggs)


def merge_states(states: DataFrame, keys: Sequence[str], sides: Sequence[str], lg: int = LG) -> DataFrame:
    """States of several runs (or of finer groups) as one per group of ``keys``."""
    return states.groupBy(*keys).agg(*[F.theta_union_agg(s, lg).alias(s) for s in sides])


def estimate(state: Column | str) -> Column:
    """Number of different values of a state."""
    return F.theta_sketch_estimate(state)


def overlap(states: DataFrame, a: str, b: str, lg: int = LG) -> DataFrame:
    """``states`` with the estimated sizes ``n_a``, ``n_b``, ``n_both``,
    ``n_either``, ``only_a`` and ``only_b`` of two states of the same row."""
    return (states
            .withColumn("n_a", estimate(a)).withColumn("n_b", estimate(b))
            .withColumn("n_both", estimate(F.theta_intersection(a, b)))
            .withColumn("n_either", estimate(F.theta_union(a, b, lg)))
            .withColumn("only_a", estimate(F.theta_difference(a, b)))
            .withColumn("only_b", estimate(F.theta_difference(b, a))))
