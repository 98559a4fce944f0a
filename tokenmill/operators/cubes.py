"""Grouping sets, cubes and rollups with exact distinct counts (AGG-14).

Rows are reduced before they are expanded. One aggregation by all keys
keeps the additive states. The distinct values, as rows (keys, measure,
value), are dealt by value to as many tasks as their number asks for and
reduced, first with a value in up to ``SALTS`` tasks, then in one; only what
is left is copied into the grouping sets. An aggregation by (set, keys,
measure, value) in the same task removes values that meet again in a coarser
set, and a last one counts them. The values spread a hot group (the grand
total above all) over all tasks, and what reaches its last aggregation are
partial counts, one row a task. So no task holds the values of a group, no
group's size matters, and a task's share is the same whatever the table's size.

``grouping_id`` is SQL's: one bit a key, the first key highest, set where
the key is rolled up; it tells a rolled-up key from a null one. A null is
not a distinct value (nor is a row with a null in a distinct list of
several columns). The empty set gives one row also for an empty table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Sets = list[tuple[str, ...]]

TASK_VALUES = 500_000  # rows (keys, measure, value) of a task
SALTS = 8  # tasks that a value's rows are dealt to at first

# how partial states of an additive measure merge
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def cube_sets(keys: Sequence[str]) -> Sets:
    """All subsets of ``keys``."""
    return [c for n in range(len(keys), -1, -1) for c in combinations(keys, n)]


def rollup_sets(keys: Sequence[str]) -> Sets:
    """The prefixes of ``keys``."""
    return [tuple(keys[:n]) for n in range(len(keys), -1, -1)]


def _state(kind: str, col: Column | None) -> Column:
    if kind == "count":
        return F.lit(1).cast("long") if col is None else col.isNotNull().cast("long")
    return col


def value_tasks(df: DataFrame, measures: int) -> int:
    """Tasks for the distinct values of ``df``: no more than the session's
    partitions while a tenth of ``TASK_VALUES`` is a task's share."""
    n = df.count() * measures
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    return max(1, min(parts, -(-10 * n // TASK_VALUES)), -(-n // TASK_VALUES))


def grouping_sets(df: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]],
                  measures: Mapping[str, tuple[str, str | Column | None]],
                  distinct: Mapping[str, str | Column | Sequence[str | Column]]) -> DataFrame:
    """One row for each group of each of ``sets``: ``keys`` (null where rolled up),
    ``grouping_id``, ``measures`` and the exact numbers of ``distinct`` values.

    ``measures`` maps a name to (count | sum | min | max, column); ``count``
    of no column counts rows. ``distinct`` maps a name to a column, or to
    several that count together. A set given twice counts once."""
    def col(c):
        return F.col(c) if isinstance(c, str) else c

    def value(cs):
        cs = [col(c) for c in (cs if isinstance(cs, Sequence) and not isinstance(cs, str) else [cs])]
        if len(cs) == 1:
            return cs[0]
        known = cs[0].isNotNull()
        for c in cs[1:]:
            known = known & c.isNotNull()
        return F.when(known, F.struct(*[c.alias(f"v{i}") for i, c in enumerate(cs)]))

    names, counted = list(measures), list(distinct)
    k = [f"_k{i}" for i in range(len(keys))]
    m = [f"_m{i}" for i in range(len(names))]
    v = [f"_v{i}" for i in range(len(counted))]
    merge = [_MERGE[measures[n][0]] for n in names]
    plain = df.select(*[F.col(c).alias(a) for c, a in zip(keys, k, strict=True)],
                      *[_state(kind, None if c is None else col(c)).alias(a)
                        for (kind, c), a in zip(measures.values(), m, strict=True)],
                      *[value(c).alias(a) for c, a in zip(distinct.values(), v, strict=True)])

    kinds = {f.name: f.dataType for f in plain.schema.fields}

    def merged(by, frame):
        return frame.groupBy(*by).agg(*([f(a).alias(a) for f, a in zip(merge, m, strict=True)] or [F.lit(1).alias("_one")]))

    def part(i: int) -> Column:
        return F.struct(F.lit(i).alias("_part"),
                        *[(F.col(a) if i == j else F.lit(None).cast(kinds[a])).alias(a) for j, a in enumerate(v)])

    wanted = {}
    for s in sets:
        if unknown := set(s) - set(keys):
            raise ValueError(f"not among the keys: {sorted(unknown)}")
        wanted[sum(1 << (len(keys) - 1 - i) for i, c in enumerate(keys) if c not in s)] = set(s)
    copies = F.explode(F.array(*[F.struct(F.lit(g).cast("long").alias("_g"), *[
        (F.col(a) if c in s else F.lit(None).cast(kinds[a])).alias(a) for c, a in zip(keys, k, strict=True)])
        for g, s in wanted.items()]))

    def spread(frame, *rest):
        return frame.select(copies.alias("_c"), *rest).select("_c.*", *rest)

    # the additive states (part -1), and a row for each distinct value that is known
    once = merged(["_g", *k], spread(merged(k, plain), *m)).select("_g", *k, F.lit(-1).alias("_part"), *m)
    if v:
        parts = [F.when(F.col(a).isNotNull(), part(i)) for i, a in enumerate(v)]
        rows = plain.select(*k, F.explode(F.filter(F.array(*parts), lambda p: p.isNotNull())).alias("_p")).select(
            *k, "_p.*", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).alias("_salt"))
        n = value_tasks(df, len(v))
        # dealt before they are reduced, so no task reduces more than its share
        some = rows.repartition(n, "_part", *v, "_salt").groupBy(*k, "_part", *v, "_salt").agg(F.lit(1).alias("_one"))
        finest = some.repartition(n, "_part", *v).groupBy(*k, "_part", *v).agg(F.lit(1).alias("_one"))
        values = spread(finest, "_part", *v).groupBy("_g", *k, "_part", *v).agg(F.lit(1).alias("_one"))
        once = once.unionByName(values.select("_g", *k, "_part", *[
            F.lit(None).cast(once.schema[a].dataType).alias(a) for a in m]))
    total = (1 << len(keys)) - 1
    if total in wanted:  # the empty set has a row of its own, whatever the table holds
        ground = df.sparkSession.range(1).select(F.lit(total).cast("long").alias("_g"), *[F.lit(None).cast(kinds[a]).alias(a) for a in k],
                                                 F.lit(-1).alias("_part"),
                                                 *[F.lit(0 if measures[n][0] == "count" else None).cast(once.schema[a].dataType).alias(a)
                                                   for n, a in zip(names, m, strict=True)])
        once = once.unionByName(ground)
    out = once.groupBy("_g", *k).agg(*[f(a).alias(a) for f, a in zip(merge, m, strict=True)],
                                     *[F.count_if(F.col("_part") == i).alias(a) for i, a in enumerate(v)])
    return out.select(*[F.col(a).alias(c) for c, a in zip(keys, k, strict=True)], F.col("_g").alias("grouping_id"),
                      *[F.col(a).alias(n) for n, a in zip(names, m, strict=True)],
                      *[F.col(a).alias(n) for n, a in zip(counted, v, strict=True)])
