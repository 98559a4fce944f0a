"""Grouping sets and multiset operations against plain models; a third of the rows on one key."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from tokenmill.operators import cubes as C
from tokenmill.operators import multisets as M


def group_model(rows, sets):
    """{(gid, a, b): (rows, known x, sum, min, max, distinct x, distinct pairs)} of rows (a, b, x, y)."""
    out = {}
    for s in sets:
        gid = (0 if "a" in s else 2) + (0 if "b" in s else 1)
        groups = collections.defaultdict(list)
        if not s:
            groups[None, None] = []
        for a, b, x, y in rows:
            groups[a if "a" in s else None, b if "b" in s else None].append((x, y))
        for (a, b), g in groups.items():
            xs = [x for x, _ in g if x is not None]
            out[gid, a, b] = (len(g), len(xs), sum(xs) if xs else None, min(xs, default=None), max(xs, default=None),
                              len(set(xs)), len({(x, y) for x, y in g if x is not None and y is not None}))
    return out


def cube_rows(df, sets):
    out = C.grouping_sets(df, ["a", "b"], sets,
                          {"n": ("count", None), "known": ("count", "x"), "total": ("sum", "x"), "low": ("min", "x"), "high": ("max", "x")},
                          {"values": "x", "pairs": ["x", F.col("y")]})
    got = {(r["grouping_id"], r["a"], r["b"]): tuple(r)[3:] for r in out.collect()}
    assert len(got) == out.count()
    return got


@pytest.mark.parametrize("sets", [C.cube_sets(["a", "b"]), C.rollup_sets(["a", "b"]), [("b",), ()], [("a",), ("a",)], [("a", "b")]])
def test_sets_agree_with_a_plain_model(spark, sets):
    rng = random.Random(1)
    rows = [("hot" if i % 3 == 0 else rng.choice(["p", "q", None]), rng.choice([1, 2, None]), rng.choice([None, *range(40)]),
             rng.choice(["u", "", None])) for i in range(900)]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "a string, b int, x long, y string, _part string, _g int")
    assert cube_rows(df, sets) == group_model(rows, sets)
    assert cube_rows(df.limit(0), sets) == group_model([], sets)


def test_sets_without_measures_or_distinct_values(spark):
    df = spark.createDataFrame([("p", 1), ("p", 1), (None, 2)], "a string, b int")
    only = C.grouping_sets(df, ["a"], [("a",), ()], {}, {"n": "b"}).collect()
    assert {(r["grouping_id"], r["a"]): r["n"] for r in only} == {(0, "p"): 1, (0, None): 1, (1, None): 2}
    plain = C.grouping_sets(df, ["a"], [("a",), ()], {"n": ("sum", "b")}, {}).collect()
    assert {(r["grouping_id"], r["a"]): r["n"] for r in plain} == {(0, "p"): 2, (0, None): 2, (1, None): 4}
    with pytest.raises(ValueError):
        C.grouping_sets(df, ["a"], [("z",)], {}, {"n": "b"})


def test_values_of_a_hot_group_spread_and_counts_arrive_as_partial_ones(spark):
    """The grand total of 50,000 different values: no task of the aggregation that removes
    repeated values holds more than its share."""
    df = spark.range(50_000).select(F.lit("hot").alias("a"), F.col("id").alias("x"))
    out = C.grouping_sets(df, ["a"], C.cube_sets(["a"]), {"n": ("count", None)}, {"values": "x"})
    assert {r["values"] for r in out.collect()} == {50_000}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("hashpartitioning(_g") >= 2
    last = next(line for line in plan.splitlines() if "hashpartitioning(_g" in line)
    assert "_v0" not in last


ROW = "k string, v struct<a: int, b: array<double>>, m map<string,int>, t binary"


def nested(rng):
    return (rng.choice([None, "", "~", "1:a", "hot"]), rng.choice([None, (None, None), (1, []), (1, [0.0]), (1, [-0.0]),
            (1, [float("nan")]), (1, [None])]), rng.choice([None, {}, {"p": 1, "q": 2}, {"q": 2, "p": 1}, {"p": None}]),
            rng.choice([None, b"", b"\x00"]))


def canonical_key(r):
    def number(x):
        return "nan" if x is not None and x != x else x if x is None else x + 0.0
    k, v, m, t = r
    v = None if v is None else (v[0], None if v[1] is None else tuple(number(x) for x in v[1]))
    return (k, v, None if m is None else tuple(sorted(m.items())), None if t is None else bytes(t))


def test_multisets_agree_with_counters(spark):
    rng = random.Random(2)
    hot = ("hot", (1, [0.5]), {"p": 1}, b"x")
    left = [hot if i % 3 == 0 else nested(rng) for i in range(1200)]
    right = [hot if i % 4 == 0 else nested(rng) for i in range(700)]
    a, b = spark.createDataFrame(left, ROW), spark.createDataFrame(right, ROW).select("t", "m", "k", "v")
    x, y = (collections.Counter(map(canonical_key, rows)) for rows in (left, right))

    def got(df):
        assert df.columns == ["k", "v", "m", "t"]
        return collections.Counter(canonical_key(r) for r in df.collect())

    assert got(M.intersect_all(a, b)) == x & y
    assert got(M.except_all(a, b)) == x - y
    assert got(M.intersect_distinct(a, b)) == collections.Counter(x.keys() & y.keys())
    assert got(M.except_distinct(a, b)) == collections.Counter(x.keys() - y.keys())
    for one, other in ((a.limit(0), b), (a.limit(0), b.limit(0))):
        assert not got(M.intersect_all(one, other)) and not got(M.except_all(one, other))
    assert got(M.except_all(a, b.limit(0))) == x and not got(M.intersect_all(a, b.limit(0)))


def test_copies_of_one_row_are_made_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(M, "PIECE", 7)
    one = spark.range(100).select(F.lit(None).cast("string").alias("k"))
    for n in (0, 1, 93, 94, 99, 100):
        assert M.except_all(one, one.limit(n)).count() == 100 - n
        assert M.intersect_all(one, one.limit(n)).count() == n


def test_tables_must_agree_and_digests_are_checked(spark, monkeypatch):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "i int, s string")
    for other in (a.select("i"), a.withColumn("i", F.col("i").cast("long"))):
        with pytest.raises(ValueError):
            M.except_all(a, other)
    monkeypatch.setattr(F, "sha2", lambda c, n: F.lit("same"))
    with pytest.raises(Exception, match="share a digest"):
        M.except_all(a, a).collect()
