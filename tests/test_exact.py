"""Exact amounts, monthly bills, merged maps and distinct sketches against
plain models; a third of the rows on one key."""

import collections
import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from pyspark.sql import functions as F

from tokenmill.functions import exact as X
from tokenmill.operators import sketches as K


def half_up(x: Fraction) -> int:
    whole = int(abs(x) + Fraction(1, 2))
    return -whole if x < 0 else whole


def test_units_and_amounts_read_back(spark):
    values = [0.1, 0.29, 1e-3, 12345678.91, -0.05, -3.0, 0.0, None, float("nan"), float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select("v", X.units("v").alias("u"), X.amount(X.units("v")).cast("string").alias("a")).collect()
    for r in got:
        if r.v is None or r.v != r.v or r.v == float("inf"):
            assert r.u is None and r.a is None
        else:
            want = Decimal(repr(r.v)).quantize(Decimal("0.01"), ROUND_HALF_UP)
            assert r.u == int(want * 100) and Decimal(r.a) == want
    text = spark.createDataFrame([("12.345",), ("x",), ("9" * 60,)], "v string").select(X.units("v", 3).alias("u")).collect()
    assert [r.u for r in text] == [Decimal(12345), None, None]


def test_products_are_rounded_once(spark):
    rng = random.Random(3)
    rows = [(Decimal(rng.randrange(-10**9, 10**9)) / 100, Decimal(rng.randrange(0, 101)) / 100) for _ in range(500)]
    rows += [(Decimal("0.01"), Decimal("0.50")), (Decimal("-0.01"), Decimal("0.50")), (Decimal("0.03"), Decimal("0.50"))]
    df = spark.createDataFrame(rows, "a decimal(18,2), b decimal(4,2)")
    for r in df.withColumn("u", X.product(["a", "b"], [2, 2])).withColumn("w", X.product(["a", "b"], [2, 2], 6)).collect():
        exact = Fraction(r.a) * Fraction(r.b)
        assert r.u == half_up(exact * 100) and r.w == exact * 10**6


def month_model(rows):
    out = {}
    for i, s, e, price in rows:
        if s is None or e is None or price is None or not s < e:
            continue
        month = dt.datetime(s.year, s.month, 1)
        rate = Fraction(Decimal(repr(price))) * 100 / 3_600_000_000
        micros = lambda t: (t - s) // dt.timedelta(microseconds=1)
        while month < e:
            after = dt.datetime(month.year + month.month // 12, month.month % 12 + 1, 1)
            b, u = micros(max(s, month)), micros(min(e, after))
            out[i, month.date()] = (u - b, half_up(rate * u) - half_up(rate * b))
            month = after
    return out


def test_month_bills_add_up_to_the_whole_price(spark):
    rng = random.Random(5)
    t0 = dt.datetime(2023, 11, 1)
    rows = []
    for i in range(300):
        s = t0 + dt.timedelta(microseconds=rng.randrange(10**13)) if i % 3 else dt.datetime(2024, 1, 31, 23, 59, 59, 999999)
        e = s + dt.timedelta(microseconds=rng.choice([1, 10**6, 10**12, 3 * 10**13, 0, -5]))
        rows.append((i, s, e, rng.choice([0.0, 0.35, 2.99, 1234.56, -0.5])))
    rows += [(300, t0, dt.datetime(2024, 2, 1), 0.01), (301, t0, None, 1.0), (302, None, t0, 1.0), (303, t0, dt.datetime(2024, 1, 1), None)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "i int, s timestamp_ntz, e timestamp_ntz, p double, x string")
    got = X.month_bills(df, "s", "e", "p")
    assert "x" in got.columns
    assert {(r.i, r.month): (r.micros, int(r.units)) for r in got.collect()} == month_model(rows)
    total = collections.Counter()
    for (i, _), (_, cents) in month_model(rows).items():
        total[i] += cents
    for i, s, e, price in rows:
        if i in total:
            assert total[i] == half_up(Fraction(Decimal(repr(price))) * 100 * ((e - s) // dt.timedelta(microseconds=1)) / 3_600_000_000)
    assert X.month_bills(df.limit(0), "s", "e", "p").count() == 0


def test_maps_merge_with_a_hot_group(spark):
    rng = random.Random(7)
    rows = []
    for i in range(600):
        m = {rng.choice("abcdefgh"): rng.choice([None, rng.randrange(-50, 50)]) for _ in range(rng.randrange(4))}
        rows.append(("hot" if i % 3 == 0 else rng.choice(["p", "q", None]), rng.choice([None, m])))
    rows += [("empty", {}), ("empty", None), ("nothing", {"z": None})]
    df = spark.createDataFrame(rows, "g string, m map<string,int>")
    for how, fold in (("sum", sum), ("max", max), ("min", min)):
        want: dict = collections.defaultdict(lambda: collections.defaultdict(list))
        for g, m in rows:
            want[g]
            for k, v in (m or {}).items():
                want[g][k] += [] if v is None else [v]
        got = X.merge_maps(df, ["g"], "m", how=how).collect()
        assert {r.g: r.m for r in got} == {g: {k: fold(v) if v else None for k, v in m.items()} for g, m in want.items()}
        assert all(list(r.m) == sorted(r.m) for r in got) and len(got) == len(want)
    assert X.merge_maps(df.limit(0), ["g"], "m").count() == 0


def test_sketches_merge_over_runs_and_count_exactly_below_their_size(spark):
    rng = random.Random(9)
    rows = [("hot" if i % 3 == 0 else rng.choice(["p", None]), rng.randrange(3), rng.choice([None, f"v{rng.randrange(700)}"]), rng.random() < 0.3)
            for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, run int, v string, held boolean")
    sides = {"a": ("v", ~F.col("held")), "b": ("v", F.col("held"))}
    runs = K.sketch_states(df, ["g", "run"], sides, 12)
    got = K.overlap(K.merge_states(runs, ["g"], ["a", "b"], 12), "a", "b", 12).collect()
    sets = collections.defaultdict(lambda: (set(), set()))
    for g, _, v, held in rows:
        sets[g][held] if v is None else sets[g][held].add(v)
    assert {r.g: (r.n_a, r.n_b, r.n_both, r.n_either, r.only_a, r.only_b) for r in got} == {
        g: (len(a), len(b), len(a & b), len(a | b), len(a - b), len(b - a)) for g, (a, b) in sets.items()}
    empty = K.overlap(K.sketch_states(df.where("v is null"), ["g"], sides, 12), "a", "b", 12).collect()
    assert empty and all((r.n_a, r.n_either, r.only_b) == (0, 0, 0) for r in empty)


def test_sketch_error_beyond_its_size_is_near_the_stated_one(spark):
    """200,000 and 100,000 values (50,000 shared) in states of 4096 hashes: 1.6 % standard error."""
    df = spark.range(250_000).withColumn("run", F.col("id") % 5)
    sides = {"a": ("id", F.col("id") < 200_000), "b": ("id", F.col("id") >= 150_000)}
    states = K.merge_states(K.sketch_states(df, ["run"], sides, 12), [], ["a", "b"], 12)
    r = K.overlap(states, "a", "b", 12).first()
    bound = 4 * 250_000 / 4096**0.5
    for got, want in zip((r.n_a, r.n_b, r.n_both, r.n_either, r.only_a, r.only_b), (200_000, 100_000, 50_000, 250_000, 150_000, 50_000)):
        assert abs(got - want) < bound
    assert abs(r.n_either - 250_000) / 250_000 < 0.065
