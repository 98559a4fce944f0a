"""Exact money, billing by calendar month, maps merged per group (SCA-17).

Scale policy: an amount is a whole number of its smallest unit (``scale``
decimal places), carried as ``DECIMAL(38, 0)`` while it is multiplied, and
rounded once, half away from zero, where it becomes an amount again. Sums
of amounts are exact and do not depend on the order of rows. Doubles are
read by their shortest decimal text, so 0.1 is one tenth.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS = {"second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6}
WHOLE = "decimal(38,0)"
MERGES = {"sum": F.sum, "max": F.max, "min": F.min}


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def units(amount: Column | str, scale: int = 2) -> Column:
    """Amount (double, decimal or text) as a whole number of 10^-``scale``;
    NULL for NULL, text that is no number, and what 38 digits do not hold."""
    exact = _c(amount).cast("string").try_cast(f"decimal(38,{scale})")
    return (exact * F.lit(10**scale)).try_cast(WHOLE)


def amount(whole: Column | str, scale: int = 2) -> Column:
    """Whole units as ``DECIMAL(38, scale)``, without passing through a double."""
    text = F.abs(_c(whole).cast(WHOLE)).cast("string")
    if scale:
        padded = F.lpad(text, F.greatest(F.length(text), F.lit(scale + 1)), F.lit("0"))
        text = F.concat(F.substr(padded, F.lit(1), F.length(padded) - scale), F.lit("."), F.right(padded, F.lit(scale)))
    return F.concat(F.when(_c(whole) < 0, "-").otherwise(""), text).try_cast(f"decimal(38,{scale})")


def divide_half_up(whole: Column, by: int) -> Column:
    """``whole / by`` as a whole number, halves away from zero."""
    half = F.when(whole < 0, F.lit(-by)).otherwise(F.lit(by))
    twice = (whole * F.lit(2) + half).cast(WHOLE)
    rest = twice % F.lit(2 * by).cast(WHOLE)
    # the difference is a multiple, so the division has no remainder to round
    return ((twice - rest) / F.lit(2 * by)).cast(WHOLE)


def product(factors: Sequence[Column | str], scales: Sequence[int], scale: int = 2) -> Column:
    """Units of 10^-``scale`` of a product of numbers of the given scales, rounded once."""
    whole = units(factors[0], scales[0])
    for f, s in zip(factors[1:], scales[1:]):
        whole = (whole * units(f, s)).cast(WHOLE)
    extra = sum(scales) - scale
    return divide_half_up(whole, 10**extra) if extra > 0 else (whole * F.lit(10**-extra)).cast(WHOLE)


def month_bills(df: DataFrame, start: str, end: str, price: str, per: str = "hour", scale: int = 2,
                month: str = "month", used: str = "micros", bill: str = "units") -> DataFrame:
    """One row per interval and calendar month that it touches: the
    microseconds in that month and their price in units of 10^-``scale``.

    Months are those of the session's time zone. A month's bill is the
    rounded price up to the month's end less that up to its beginning, so
    the bills of an interval add up to its rounded price, whatever the
    number of months, and no window over the months is needed. Intervals
    that are empty, reversed or NULL, or have no price, have no bill."""
    s, e = F.col(start).cast("timestamp"), F.col(end).cast("timestamp")
    rows = df.where((s < e) & units(price, scale).isNotNull())
    first, last = F.date_trunc("month", s), F.date_trunc("month", e - F.expr("INTERVAL 1 MICROSECOND"))
    rows = rows.withColumn(month, F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))))
    begin = F.unix_micros(F.greatest(s, F.col(month))) - F.unix_micros(s)
    until = F.unix_micros(F.least(e, F.col(month) + F.expr("INTERVAL 1 MONTH"))) - F.unix_micros(s)

    def up_to(micros: Column) -> Column:
        return divide_half_up((units(price, scale) * micros.cast("decimal(19,0)")).cast(WHOLE), MICROS[per])

    return rows.withColumn(used, until - begin).withColumn(bill, up_to(until) - up_to(begin)) \
        .withColumn(month, F.to_date(month))


def merge_maps(df: DataFrame, keys: Sequence[str], maps: str, out: str | None = None, how: str = "sum") -> DataFrame:
    """One map per group: the entries of all its rows' maps, values of equal
    map keys merged by ``how`` (sum, max or min; NULL values are passed over,
    a key with no other value keeps NULL). Entries stand in key order.

    Entries are merged by (group, map key) with map-side combining first, so
    a group of a third of all rows spreads over its map keys, and what meets
    in one group is its result alone. A group of NULL and empty maps has an
    empty map; NULL is a group."""
    names = [f"`{k}`" for k in keys]
    entries = df.select(*[F.col(n).alias(f"_g{i}") for i, n in enumerate(names)], F.explode_outer(maps).alias("_k", "_v"))
    groups = [f"_g{i}" for i in range(len(names))]
    merged = entries.groupBy(*groups, "_k").agg(MERGES[how]("_v").alias("_v"))
    entry = F.when(F.col("_k").isNotNull(), F.struct("_k", "_v"))
    whole = merged.groupBy(*groups).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("_m"))
    return whole.select(*[F.col(g).alias(k) for g, k in zip(groups, keys)], F.col("_m").alias(out or maps))
