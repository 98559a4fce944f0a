"""Run, cost and grid tables (RUN-1/2/4, JON-4, CAL-4/5).

Option grids are tiny and fixed; they are attached to data-derived rows
with chained ``explode`` of literal arrays (nested-loop order, no join).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# JON-4 ---------------------------------------------------------------
def param_grid(df: DataFrame, options: dict[str, Sequence]) -> DataFrame:
    """Every row of ``df`` times the cross product of the option lists, in
    nested-loop order (first option outermost)."""
    out = df
    for name, values in options.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out


# RUN-1 ---------------------------------------------------------------
def optimizer_steps(rows: Column | str, batch: Column | str, accumulation: Column | str,
                    devices: Column | str) -> Column:
    """``floor(rows / (batch * accumulation * devices))``."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.floor(c(rows) / (c(batch) * c(accumulation) * c(devices))).cast("bigint")


# RUN-2 ---------------------------------------------------------------
def run_cost(minutes: Column | str, price_per_hour: Column | str) -> Column:
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return c(minutes) / 60.0 * c(price_per_hour)


# RUN-4 ---------------------------------------------------------------
def throughput(rows: Column | str, per_row: Column | str | int, seconds: Column | str) -> Column:
    """Rows × items per row / seconds (samples per second)."""
    c = lambda x: F.lit(x) if isinstance(x, int) else (F.col(x) if isinstance(x, str) else x)
    return c(rows) * c(per_row) / F.nullif(c(seconds).cast("double"), F.lit(0.0))


# CAL-5 ---------------------------------------------------------------
def grid_folder(bits: str = "bits", group_size: str = "group_size", desc_act: str = "desc_act",
                damp: str = "damp") -> Column:
    """Output folder per combination: ``{bits}bits-{g}g-desc_act_{True|False}-damp_{damp}``."""
    act = F.when(F.col(desc_act), F.lit("True")).otherwise(F.lit("False"))
    return F.concat(F.col(bits).cast("string"), F.lit("bits-"), F.col(group_size).cast("string"),
                    F.lit("g-desc_act_"), act, F.lit("-damp_"), F.col(damp).cast("string"))


# CAL-4 ---------------------------------------------------------------
def source_dispatch(name: str, builders: dict[str, Callable], aliases: dict[str, str]) -> Callable:
    """Dataset name (or alias) -> builder; unknown names raise."""
    key = aliases.get(name, name)
    if key not in builders:
        raise ValueError(f"Unsupported dataset: {name}")
    return builders[key]
