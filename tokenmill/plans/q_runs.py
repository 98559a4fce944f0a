"""Registered queries: run, cost and grid tables derived from the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenmill.operators import runs as U
from tokenmill.operators import tokens as T
from tokenmill.plans import tables
from tokenmill.plans.registry import query, r6

# Fixed parameters: option grid, block length, step time and price.
GRID = {"batch": [1, 2, 4, 8], "accumulation": [2, 4], "devices": [1, 4, 8]}
BLOCK = 1024
SECONDS_PER_SAMPLE = 0.25
PRICE_PER_DEVICE_HOUR = 0.8

RUNS_SQL = r"""r0 AS (SELECT 'unpacked' AS method, CAST(count(*) AS BIGINT) AS rows FROM documents
       UNION ALL SELECT 'packed', CAST(floor(sum(len(regexp_extract_all(text, '\S+'))) / 1024) AS BIGINT) FROM documents),
runs AS (SELECT method, rows, batch, accumulation, devices,
                CAST(floor(rows / (batch * accumulation * devices)) AS BIGINT) AS steps
         FROM r0, (SELECT unnest([1, 2, 4, 8]) AS batch), (SELECT unnest([2, 4]) AS accumulation),
              (SELECT unnest([1, 4, 8]) AS devices)),
timed AS (SELECT *, steps * batch * accumulation * 0.25 / 60.0 AS minutes, 0.8 * devices AS price_per_hour FROM runs)"""


def runs(spark, sf):
    d = tables.table(spark, sf, "documents").select(F.size(T.tokenize_col("text")).alias("n"))
    unpacked = d.agg(F.count(F.lit(1)).alias("rows")).withColumn("method", F.lit("unpacked"))
    packed = d.agg(F.floor(F.sum("n") / BLOCK).cast("bigint").alias("rows")).withColumn("method", F.lit("packed"))
    base = unpacked.unionByName(packed)
    g = U.param_grid(base, GRID)
    g = g.withColumn("steps", U.optimizer_steps("rows", "batch", "accumulation", "devices"))
    return g.withColumn("minutes", F.col("steps") * F.col("batch") * F.col("accumulation")
                        * F.lit(SECONDS_PER_SAMPLE) / 60.0) \
        .withColumn("price_per_hour", F.lit(PRICE_PER_DEVICE_HOUR) * F.col("devices"))


@query("jon4_param_grid", f"""
WITH {RUNS_SQL} SELECT method, CAST(batch AS INTEGER) AS batch, CAST(accumulation AS INTEGER) AS accumulation,
       CAST(devices AS INTEGER) AS devices FROM runs""")
def jon4(spark, sf):
    return runs(spark, sf).select("method", "batch", "accumulation", "devices")


@query("run1_optimizer_steps", f"""
WITH {RUNS_SQL} SELECT method, CAST(batch AS INTEGER) AS batch, CAST(accumulation AS INTEGER) AS accumulation,
       CAST(devices AS INTEGER) AS devices, rows, steps FROM runs""")
def run1(spark, sf):
    return runs(spark, sf).select("method", "batch", "accumulation", "devices", "rows", "steps")


@query("run2_run_cost", f"""
WITH {RUNS_SQL} SELECT method, CAST(batch AS INTEGER) AS batch, CAST(accumulation AS INTEGER) AS accumulation,
       CAST(devices AS INTEGER) AS devices, round(minutes, 6) AS minutes, round(minutes / 60.0 * price_per_hour, 6) AS cost
FROM timed""")
def run2(spark, sf):
    r = runs(spark, sf)
    return r.select("method", "batch", "accumulation", "devices", r6("minutes").alias("minutes"),
                    r6(U.run_cost("minutes", "price_per_hour")).alias("cost"))


@query("run4_throughput", f"""
WITH {RUNS_SQL} SELECT method, CAST(batch AS INTEGER) AS batch, CAST(accumulation AS INTEGER) AS accumulation,
       CAST(devices AS INTEGER) AS devices, round(rows * 3 / nullif(minutes * 60.0, 0), 6) AS samples_per_second
FROM timed""")
def run4(spark, sf):
    r = runs(spark, sf)
    return r.select("method", "batch", "accumulation", "devices",
                    r6(U.throughput("rows", 3, F.col("minutes") * 60.0)).alias("samples_per_second"))


CAL_GRID = {"bits": [4, 8], "group_size": [32, 128], "desc_act": [True, False], "damp": [0.01, 0.1]}


@query("cal5_grid_runs", r"""
WITH l AS (SELECT DISTINCT lang FROM documents),
g AS (SELECT lang, bits, group_size, desc_act, damp FROM l, (SELECT unnest([4, 8]) AS bits),
        (SELECT unnest([32, 128]) AS group_size), (SELECT unnest([true, false]) AS desc_act),
        (SELECT unnest([0.01, 0.1]) AS damp))
SELECT lang, CAST(bits AS INTEGER) AS bits, CAST(group_size AS INTEGER) AS group_size, desc_act,
       CAST(bits AS VARCHAR) || 'bits-' || CAST(group_size AS VARCHAR) || 'g-desc_act_'
       || CASE WHEN desc_act THEN 'True' ELSE 'False' END || '-damp_' || CAST(CAST(damp AS DOUBLE) AS VARCHAR) AS folder
FROM g""")
def cal5(spark, sf):
    langs = tables.table(spark, sf, "documents").select("lang").distinct()
    g = U.param_grid(langs, CAL_GRID)
    return g.select("lang", "bits", "group_size", "desc_act", U.grid_folder().alias("folder"))
