"""Driver tables and the record shapes derived from them.

Each derived shape has a Spark builder and the equivalent SQL text, so a
check can recompute it in another engine from the same Parquet files.
Every derived row comes from a driver row; the work grows with the data.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.sources import io

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Parameters of the derived fixtures (fixed, shared with the SQL text).
SEED = 42
QUERY_FRACTION = 0.1
DIMS = (64, 32, 16, 8)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a driver table for heavy work per row: at least as many partitions as cores."""
    return io.spread(table(spark, sf_dir, name).select(*columns), spark.sparkContext.defaultParallelism)


# --- candidates: several completions per prompt ------------------------
def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates_from(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


def candidates_from(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """prompt = order, candidate = line (ordered by line number); the truth
    is the order's price in thousands, a line's text states it off by
    -1/0/+1, says nothing, or is empty."""
    li = lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_tax",
        "l_extendedprice")
    o = orders.select("o_orderkey", "o_custkey", "o_totalprice")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    k = F.floor(F.col("o_totalprice") / 1000).cast("bigint")
    guess = (k + F.pmod(F.col("l_partkey"), F.lit(3)) - 1).cast("string")
    txt = (F.when(F.col("l_tax") == 0.0, F.lit(""))
           .when(F.col("l_discount") == 0.0, F.lit("I cannot tell."))
           .otherwise(F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"),
                               F.lit(" costs about "), guess, F.lit(" thousand."))))
    # lines of an order may repeat a line number: the index is the line
    # number, made unique by a 28-bit md5 of the line's other fields
    tb = F.conv(F.substring(F.md5(F.concat_ws(
        "-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"))), 1, 7), 16, 10)
    idx = F.col("l_linenumber").cast("bigint") * F.lit(1_000_000_000) + tb.cast("bigint")
    return j.select(
        F.col("o_orderkey").alias("prompt_id"),
        idx.alias("cand_idx"),
        F.concat(F.lit("What is the total price of order "), F.col("o_orderkey").cast("string"),
                 F.lit(" for customer "), F.col("o_custkey").cast("string"),
                 F.lit(", in thousands?")).alias("prompt"),
        txt.alias("text"),
        k.cast("string").alias("ground_truth"))


CANDIDATES_SQL = """
SELECT o_orderkey AS prompt_id,
       CAST(l_linenumber AS BIGINT) * 1000000000 + ('0x' || substr(md5(CAST(l_partkey AS VARCHAR) || '-'
         || CAST(l_suppkey AS VARCHAR) || '-' || CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR)), 1, 7))::BIGINT
         AS cand_idx,
       'What is the total price of order ' || CAST(o_orderkey AS VARCHAR) || ' for customer '
         || CAST(o_custkey AS VARCHAR) || ', in thousands?' AS prompt,
       CASE WHEN l_tax = 0.0 THEN ''
            WHEN l_discount = 0.0 THEN 'I cannot tell.'
            ELSE 'Order ' || CAST(o_orderkey AS VARCHAR) || ' costs about '
                 || CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) + (l_partkey % 3) - 1 AS VARCHAR)
                 || ' thousand.' END AS text,
       CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) AS ground_truth
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


# --- countdown tasks with one completion each ---------------------------
def countdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return countdown_from(spread_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey"))


def countdown_from(lineitem: DataFrame) -> DataFrame:
    """Countdown tasks from lineitem rows (batch or streaming frame)."""
    li = lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey")
    a = F.col("l_linenumber").cast("bigint")
    b = F.col("l_quantity").cast("bigint")
    t = a + b + F.when(F.pmod(F.col("l_partkey"), F.lit(4)) == 0, 1).otherwise(0)
    sa, sb, st = a.cast("string"), b.cast("string"), t.cast("string")
    v = F.pmod(F.col("l_suppkey"), F.lit(6))
    comp = (F.when(v == 0, F.concat(F.lit(" I add them.</think>\n<answer>"), sa, F.lit(" + "), sb,
                                    F.lit("</answer>")))
            .when(v == 1, F.concat(F.lit(" "), sb, F.lit(" minus "), sa, F.lit("</think>\n<answer>"),
                                   sb, F.lit(" - "), sa, F.lit("</answer>")))
            .when(v == 2, F.concat(F.lit(" try</think>\n<answer>("), sa, F.lit(" * "), sb,
                                   F.lit(") / 1</answer>")))
            .when(v == 3, F.concat(F.lit(" no tags <answer>"), sa, F.lit("+"), sb,
                                   F.lit("</answer>")))
            .when(v == 4, F.concat(F.lit(" x</think>\n<answer>"), sb, F.lit(" + "), sa, F.lit(" = "),
                                   st, F.lit("</answer>")))
            .otherwise(F.concat(F.lit(" <think> nested</think>\n<answer>"), sa, F.lit(" + "), sb,
                                F.lit("</answer>\n"))))
    return li.select(
        F.col("l_orderkey").alias("task_id"), F.col("l_linenumber").alias("gen_idx"),
        F.array(a, b).alias("nums"), t.alias("target"), comp.alias("completion"))


COUNTDOWN_SQL = """
SELECT l_orderkey AS task_id, l_linenumber AS gen_idx,
       [CAST(l_linenumber AS BIGINT), CAST(l_quantity AS BIGINT)] AS nums,
       CAST(l_linenumber AS BIGINT) + CAST(l_quantity AS BIGINT)
         + CASE WHEN l_partkey % 4 = 0 THEN 1 ELSE 0 END AS target,
       CASE l_suppkey % 6
         WHEN 0 THEN ' I add them.</think>\n<answer>' || CAST(l_linenumber AS VARCHAR) || ' + '
                     || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '</answer>'
         WHEN 1 THEN ' ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' minus '
                     || CAST(l_linenumber AS VARCHAR) || '</think>\n<answer>'
                     || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' - '
                     || CAST(l_linenumber AS VARCHAR) || '</answer>'
         WHEN 2 THEN ' try</think>\n<answer>(' || CAST(l_linenumber AS VARCHAR) || ' * '
                     || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ') / 1</answer>'
         WHEN 3 THEN ' no tags <answer>' || CAST(l_linenumber AS VARCHAR) || '+'
                     || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '</answer>'
         WHEN 4 THEN ' x</think>\n<answer>' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' + '
                     || CAST(l_linenumber AS VARCHAR) || ' = '
                     || CAST(CAST(l_linenumber AS BIGINT) + CAST(l_quantity AS BIGINT)
                        + CASE WHEN l_partkey % 4 = 0 THEN 1 ELSE 0 END AS VARCHAR) || '</answer>'
         ELSE ' <think> nested</think>\n<answer>' || CAST(l_linenumber AS VARCHAR) || ' + '
              || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '</answer>\n'
       END AS completion
FROM lineitem
"""


# --- load-test samples ----------------------------------------------------
def load_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_samples_from(table(spark, sf_dir, "events"))


def load_samples_from(ev: DataFrame) -> DataFrame:
    """One row per request: ``value`` is the latency (ms), ``error`` events
    failed, ``props.k`` the generated tokens; virtual users from user id."""
    tokens = F.get_json_object("props", "$.k").try_cast("bigint")
    return ev.select(
        "event_id", "ts",
        (1 + F.pmod(F.col("user_id"), F.lit(5))).cast("int").alias("vus"),
        F.when(F.col("event_type").isin("view", "click"), F.lit("fp16"))
        .otherwise(F.lit("fp8")).alias("variant"),
        F.col("value").alias("total_time"),
        tokens.alias("generated_tokens"),
        (F.col("event_type") == "error").alias("failed"))


LOAD_SQL = """
SELECT event_id, ts, CAST(1 + user_id % 5 AS INTEGER) AS vus,
       CASE WHEN event_type IN ('view', 'click') THEN 'fp16' ELSE 'fp8' END AS variant,
       value AS total_time,
       TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS generated_tokens,
       event_type = 'error' AS failed
FROM events
"""


# --- pairwise judgements --------------------------------------------------
def judgements(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.concat(F.lit("model_"), F.pmod(F.col("user_id"), F.lit(3)).cast("string")).alias("model_a"),
        F.lit("base").alias("model_b"),
        F.when(F.col("value") > 80, "win").when(F.col("value") < 20, "loss")
        .otherwise("tie").alias("outcome"))


JUDGEMENTS_SQL = """
SELECT event_id, 'model_' || CAST(user_id % 3 AS VARCHAR) AS model_a, 'base' AS model_b,
       CASE WHEN value > 80 THEN 'win' WHEN value < 20 THEN 'loss' ELSE 'tie' END AS outcome
FROM events
"""


def views_sql() -> str:
    """CTE prefix defining the derived shapes for oracle SQL."""
    return ("WITH candidates AS (" + CANDIDATES_SQL + "), countdown AS (" + COUNTDOWN_SQL +
            "), load_samples AS (" + LOAD_SQL + "), judgements AS (" + JUDGEMENTS_SQL + ")")
