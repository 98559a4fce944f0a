"""Registered queries: grouping sets with exact distinct counts, multiset operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenmill.operators import cubes as C
from tokenmill.operators import multisets as M
from tokenmill.plans import tables
from tokenmill.plans.registry import arr_text, query, r6


@query("agg14_corpus_cube", """
SELECT lang, source, CAST(grouping(lang, source) AS BIGINT) AS grouping_id, count(*) AS n_docs,
  CAST(sum(n_chars) AS BIGINT) AS n_chars, max(n_chars) AS longest, count(DISTINCT text) AS n_texts
FROM documents GROUP BY CUBE (lang, source)""")
def agg14(spark, sf):
    """Documents, characters and different texts for every language, source, and both."""
    d = tables.table(spark, sf, "documents")
    return C.grouping_sets(d, ["lang", "source"], C.cube_sets(["lang", "source"]),
                           {"n_docs": ("count", None), "n_chars": ("sum", "n_chars"), "longest": ("max", "n_chars")},
                           {"n_texts": F.sha2("text", 256)})


@query("agg14_line_rollup", """
SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag, l_linestatus) AS BIGINT) AS grouping_id, count(*) AS n_lines,
  round(sum(l_quantity), 6) AS quantity, min(l_shipdate) AS first_day, count(DISTINCT l_orderkey) AS n_orders,
  count(DISTINCT l_partkey) AS n_parts, count(DISTINCT (l_partkey, l_suppkey)) AS n_offers
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def agg14b(spark, sf):
    """Three exact distinct counts over few hot groups."""
    x = tables.table(spark, sf, "lineitem")
    keys = ["l_returnflag", "l_linestatus"]
    out = C.grouping_sets(x, keys, C.rollup_sets(keys),
                          {"n_lines": ("count", None), "quantity": ("sum", "l_quantity"), "first_day": ("min", "l_shipdate")},
                          {"n_orders": "l_orderkey", "n_parts": "l_partkey", "n_offers": ["l_partkey", "l_suppkey"]})
    return out.withColumn("quantity", r6("quantity"))


@query("agg14_event_sets", """
SELECT event_type, day, CAST(grouping(event_type, day) AS BIGINT) AS grouping_id, count(*) AS n_events, count(DISTINCT user_id) AS n_users
FROM (SELECT event_type, CAST(ts AS DATE) AS day, user_id FROM events) GROUP BY GROUPING SETS ((event_type, day), (day), ())""")
def agg14c(spark, sf):
    """Events and users by type and day, by day, and in all."""
    e = tables.table(spark, sf, "events").select("event_type", F.to_date("ts").alias("day"), "user_id")
    return C.grouping_sets(e, ["event_type", "day"], [("event_type", "day"), ("day",), ()],
                           {"n_events": ("count", None)}, {"n_users": "user_id"})


USER_DAYS = "SELECT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = '{}'"


def user_days(spark, sf, kind):
    return tables.table(spark, sf, "events").where(F.col("event_type") == kind).select("user_id", F.to_date("ts").alias("day"))


@query("set2_days_in_common", f"{USER_DAYS.format('click')} INTERSECT ALL {USER_DAYS.format('purchase')}")
def set2(spark, sf):
    """A user's days, as often as the user has both a click and a purchase on them."""
    return M.intersect_all(user_days(spark, sf, "click"), user_days(spark, sf, "purchase"))


@query("set2_days_left", f"{USER_DAYS.format('click')} EXCEPT ALL {USER_DAYS.format('purchase')}")
def set2b(spark, sf):
    """Clicks that no purchase of the same user and day makes up for."""
    return M.except_all(user_days(spark, sf, "click"), user_days(spark, sf, "purchase"))


def _lines(lang: str) -> str:
    return ("SELECT string_split(line, ' ') AS words FROM (SELECT unnest(string_split(text, chr(10))) AS line "
            f"FROM documents WHERE lang {lang}) WHERE line <> ''")


@query("set2_lines_elsewhere", f"""
SELECT array_to_string(words, ',') AS words FROM ({_lines("= 'en'")} INTERSECT ({_lines("<> 'en'")}))""")
def set2c(spark, sf):
    """Lines, as lists of words, that English documents share with others."""
    d = tables.table(spark, sf, "documents")
    lines = d.select("lang", F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    words = lines.select("lang", F.split("line", " ").alias("words"))
    return M.intersect_distinct(words.where("lang = 'en'").select("words"), words.where("lang <> 'en'").select("words")).select(
        arr_text("words").alias("words"))


@query("set2_lines_of_one_side", f"""
SELECT array_to_string(words, ',') AS words FROM ({_lines("= 'en'")} EXCEPT ({_lines("<> 'en'")}))""")
def set2d(spark, sf):
    """Lines, as lists of words, that only English documents hold."""
    d = tables.table(spark, sf, "documents")
    lines = d.select("lang", F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    words = lines.select("lang", F.split("line", " ").alias("words"))
    return M.except_distinct(words.where("lang = 'en'").select("words"), words.where("lang <> 'en'").select("words")).select(
        arr_text("words").alias("words"))
