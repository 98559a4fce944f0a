"""Registered queries: ordering, sampling, splitting, concatenation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenmill.operators import sample as S
from tokenmill.operators.offsets import with_positions
from tokenmill.plans import tables
from tokenmill.plans.registry import query
from tokenmill.session import materialize

HORD = "substr(md5('{seed}-' || CAST({id} AS VARCHAR)), 1, 15), {id}"


@query("ord1_shuffle", f"""
SELECT doc_id, CAST(row_number() OVER (ORDER BY {HORD.format(seed=42, id='doc_id')}) - 1 AS BIGINT) AS pos
FROM documents""")
def ord1(spark, sf):
    d = tables.table(spark, sf, "documents").select("doc_id")
    # the order in which the sorted rows come out, as written
    shuffled = materialize(S.shuffle(d, 42, "doc_id").withColumn("_at", F.monotonically_increasing_id()))
    return with_positions(shuffled, ["_at"], pos_col="pos").drop("_at")


@query("ord2_head", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 700")
def ord2(spark, sf):
    return S.head(tables.table(spark, sf, "documents").select("doc_id", "lang"), 700, ["doc_id"])


@query("ord3_sample_n", f"""
SELECT o_orderkey, o_custkey FROM orders ORDER BY {HORD.format(seed=42, id='o_orderkey')} LIMIT 1000""")
def ord3(spark, sf):
    o = tables.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return S.sample_n(o, 1000, 42, "o_orderkey")


@query("ord3_sample_n_large", f"""
SELECT l_orderkey, l_linenumber FROM (SELECT *, l_orderkey * 8 + l_linenumber AS k FROM lineitem)
ORDER BY {HORD.format(seed=7, id='k')} LIMIT 12500""")
def ord3b(spark, sf):
    """Large n: ranks rows with bucketed positions instead of a top-n heap."""
    li = tables.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"))
    return S.sample_n(li, 12500, 7, "k", method="rank").select("l_orderkey", "l_linenumber")


@query("ord2_head_strings_large", """
SELECT CAST(row_number() OVER (ORDER BY text, conv_id, turn) - 1 AS BIGINT) AS pos, conv_id, turn FROM conversations
ORDER BY text, conv_id, turn LIMIT 300""")
def ord2b(spark, sf):
    """A string key and the ranked form; the order of the result counts."""
    c = tables.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    top = S.head(c, 300, ["text", "conv_id", "turn"], method="rank")
    top = materialize(top.withColumn("_at", F.monotonically_increasing_id()))
    return with_positions(top, ["_at"], pos_col="pos").select("pos", "conv_id", "turn")


@query("ord4_random_rows", f"""
SELECT doc_id, source FROM documents ORDER BY {HORD.format(seed=3, id='doc_id')} LIMIT 2""")
def ord4(spark, sf):
    return S.random_rows(tables.table(spark, sf, "documents").select("doc_id", "source"), 2, 3, "doc_id")


@query("ord5_row_at", """
SELECT doc_id, CAST(17 AS BIGINT) AS row_id FROM documents ORDER BY doc_id LIMIT 1 OFFSET 17""")
def ord5(spark, sf):
    return S.row_at(tables.table(spark, sf, "documents").select("doc_id"), 17, ["doc_id"])


@query("ord6_keep_latest", """
SELECT event_id, user_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 2""")
def ord6(spark, sf):
    e = tables.table(spark, sf, "events").select("event_id", "user_id", "ts")
    return S.keep_latest(e, 2, "user_id", "ts", tie=("event_id",)).select("event_id", "user_id")


SPLIT_SQL = """
SELECT {id}, CASE WHEN row_number() OVER (ORDER BY {hord}) - 1 < {n_test}
                  THEN 'test' ELSE 'train' END AS split FROM {table}"""


@query("spl1_split_fraction", SPLIT_SQL.format(
    id="doc_id", hord=HORD.format(seed=42, id="doc_id"),
    n_test="CAST(ceil(0.1 * count(*) OVER ()) AS BIGINT)", table="documents"))
def spl1(spark, sf):
    d = tables.table(spark, sf, "documents").select("doc_id")
    return S.split_fraction(d, 0.1, 42, "doc_id")


@query("spl1_split_count", SPLIT_SQL.format(
    id="o_orderkey", hord=HORD.format(seed=42, id="o_orderkey"),
    n_test="least(1500, count(*) OVER ())", table="orders"))
def spl1b(spark, sf):
    o = tables.table(spark, sf, "orders").select("o_orderkey")
    return S.split_fraction(o, 1500, 42, "o_orderkey")


@query("spl2_split_by_hash", """
SELECT doc_id, CASE WHEN ('0x' || substr(md5('7-' || CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT < 115292150460684704
                    THEN 'test' ELSE 'train' END AS split FROM documents""")
def spl2(spark, sf):
    d = tables.table(spark, sf, "documents").select("doc_id")
    return S.split_by_hash(d, 0.1, 7, "doc_id")


@query("spl3_train_part", f"""
SELECT doc_id FROM documents
QUALIFY row_number() OVER (ORDER BY {HORD.format(seed=42, id='doc_id')}) - 1 >= CAST(ceil(0.1 * count(*) OVER ()) AS BIGINT)""")
def spl3(spark, sf):
    d = tables.table(spark, sf, "documents").select("doc_id")
    test = S.split_fraction(d, 0.1, 42, "doc_id").where(F.col("split") == "test")
    return S.train_part(d, test, "doc_id")


@query("set1_concat", """
SELECT doc_id AS id, text, 'documents' AS origin FROM documents
UNION ALL SELECT item_id AS id, text, 'benchmark' AS origin FROM benchmark""")
def set1(spark, sf):
    d = tables.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text",
                                                     F.lit("documents").alias("origin"))
    b = tables.table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text",
                                                     F.lit("benchmark").alias("origin"))
    return S.concat(d, b)


@query("win4_running_offset", r"""
SELECT doc_id, CAST(coalesce(sum(len(regexp_extract_all(text, '\S+'))) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS token_offset
FROM documents""")
def win4(spark, sf):
    from tokenmill.operators.offsets import running_offset
    from tokenmill.operators.tokens import tokenize_col
    d = tables.table(spark, sf, "documents").select("doc_id", F.size(tokenize_col("text")).alias("n"))
    return running_offset(d, ["doc_id"], "n", col="token_offset").select("doc_id", "token_offset")
