"""Registered queries: sources, sinks, projections, filters, formatting."""

from __future__ import annotations

import os
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.functions import chat, text
from tokenmill.operators import records as R
from tokenmill.operators import tokens as T
from tokenmill.operators.offsets import hash_cut, hash_key
from tokenmill.operators.sample import split_by_hash
from tokenmill.plans import tables
from tokenmill.plans.registry import msgs_text, query
from tokenmill.session import scratch_path
from tokenmill.sources import io

# Fixed parameters of the registered queries.
DEFAULT_SYSTEM = "You are a helpful assistant."
SUMMARY_START = "Summarize the following news article:\n"
SUMMARY_END = "\nSummary:\n"

# SQL building blocks -------------------------------------------------------
CONV = r"""conv AS (SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS m
                  FROM conversations GROUP BY conv_id)"""
MSGS = "array_to_string(list_transform({m}, lambda x: x.role || ':' || x.content), '|')"
CHATML = ("array_to_string(list_transform({m}, lambda x: '<|im_start|>' || x.role || chr(10) "
          "|| x.content || '<|im_end|>' || chr(10)), '')")
TENTH = hash_cut(0.1)
HSPLIT = "CASE WHEN ('0x' || substr(md5('{seed}-' || CAST({id} AS VARCHAR)), 1, 15))::BIGINT < {thr} THEN 'test' ELSE 'train' END"
ENSURE = ("CASE WHEN m[1].role = 'system' THEN m ELSE "
          "list_concat([{{'role': 'system', 'content': '{sys}'}}], m) END")


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint directory for each run, so no
    query ever overwrites files another query's plan has listed."""
    return scratch_path(spark, f"{name.rstrip('-')}-{uuid.uuid4().hex[:12]}")


def conv(spark: SparkSession, sf: str) -> DataFrame:
    return R.assemble_turns(tables.table(spark, sf, "conversations"))


# Flagship: chat token profile ---------------------------------------------
def chat_token_profile_df(turns: DataFrame, system_text: str = DEFAULT_SYSTEM) -> DataFrame:
    """conversations -> ensure system -> even turns -> ChatML -> whitespace
    tokens -> p95 length per number of messages."""
    counts = R.chatml_token_counts(turns, system_text)
    even = counts.where((F.col("n_messages") - 1) % 2 == 0)
    return even.groupBy("n_messages").agg(
        F.count(F.lit(1)).alias("n_conversations"),
        F.percentile("tokens", 0.95).cast("int").alias("p95_tokens"))


def chat_token_profile(spark: SparkSession, sf: str) -> DataFrame:
    return chat_token_profile_df(tables.table(spark, sf, "conversations"))


CHAT_PROFILE_SQL = rf"""
WITH {CONV},
s AS (SELECT conv_id, {ENSURE.format(sys=DEFAULT_SYSTEM)} AS m FROM conv),
e AS (SELECT * FROM s WHERE (len(m) - 1) % 2 = 0),
r AS (SELECT len(m) AS n_messages, {CHATML.format(m='m')} AS chat FROM e)
SELECT CAST(n_messages AS BIGINT) AS n_messages, CAST(count(*) AS BIGINT) AS n_conversations,
       CAST(trunc(quantile_cont(len(regexp_extract_all(chat, '\S+')), 0.95)) AS INTEGER) AS p95_tokens
FROM r GROUP BY n_messages
"""
query("chat_token_profile", CHAT_PROFILE_SQL)(chat_token_profile)


# SRC / SNK -----------------------------------------------------------------
@query("src1_read_table", "SELECT doc_id, lang, source, n_chars FROM documents")
def src1(spark, sf):
    return io.read_table(spark, "documents", root=sf).select("doc_id", "lang", "source", "n_chars")


def _prepared(spark, sf) -> str:
    """Write documents with a hash split once per folder (SNK-1)."""
    path = _scratch(spark, "prepared-")
    docs = split_by_hash(tables.table(spark, sf, "documents"), 0.1, 42, "doc_id")
    io.write_prepared(docs.select("doc_id", "lang", "n_chars", "split"), path)
    return path


@query("src2_read_splits", rf"""
SELECT {HSPLIT.format(seed=42, id='doc_id', thr=TENTH)} AS split,
       CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS total_chars
FROM documents GROUP BY 1""")
def src2(spark, sf):
    df = io.read_splits(spark, _prepared(spark, sf))
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_docs"),
                                   F.sum("n_chars").alias("total_chars"))


@query("src6_read_prepared", rf"""
SELECT doc_id, lang FROM documents
WHERE {HSPLIT.format(seed=42, id='doc_id', thr=TENTH)} = 'test'""")
def src6(spark, sf):
    return io.read_prepared(spark, _prepared(spark, sf), split="test").select("doc_id", "lang")


@query("snk1_write_prepared", rf"""
SELECT {HSPLIT.format(seed=42, id='doc_id', thr=TENTH)} AS split, CAST(count(*) AS BIGINT) AS n
FROM documents GROUP BY 1""")
def snk1(spark, sf):
    path = _prepared(spark, sf)
    return spark.read.parquet(path).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("snk3_publish_name", r"""
SELECT DISTINCT substr(replace('team/' || source || '/gen-' || lang, '/', '-'), 1, 40) || '-'
       || substr(replace('data/' || lang || '/docs', '/', '-'), 1, 40) || '-candidates' AS name
FROM documents""")
def snk3(spark, sf):
    d = tables.table(spark, sf, "documents")
    return d.select(io.publish_name(F.concat(F.lit("team/"), "source", F.lit("/gen-"), "lang"),
                                    F.concat(F.lit("data/"), "lang", F.lit("/docs")))
                    .alias("name")).distinct()


@query("snk4_sample_log", r"""
SELECT prompt_id, cand_idx FROM candidates
WHERE ('0x' || substr(md5('log-' || CAST(prompt_id AS VARCHAR) || '-' || CAST(cand_idx AS VARCHAR)), 1, 15))::BIGINT < 115292150460684704
""", views=True)
def snk4(spark, sf):
    c = tables.candidates(spark, sf)
    return io.sample_fraction(c, 0.1, "log", "prompt_id", "cand_idx").select("prompt_id", "cand_idx")


@query("snk5_run_metrics", rf"""
SELECT CAST(count(*) AS BIGINT) AS train_samples, 'docs-sft' AS run_name FROM documents
WHERE {HSPLIT.format(seed=42, id='doc_id', thr=TENTH)} = 'train'""")
def snk5(spark, sf):
    d = split_by_hash(tables.table(spark, sf, "documents"), 0.1, 42, "doc_id")
    return io.run_metrics(d.where(F.col("split") == "train"), run_name="docs-sft")


@query("snk2_write_jsonl", "SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(length(html)) AS BIGINT) AS chars FROM pages")
def snk2(spark, sf):
    """Round trip: pages -> escaped JSON lines -> read back with a schema."""
    path = _scratch(spark, "pages-jsonl-")
    io.write_jsonl(tables.table(spark, sf, "pages"), path, ascii=True)
    back = io.read_jsonl(spark, path, "page_id BIGINT, url STRING, html STRING")
    return back.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("html")).alias("chars"))


# PRJ -------------------------------------------------------------------------
@query("prj1_rename", "SELECT doc_id AS id, quality AS label, toxic FROM labels")
def prj1(spark, sf):
    return R.rename(tables.table(spark, sf, "labels"), {"doc_id": "id", "quality": "label"})


@query("prj2_keep", "SELECT doc_id, lang FROM documents")
def prj2(spark, sf):
    return R.keep(tables.table(spark, sf, "documents"), ["doc_id", "lang"])


@query("prj3_replace_columns", rf"""
SELECT doc_id AS id, '{SUMMARY_START.replace(chr(10), "' || chr(10) || '")}' || text
       || '{SUMMARY_END.replace(chr(10), "' || chr(10) || '")}' AS prompt FROM documents""")
def prj3(spark, sf):
    d = tables.table(spark, sf, "documents")
    return R.replace_columns(d, {"id": F.col("doc_id"),
                                 "prompt": R.summarize_prompt("text", SUMMARY_START, SUMMARY_END)})


@query("prj4_keep_except", f"WITH {CONV} SELECT {MSGS.format(m='m')} AS messages FROM conv")
def prj4(spark, sf):
    return R.keep_except(conv(spark, sf), "messages").select(msgs_text("messages").alias("messages"))


@query("prj5_with_row_id", """
SELECT doc_id, CAST(row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS BIGINT) AS row_id
FROM documents""")
def prj5(spark, sf):
    d = tables.table(spark, sf, "documents").select("doc_id", "n_chars")
    return R.with_row_id(d, ["n_chars", "doc_id"]).select("doc_id", "row_id")


@query("prj6_map_rows", r"""
SELECT doc_id, upper(lang) AS lang, CAST(len(regexp_extract_all(text, '\S+')) AS INTEGER) AS n_words
FROM documents""")
def prj6(spark, sf):
    d = tables.table(spark, sf, "documents")
    return R.map_rows(d, {"lang": F.upper("lang"), "n_words": F.size(T.tokenize_col("text"))}) \
        .select("doc_id", "lang", "n_words")


def _paragraphs(batches):
    for pdf in batches:
        parts = pdf.assign(para=pdf["text"].str.split("\n")).explode("para")
        parts["para_idx"] = parts.groupby(level=0).cumcount().astype("int64")
        yield pd.DataFrame({"doc_id": parts["doc_id"].astype("int64").values,
                            "para_idx": parts["para_idx"].values,
                            "para_chars": parts["para"].str.len().astype("int64").values})


@query("prj7_map_batches", r"""
SELECT doc_id, CAST(i - 1 AS BIGINT) AS para_idx, CAST(length(p) AS BIGINT) AS para_chars
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS p,
             unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)""")
def prj7(spark, sf):
    d = tables.table(spark, sf, "documents").select("doc_id", "text")
    return R.map_batches(d, _paragraphs, "doc_id BIGINT, para_idx BIGINT, para_chars BIGINT")


@query("prj8_describe", """
SELECT lang, CAST(count(*) AS BIGINT) AS num_rows,
       'doc_id:bigint, text:string, lang:string, source:string, n_chars:bigint' AS features
FROM documents GROUP BY lang""")
def prj8(spark, sf):
    return R.describe(tables.table(spark, sf, "documents"), by="lang")


@query("prj9_assign_batches", """
SELECT doc_id, CAST((row_number() OVER (ORDER BY substr(md5('42-' || CAST(doc_id AS VARCHAR)), 1, 15), doc_id) - 1) // 16 AS BIGINT) AS batch
FROM documents""")
def prj9(spark, sf):
    d = tables.table(spark, sf, "documents").select("doc_id")
    return R.assign_batches(d, 16, [hash_key("doc_id", seed="42"), "doc_id"]).select("doc_id", "batch")


# FLT -------------------------------------------------------------------------
@query("flt1_filter_even_turns", f"""
WITH {CONV} SELECT conv_id, CAST(len(m) AS INTEGER) AS n_messages FROM conv WHERE (len(m) - 1) % 2 = 0""")
def flt1(spark, sf):
    return R.filter_even_turns(conv(spark, sf)).select("conv_id", F.size("messages").alias("n_messages"))


@query("flt2_filter_max_tokens", r"""
SELECT prompt_id, cand_idx FROM candidates
WHERE len(regexp_extract_all(prompt, '\S+')) + len(regexp_extract_all(text, '\S+')) <= 16""", views=True)
def flt2(spark, sf):
    c = tables.candidates(spark, sf)
    c = c.withColumn("p_tok", T.tokenize_col("prompt")).withColumn("t_tok", T.tokenize_col("text"))
    return R.filter_max_tokens(c, ["p_tok", "t_tok"], 16).select("prompt_id", "cand_idx")


PREF_CHAT = rf"""{CONV},
pc AS (SELECT conv_id, m AS chosen,
              list_concat(m[1:len(m) - 1],
                          [{{'role': m[len(m)].role, 'content': m[len(m)].content || ' [rejected]'}}]) AS rej0
       FROM conv WHERE len(m) >= 2),
pref AS (SELECT conv_id, chosen,
                CASE WHEN conv_id % 4 = 0
                     THEN list_concat([{{'role': rej0[1].role, 'content': rej0[1].content || ' (edited)'}}], rej0[2:len(rej0)])
                     ELSE rej0 END AS rejected FROM pc)"""


def preference_chat(spark, sf) -> DataFrame:
    """Two versions of the last turn; every 4th conversation also differs
    in its first turn (so FLT-4 has something to drop)."""
    c = conv(spark, sf).where(F.size("messages") >= 2)
    last = F.element_at("messages", -1)
    rej0 = F.concat(text.all_but_last("messages"),
                    F.array(chat.message(last["role"], F.concat(last["content"], F.lit(" [rejected]")))))
    first = F.element_at(rej0, 1)
    rej = F.when(F.pmod(F.col("conv_id"), F.lit(4)) == 0,
                 F.concat(F.array(chat.message(first["role"], F.concat(first["content"],
                                                                       F.lit(" (edited)")))),
                          F.slice(rej0, 2, F.size(rej0) - 1))).otherwise(rej0)
    return c.select("conv_id", F.col("messages").alias("chosen"), rej.alias("rejected"))


@query("flt4_filter_last_turn_differs", f"""
WITH {PREF_CHAT} SELECT conv_id FROM pref
WHERE chosen[1:len(chosen) - 1] = rejected[1:len(rejected) - 1]""")
def flt4(spark, sf):
    return R.filter_last_turn_differs(preference_chat(spark, sf)).select("conv_id")


@query("flt5_filter_min_tokens", r"""
SELECT doc_id FROM documents WHERE len(regexp_extract_all(text, '\S+')) >= 200""")
def flt5(spark, sf):
    d = tables.table(spark, sf, "documents").withColumn("tok", T.tokenize_col("text"))
    return R.filter_min_tokens(d, "tok", 200).select("doc_id")


@query("flt6_match_any_pattern", r"""
SELECT doc_id FROM documents
WHERE EXISTS (SELECT 1 FROM region WHERE regexp_matches(source, '^(?:src' || CAST(r_regionkey AS VARCHAR) || ')'))""")
def flt6(spark, sf):
    pats = tables.table(spark, sf, "region").select(
        F.concat(F.lit("src"), F.col("r_regionkey").cast("string")).alias("entry"))
    d = tables.table(spark, sf, "documents").select("doc_id", "source")
    return R.match_any_pattern(d, pats, "source").select("doc_id")


@query("flt7_has_role", f"WITH {CONV} SELECT conv_id FROM conv WHERE m[1].role = 'system'")
def flt7(spark, sf):
    return conv(spark, sf).where(R.has_role("messages", 0, "system")).select("conv_id")


# FMT -------------------------------------------------------------------------
FMT1_SQL = r"""
SELECT prompt_id, cand_idx,
       'system:You answer questions about order ' || CAST(prompt_id AS VARCHAR) || '.|user:' || prompt
       || '|assistant:' || text AS messages
FROM candidates"""


@query("fmt1_to_messages", FMT1_SQL, views=True)
def fmt1(spark, sf):
    c = tables.candidates(spark, sf)
    sys_t = R.template("You answer questions about order {pid}.", pid="prompt_id")
    return R.to_messages(c, sys_t, "prompt", "text").select(
        "prompt_id", "cand_idx", msgs_text("messages").alias("messages"))


@query("fmt2_to_multimodal_messages", r"""
SELECT p_partkey, 'user' AS user_role, CAST(octet_length(encode(p_name)) AS INTEGER) AS image_bytes,
       p_type AS description FROM part""")
def fmt2(spark, sf):
    p = tables.table(spark, sf, "part")
    m = R.to_multimodal_messages(p, "You are an expert product description writer.",
                                 R.product_prompt("p_name", "p_brand"),
                                 F.encode("p_name", "UTF-8"), "p_type")
    user = F.element_at("messages", 2)
    return m.select("p_partkey", user["role"].alias("user_role"),
                    F.length(F.element_at(user["content"], 2)["image"]).alias("image_bytes"),
                    F.element_at(F.element_at("messages", 3)["content"], 1)["text"].alias("description"))


@query("fmt3_ensure_system", f"""
WITH {CONV} SELECT conv_id, {MSGS.format(m=ENSURE.format(sys=DEFAULT_SYSTEM))} AS messages FROM conv""")
def fmt3(spark, sf):
    return conv(spark, sf).select("conv_id", msgs_text(
        R.ensure_system("messages", F.lit(DEFAULT_SYSTEM))).alias("messages"))


@query("fmt4_assemble_turns", f"""
WITH {CONV} SELECT conv_id, CAST(len(m) AS INTEGER) AS n_messages, {MSGS.format(m='m')} AS messages FROM conv""")
def fmt4(spark, sf):
    return conv(spark, sf).select("conv_id", F.size("messages").alias("n_messages"),
                                  msgs_text("messages").alias("messages"))


@query("fmt5_chatml", f"WITH {CONV} SELECT conv_id, {CHATML.format(m='m')} AS chat FROM conv")
def fmt5(spark, sf):
    return conv(spark, sf).select("conv_id", chat.chatml("messages").alias("chat"))


@query("fmt6_human_assistant", r"""
WITH """ + CONV + r"""
SELECT conv_id, array_to_string(list_transform(m, lambda x: CASE
          WHEN x.role = 'system' THEN x.content
          WHEN x.role = 'user' THEN chr(10) || chr(10) || 'Human: ' || x.content || '<eos>'
          WHEN x.role = 'assistant' THEN chr(10) || chr(10) || 'Assistant: ' || x.content || '<eos>'
          ELSE '' END), '') || chr(10) || chr(10) || 'Assistant: ' AS chat FROM conv""")
def fmt6(spark, sf):
    return conv(spark, sf).select(
        "conv_id", chat.human_assistant("messages", add_generation_prompt=True).alias("chat"))


@query("fmt7_llama3_header", r"""
WITH """ + CONV + r"""
SELECT conv_id, '<|begin_of_text|>' || array_to_string(list_transform(m, lambda x:
          '<|start_header_id|>' || x.role || '<|end_header_id|>' || chr(10) || chr(10)
          || regexp_replace(x.content, '^\s+|\s+$', '', 'g') || '<|eot_id|>'), '') AS chat FROM conv""")
def fmt7(spark, sf):
    return conv(spark, sf).select("conv_id", chat.llama3_header("messages").alias("chat"))


@query("fmt8_gemma_chatml", f"""
WITH {CONV} SELECT conv_id, '<bos>' || {CHATML.format(m='m')} || chr(10) || '<eos>' AS chat FROM conv""")
def fmt8(spark, sf):
    return conv(spark, sf).select("conv_id", chat.gemma_chatml("messages").alias("chat"))


@query("fmt9_llama2_inst", rf"""
WITH {CONV}
SELECT conv_id, '[INST] <<SYS>>' || chr(10)
       || coalesce(list_filter(m, lambda x: x.role = 'system')[1].content, '{DEFAULT_SYSTEM}')
       || chr(10) || '<</SYS>>' || chr(10) || chr(10)
       || list_filter(m, lambda x: x.role = 'user')[1].content || ' [/INST]' AS prompt
FROM conv WHERE len(list_filter(m, lambda x: x.role = 'user')) > 0""")
def fmt9(spark, sf):
    c = conv(spark, sf)
    sys_c = F.coalesce(F.try_element_at(F.filter("messages", lambda x: x["role"] == "system"),
                                        F.lit(1))["content"], F.lit(DEFAULT_SYSTEM))
    users = F.filter("messages", lambda x: x["role"] == "user")
    return c.where(F.size(users) > 0).select(
        "conv_id", chat.llama2_inst(sys_c, F.try_element_at(users, F.lit(1))["content"]).alias("prompt"))


@query("fmt10_starchat", r"""
WITH """ + CONV + r"""
SELECT conv_id, array_to_string(list_transform(m, lambda x: '<|' || x.role || '|>' || chr(10)
       || x.content || '<|end|>' || chr(10)), '') || '<|assistant|>' AS chat FROM conv""")
def fmt10(spark, sf):
    return conv(spark, sf).select("conv_id", chat.starchat("messages").alias("chat"))


@query("fmt10_idefics", r"""
SELECT page_id, 'User:<fake_token_around_image>![](' || url || ')<fake_token_around_image>'
       || 'What is on page ' || CAST(page_id AS VARCHAR) || '?<end_of_utterance>' || chr(10) AS prompt
FROM pages""")
def fmt10b(spark, sf):
    p = tables.table(spark, sf, "pages")
    q = F.concat(F.lit("What is on page "), F.col("page_id").cast("string"), F.lit("?"))
    return p.select("page_id", chat.idefics(q, F.col("url")).alias("prompt"))


@query("fmt11_generation_prompt", f"""
WITH {CONV} SELECT conv_id, {CHATML.format(m='m[1:2]')} || '<|im_start|>assistant' || chr(10) AS prompt
FROM conv""")
def fmt11(spark, sf):
    return conv(spark, sf).select("conv_id", chat.chatml(R.context_turns("messages", 2),
                                                         add_generation_prompt=True).alias("prompt"))


@query("fmt12_continue_final", f"""
WITH {CONV} SELECT conv_id,
  {CHATML.format(m='m[1:len(m) - 1]')} || '<|im_start|>' || m[len(m)].role || chr(10) || m[len(m)].content AS prompt
FROM conv""")
def fmt12(spark, sf):
    return conv(spark, sf).select("conv_id", chat.chatml("messages", continue_final=True).alias("prompt"))


def _r1_sql(user_text: str = R.R1_USER) -> str:
    def lit(s):
        return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    user = user_text.split("{nums}")
    u2 = user[1].split("{target}")
    user_sql = (lit(user[0]) + " || '[' || array_to_string(list_transform(nums, lambda x: CAST(x AS VARCHAR)), ', ') || ']' || "
                + lit(u2[0]) + " || CAST(target AS VARCHAR) || " + lit(u2[1]))
    return (f"SELECT task_id, gen_idx, '<|im_start|>system' || chr(10) || {lit(R.R1_SYSTEM)} || '<|im_end|>' || chr(10)"
            f" || '<|im_start|>user' || chr(10) || {user_sql} || '<|im_end|>' || chr(10)"
            f" || '<|im_start|>assistant' || chr(10) || {lit(R.R1_PREFILL)} AS prompt FROM countdown")


@query("fmt13_r1_prompt", _r1_sql(), views=True)
def fmt13(spark, sf):
    c = tables.countdown(spark, sf)
    return c.select("task_id", "gen_idx", R.r1_prompt("nums", "target").alias("prompt"))


@query("fmt13_r1_prompt_notebook", _r1_sql(R.R1_USER_NOTEBOOK), views=True)
def fmt13b(spark, sf):
    c = tables.countdown(spark, sf)
    return c.select("task_id", "gen_idx", R.r1_prompt("nums", "target", wording="notebook").alias("prompt"))


STYLE_SQL = {
    "chatml": CHATML.format(m="m"),
    "gemma_chatml": "'<bos>' || " + CHATML.format(m="m") + " || chr(10) || '<eos>'",
    "starchat": "array_to_string(list_transform(m, lambda x: '<|' || x.role || '|>' || chr(10) || x.content || '<|end|>' || chr(10)), '') || '<|assistant|>'",
    "llama2_inst": "'[INST] <<SYS>>' || chr(10) || coalesce(list_filter(m, lambda x: x.role = 'system')[1].content, '') || chr(10) || '<</SYS>>' || chr(10) || chr(10) || coalesce(list_filter(m, lambda x: x.role = 'user')[1].content, '') || ' [/INST]'",
}


@query("udf4_render_styles", f"WITH {CONV} " + " UNION ALL ".join(
    f"SELECT conv_id, '{k}' AS style, {v} AS prompt FROM conv" for k, v in STYLE_SQL.items()))
def udf4(spark, sf):
    """The formatting registry by name."""
    c = conv(spark, sf)
    parts = [c.select("conv_id", F.lit(k).alias("style"), chat.render("messages", k).alias("prompt")) for k in STYLE_SQL]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


INSTR = ("SELECT doc_id, 'Summarize document ' || CAST(doc_id AS VARCHAR) AS instruction, "
         "CASE WHEN lang = 'en' THEN source ELSE '' END AS context, text AS response FROM documents")


def instr_records(spark, sf) -> DataFrame:
    d = tables.spread_table(spark, sf, "documents", "doc_id", "lang", "source", "text")
    return d.select("doc_id",
                    F.concat(F.lit("Summarize document "), F.col("doc_id").cast("string")).alias("instruction"),
                    F.when(F.col("lang") == "en", F.col("source")).otherwise(F.lit("")).alias("context"),
                    F.col("text").alias("response"))


@query("fmt14_instruction_block", rf"""
WITH i AS ({INSTR})
SELECT doc_id, '### Instruction:' || chr(10) || 'Use the Input below to create an instruction, which could have been used to generate the input using an LLM. '
       || chr(10) || chr(10) || '### Input:' || chr(10) || response || chr(10) || chr(10) || '### Response:' || chr(10)
       || instruction || chr(10) AS text FROM i""")
def fmt14(spark, sf):
    i = instr_records(spark, sf)
    return i.select("doc_id", R.instruction_block("instruction", "response").alias("text"))


FMT15_EXPR = ("'### Instruction' || chr(10) || instruction || CASE WHEN length(context) > 0 THEN "
              "chr(10) || chr(10) || '### Context' || chr(10) || context ELSE '' END || chr(10) || chr(10) "
              "|| '### Answer' || chr(10) || response")


@query("fmt15_instruction_context_answer", f"WITH i AS ({INSTR}) SELECT doc_id, {FMT15_EXPR} AS text FROM i")
def fmt15(spark, sf):
    i = instr_records(spark, sf)
    return i.select("doc_id", R.instruction_context_answer("instruction", "context", "response").alias("text"))


@query("fmt16_append_eos", f"WITH i AS ({INSTR}) SELECT doc_id, {FMT15_EXPR} || '<eos>' AS text FROM i")
def fmt16(spark, sf):
    i = instr_records(spark, sf)
    return i.select("doc_id", R.append_eos(R.instruction_context_answer(
        "instruction", "context", "response")).alias("text"))


@query("fmt17_summarize_prompt", "SELECT doc_id, 'summarize: ' || text AS prompt FROM documents")
def fmt17(spark, sf):
    return tables.table(spark, sf, "documents").select("doc_id", R.summarize_prompt("text").alias("prompt"))


def _prod_sql():
    t = R.PRODUCT_PROMPT.replace("'", "''").replace("\n", "' || chr(10) || '")
    t = t.replace("{product_name}", "' || p_name || '").replace("{category}", "' || p_type || '")
    return f"SELECT p_partkey, '{t}' AS prompt FROM part"


@query("fmt18_product_prompt", _prod_sql())
def fmt18(spark, sf):
    p = tables.table(spark, sf, "part")
    return p.select("p_partkey", R.product_prompt("p_name", "p_type").alias("prompt"))


@query("fmt19_system_user_prompt", r"""
SELECT o_orderkey, '<|im_start|>system' || chr(10) || 'Answer with a number.<|im_end|>' || chr(10)
       || '<|im_start|>user' || chr(10) || 'Total of order ' || CAST(o_orderkey AS VARCHAR) || '?<|im_end|>' || chr(10)
       || '<|im_start|>assistant' || chr(10) AS prompt,
       'system:Answer with a number.|user:Total of order ' || CAST(o_orderkey AS VARCHAR) || '?' AS messages
FROM orders""")
def fmt19(spark, sf):
    o = tables.table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("Total of order "), F.col("o_orderkey").cast("string"),
                               F.lit("?")).alias("question"))
    out = R.system_user_prompt(o, "Answer with a number.", "question")
    return out.select("o_orderkey", "prompt", msgs_text("messages").alias("messages"))


def _sql_chatml_one(expr: str) -> str:
    return f"'<|im_start|>' || ({expr}).role || chr(10) || ({expr}).content || '<|im_end|>' || chr(10)"


@query("fmt20_preference_triplets", rf"""
WITH {PREF_CHAT},
t AS (SELECT conv_id,
        CASE WHEN chosen[1].role = 'system' THEN chosen[1:len(chosen) - 1]
             ELSE list_concat([{{'role': 'system', 'content': '{DEFAULT_SYSTEM}'}}], chosen[1:len(chosen) - 1]) END AS p,
        list_filter(chosen, lambda x: x.role = 'assistant') AS ca,
        list_filter(rejected, lambda x: x.role = 'assistant') AS ra FROM pref)
SELECT {CHATML.format(m='p')} AS prompt,
       CASE WHEN len(ca) > 0 THEN {_sql_chatml_one('ca[len(ca)]')} END AS chosen,
       CASE WHEN len(ra) > 0 THEN {_sql_chatml_one('ra[len(ra)]')} END AS rejected
FROM t""")
def fmt20(spark, sf):
    return R.preference_triplets(preference_chat(spark, sf), DEFAULT_SYSTEM)


@query("fmt22_strip_prompt", r"""
SELECT prompt_id, cand_idx, regexp_replace(text, '^\s+|\s+$', '', 'g') AS answer FROM candidates""", views=True)
def fmt22(spark, sf):
    c = tables.candidates(spark, sf)
    gen = F.concat("prompt", F.lit("  "), "text", F.lit("\n"))
    return c.select("prompt_id", "cand_idx", R.strip_prompt(gen, "prompt").alias("answer"))


@query("fmt23_context_turns", f"WITH {CONV} SELECT conv_id, {MSGS.format(m='m[1:2]')} AS question FROM conv")
def fmt23(spark, sf):
    return conv(spark, sf).select("conv_id", msgs_text(R.context_turns("messages", 2)).alias("question"))


@query("fmt24_pair_records", r"""
SELECT 'Which text comes from ' || source || ' in ' || lang || '?' AS anchor, text AS positive
FROM documents WHERE text IS NOT NULL""")
def fmt24(spark, sf):
    d = tables.table(spark, sf, "documents").withColumn(
        "q", F.concat(F.lit("Which text comes from "), "source", F.lit(" in "), "lang", F.lit("?")))
    return R.pair_records(d, "pair", "q", "text")


# SRC-3/4/5/8 round trips over files written from the driver tables ---------------
PAGES_SCHEMA = "page_id BIGINT, url STRING, html STRING"


@query("src3_read_jsonl", "SELECT page_id, url, CAST(length(html) AS INTEGER) AS html_chars FROM pages")
def src3(spark, sf):
    path = _scratch(spark, "pages-jsonl-")
    io.write_jsonl(tables.table(spark, sf, "pages"), path, ascii=True)
    back = io.read_jsonl(spark, path, PAGES_SCHEMA)
    return back.select("page_id", "url", F.length("html").alias("html_chars"))


@query("src4_resolve_source", """
SELECT 'json' AS kind, CAST(count(*) AS BIGINT) AS n FROM pages
UNION ALL SELECT 'table', CAST(count(*) AS BIGINT) FROM documents""")
def src4(spark, sf):
    path = _scratch(spark, "pages-json-") + ".json"
    tables.table(spark, sf, "pages").write.mode("overwrite").json(path)
    a = io.resolve_source(spark, path, schema=PAGES_SCHEMA).agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("kind", F.lit("json"))
    b = io.resolve_source(spark, "documents", root=sf).agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("kind", F.lit("table"))
    return a.unionByName(b).select("kind", "n")


@query("src5_read_gzip_shards", "SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(length(html)) AS BIGINT) AS chars FROM pages")
def src5(spark, sf):
    path = _scratch(spark, "pages-gz-")
    io.write_jsonl(tables.table(spark, sf, "pages"), path, compression="gzip")
    back = io.read_jsonl(spark, os.path.join(path, "part-*.json.gz"), PAGES_SCHEMA, min_partitions=8)
    return back.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("html")).alias("chars"))


@query("src8_read_list_file", r"""
SELECT doc_id FROM documents
WHERE EXISTS (SELECT 1 FROM region WHERE regexp_matches(source, '^(?:src' || CAST(r_regionkey AS VARCHAR) || ')'))""")
def src8(spark, sf):
    """A list file (comment + ``- pattern`` lines) written from ``region``,
    read back and used as layer-style name patterns."""
    path = _scratch(spark, "patterns-")
    lines = tables.table(spark, sf, "region").select(
        F.concat(F.lit("- src"), F.col("r_regionkey").cast("string")).alias("value"))
    header = spark.range(1).select(F.lit("# source patterns").alias("value"))
    header.unionByName(lines).coalesce(1).write.mode("overwrite").text(path)
    pats = io.read_list_file(spark, path)
    d = tables.table(spark, sf, "documents").select("doc_id", "source")
    return R.match_any_pattern(d, pats, "source").select("doc_id")


@query("src7_read_images", """
SELECT CAST(count(*) AS BIGINT) AS n_files, CAST(sum(octet_length(encode(html)) + 1) AS BIGINT) AS n_bytes FROM pages""")
def src7(spark, sf):
    """Binary files written from ``pages`` (one file per page) read back
    with the ``binaryFile`` source: count and total bytes."""
    path = _scratch(spark, "pages-files-")
    rows = tables.table(spark, sf, "pages").groupBy("page_id").agg(
        F.array_join(F.collect_list(F.coalesce("html", F.lit(""))), "\n").alias("value"))
    io.write_files(rows.select("value"), path)
    files = io.read_images(spark, path, "*.txt").where("length > 0")  # a first task without rows leaves an empty file
    return files.agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
