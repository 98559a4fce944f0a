"""Registered queries: scalar functions (SCA-*), vocabulary lookup
(JON-8) and the user-function surface (UDF-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenmill.functions import text as X
from tokenmill.operators import metrics as M
from tokenmill.operators import records as R
from tokenmill.operators import rewards as W
from tokenmill.operators import tokens as T
from tokenmill.plans import tables
from tokenmill.plans.q_records import CONV, conv
from tokenmill.plans.q_tokens import VOCAB, docs_tokens
from tokenmill.plans.registry import query, r6

NL = "chr(10)"


@query("sca1_strip", r"SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS stripped FROM documents")
def sca1(spark, sf):
    return tables.table(spark, sf, "documents").select("doc_id", X.strip("text").alias("stripped"))


@query("sca2_split_part_if", f"""
SELECT doc_id, CASE WHEN len(string_split(text, {NL})) >= 3 THEN string_split(text, {NL})[3] ELSE text END AS part
FROM documents""")
def sca2(spark, sf):
    d = tables.table(spark, sf, "documents")
    return d.select("doc_id", X.split_part_if("text", "\n", 2).alias("part"))


@query("sca3_find_all_last", r"""
SELECT prompt_id, cand_idx, array_to_string(regexp_extract_all(text, '\d+'), ',') AS numbers,
       regexp_extract_all(text, '\d+')[-1] AS last_number FROM candidates""", views=True)
def sca3(spark, sf):
    c = tables.candidates(spark, sf)
    return c.select("prompt_id", "cand_idx", F.array_join(X.find_all("text", r"\d+"), ",").alias("numbers"),
                    X.last_match("text", r"\d+").alias("last_number"))


@query("sca4_search_group", r"""
SELECT task_id, gen_idx, CASE WHEN regexp_matches(completion, '<answer>(.*?)</answer>')
                              THEN regexp_extract(completion, '<answer>(.*?)</answer>', 1) END AS answer
FROM countdown""", views=True)
def sca4(spark, sf):
    c = tables.countdown(spark, sf)
    return c.select("task_id", "gen_idx", X.search_group("completion", r"<answer>(.*?)</answer>").alias("answer"))


@query("sca5_regex_match", r"""
SELECT p_partkey, regexp_matches(p_type, '^(?:STANDARD|SMALL)') AS prefix_ok,
       regexp_full_match(p_name, '[a-z]+ [a-z]+') AS full_ok FROM part""")
def sca5(spark, sf):
    p = tables.table(spark, sf, "part")
    return p.select("p_partkey", X.prefix_match("p_type", "STANDARD|SMALL").alias("prefix_ok"),
                    X.full_match("p_name", "[a-z]+ [a-z]+").alias("full_ok"))


@query("sca6_replace_prefix_segment", """
SELECT page_id, replace(url, '/', '-') AS flat, substr(url, 1, 20) AS head,
       string_split(url, '/')[-1] AS segment FROM pages""")
def sca6(spark, sf):
    p = tables.table(spark, sf, "pages")
    return p.select("page_id", X.replace_text("url", "/", "-").alias("flat"), X.prefix("url", 20).alias("head"),
                    X.last_path_segment("url").alias("segment"))


@query("sca7_prefix_suffix", """
SELECT page_id, starts_with(url, 'https') AS secure, ends_with(url, '#top') AS anchored FROM pages""")
def sca7(spark, sf):
    p = tables.table(spark, sf, "pages")
    return p.select("page_id", X.starts_with("url", "https").alias("secure"),
                    X.ends_with("url", "#top").alias("anchored"))


@query("sca8_empty_to", f"""
SELECT prompt_id, cand_idx, CASE WHEN text = '' THEN ' ' || {NL} ELSE text END AS text FROM candidates""", views=True)
def sca8(spark, sf):
    c = tables.candidates(spark, sf)
    return c.select("prompt_id", "cand_idx", X.empty_to("text", " \n").alias("text"))


@query("sca9_row_concat", f"""
SELECT prompt_id, cand_idx, prompt || ': ' || text || {NL} AS piece FROM candidates""", views=True)
def sca9(spark, sf):
    c = tables.candidates(spark, sf)
    return c.select("prompt_id", "cand_idx", T.calibration_pieces(c, "pair_colon", "prompt", "text").alias("piece"))


@query("sca10_array_ops", f"""
WITH {CONV}, r AS (SELECT conv_id, list_transform(m, lambda x: x.role) AS roles FROM conv)
SELECT conv_id, CAST(len(roles) AS INTEGER) AS n, roles[-1] AS last_role,
       array_to_string(roles[1:len(roles) - 1], ',') AS head_roles,
       array_to_string(list_concat(['system'], roles), ',') AS prepended,
       array_to_string(flatten([roles, roles]), ',') AS doubled,
       array_to_string(list_sort(roles), ',') AS sorted_roles,
       list_sort(roles) = list_sort(list_reverse(roles)) AS same_multiset FROM r""")
def sca10(spark, sf):
    c = conv(spark, sf).select("conv_id", F.transform("messages", lambda m: m["role"]).alias("roles"))
    return c.select("conv_id", F.size("roles").alias("n"), X.last_element("roles").alias("last_role"),
                    F.array_join(X.all_but_last("roles"), ",").alias("head_roles"),
                    F.array_join(F.concat(F.array(F.lit("system")), "roles"), ",").alias("prepended"),
                    F.array_join(F.flatten(F.array("roles", "roles")), ",").alias("doubled"),
                    F.array_join(F.array_sort("roles"), ",").alias("sorted_roles"),
                    X.same_multiset("roles", F.reverse("roles")).alias("same_multiset"))


@query("sca11_last_where", f"""
WITH {CONV} SELECT conv_id, list_filter(m, lambda x: x.role = 'assistant')[-1].content AS last_answer FROM conv""")
def sca11(spark, sf):
    c = conv(spark, sf)
    return c.select("conv_id", X.last_where("messages", lambda x: x["role"] == "assistant")["content"]
                    .alias("last_answer"))


@query("sca12_cast_abs_tolerance", r"""
SELECT task_id, gen_idx, TRY_CAST(regexp_extract(completion, '(\d+)', 1) AS BIGINT) AS first_int,
       abs(target - TRY_CAST(regexp_extract(completion, '(\d+)', 1) AS BIGINT)) AS gap,
       abs(target - TRY_CAST(regexp_extract(completion, '(\d+)', 1) AS BIGINT)) < 1e-5 AS close
FROM countdown""", views=True)
def sca12(spark, sf):
    c = tables.countdown(spark, sf)
    first = X.to_int(F.regexp_extract("completion", r"(\d+)", 1))
    return c.select("task_id", "gen_idx", first.alias("first_int"),
                    F.abs(F.col("target") - first).alias("gap"),
                    X.close_to("target", first).alias("close"))


@query("sca13_argmax", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax FROM embeddings""")
def sca13(spark, sf):
    e = tables.table(spark, sf, "embeddings")
    return e.select("vec_id", X.argmax("embedding").alias("argmax"))


@query("sca14_round_up_to", r"""
SELECT doc_id, CAST(((len(regexp_extract_all(text, '\S+')) + 7) // 8) * 8 AS BIGINT) AS padded_len FROM documents""")
def sca14(spark, sf):
    d = docs_tokens(spark, sf)
    return d.select("doc_id", X.round_up_to(F.size("tokens"), 8).alias("padded_len"))


@query("sca15_json_field", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events""")
def sca15(spark, sf):
    e = tables.table(spark, sf, "events")
    return e.select("event_id", X.json_number("props", "$.k").alias("k"))


@query("sca16_cosine_truncate", """
SELECT vec_id, round(list_dot_product(CAST(embedding[1:32] AS DOUBLE[]), CAST(embedding[33:64] AS DOUBLE[]))
       / (sqrt(list_dot_product(CAST(embedding[1:32] AS DOUBLE[]), CAST(embedding[1:32] AS DOUBLE[])))
          * sqrt(list_dot_product(CAST(embedding[33:64] AS DOUBLE[]), CAST(embedding[33:64] AS DOUBLE[])))), 6) AS cosine
FROM embeddings""")
def sca16(spark, sf):
    e = tables.table(spark, sf, "embeddings")
    return e.select("vec_id", r6(X.cosine(X.truncate_vector("embedding", 32),
                                          F.slice("embedding", 33, 32))).alias("cosine"))


@query("sca18_parse_timings", """
SELECT event_id, value * 1000 * 0.001 AS validation_ms, value AS queue_ms FROM events""")
def sca18(spark, sf):
    """Log lines built from the events (latency in µs and ms), parsed back."""
    e = tables.table(spark, sf, "events")
    line = F.concat(F.lit('chat_completions{validation_time="'), (F.col("value") * 1000).cast("string"),
                    F.lit('µs" queue_time="'), F.col("value").cast("string"), F.lit('ms"}'))
    m = X.parse_timings(line)
    return e.select("event_id", m["validation_time"].alias("validation_ms"), m["queue_time"].alias("queue_ms"))


@query("jon8_vocab_lookup", f"""
WITH {VOCAB} SELECT doc_id, CAST(pos AS INTEGER) AS pos, token, CAST(coalesce(v.id, 2) AS INTEGER) AS id
FROM ex LEFT JOIN vocab v USING (token)""")
def jon8(spark, sf):
    d = docs_tokens(spark, sf)
    vocab = T.build_vocab(d, "tokens", 2000)
    return T.vocab_lookup(d, "doc_id", "tokens", vocab).select("doc_id", "pos", "token", "id")


# UDF surface ------------------------------------------------------------------------
def length_reward(completions):
    """A user-supplied reward (plain Python over a pandas Series)."""
    return (completions.str.len() / 100.0).clip(upper=1.0)


@query("udf5_user_reward", """
SELECT task_id, gen_idx, least(length(completion) / 100.0, 1.0) AS length_reward FROM countdown""", views=True)
def udf5(spark, sf):
    c = tables.countdown(spark, sf)
    fn = W.reward_udf(length_reward)
    return c.select("task_id", "gen_idx", fn(F.col("completion")).alias("length_reward"))


@query("udf6_compute_metrics", """
SELECT lang, CAST(count(*) AS BIGINT) AS n, round(avg(CASE WHEN toxic = quality THEN 1 ELSE 0 END), 6) AS accuracy
FROM labels JOIN documents USING (doc_id) GROUP BY lang""")
def udf6(spark, sf):
    lab = tables.table(spark, sf, "labels").join(tables.table(spark, sf, "documents").select("doc_id", "lang"),
                                                  "doc_id")
    m = M.compute_metrics(lab, {"n": lambda: F.count(F.lit(1)),
                                "accuracy": lambda: F.avg((F.col("toxic") == F.col("quality")).cast("int"))},
                          by="lang")
    return m.select("lang", "n", r6("accuracy").alias("accuracy"))


@query("udf1_transform_kwargs", f"""
SELECT doc_id, 'summarize: ' || text || {NL} AS prompt FROM documents""")
def udf1(spark, sf):
    d = tables.table(spark, sf, "documents")
    return d.transform(lambda df, start, end: df.select(
        "doc_id", R.summarize_prompt("text", start, end).alias("prompt")), "summarize: ", "\n")



