"""Registered queries: tokens, vocabulary, truncation, padding, masks,
packing and calibration samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenmill.functions import text as X
from tokenmill.operators import records as R
from tokenmill.operators import tokens as T
from tokenmill.operators.offsets import hash_key
from tokenmill.operators.runs import source_dispatch
from tokenmill.plans import tables
from tokenmill.plans.q_records import FMT15_EXPR, INSTR, instr_records
from tokenmill.plans.registry import arr_text, query

VOCAB_SIZE = 2000

# SQL building blocks ----------------------------------------------------------
TOK = r"tok AS (SELECT doc_id, regexp_extract_all(text, '\S+') AS t FROM documents)"
VOCAB = rf"""{TOK},
cnt AS (SELECT token, count(*) AS freq FROM (SELECT unnest(t) AS token FROM tok)
        WHERE token NOT IN ('<pad>', '<eos>', '<unk>') GROUP BY token),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY freq DESC, token) + 2 AS INTEGER) AS id FROM cnt
          QUALIFY row_number() OVER (ORDER BY freq DESC, token) <= {VOCAB_SIZE}
          UNION ALL SELECT * FROM (VALUES ('<pad>', 0), ('<eos>', 1), ('<unk>', 2)) v(token, id)),
ex AS (SELECT doc_id, unnest(t) AS token, unnest(range(len(t))) AS pos FROM tok),
enc0 AS (SELECT doc_id, list(CAST(coalesce(v.id, 2) AS INTEGER) ORDER BY pos) AS ids
         FROM ex LEFT JOIN vocab v USING (token) GROUP BY doc_id),
enc AS (SELECT tok.doc_id, coalesce(enc0.ids, CAST([] AS INTEGER[])) AS ids FROM tok LEFT JOIN enc0 USING (doc_id))"""


def L(expr: str) -> str:
    return f"array_to_string(list_transform({expr}, lambda x: CAST(x AS VARCHAR)), ',')"


def PAD(expr: str, n: str, pad: int = 0) -> str:
    return f"list_concat({expr}, list_transform(range(greatest({n} - len({expr}), 0)), lambda x: {pad}))"


def MASK(expr: str, n: str) -> str:
    return (f"list_concat(list_transform(range(len({expr})), lambda x: 1), "
            f"list_transform(range(greatest({n} - len({expr}), 0)), lambda x: 0))")


WIDTH = "CAST(((len(ids) + 63) // 64) * 64 AS INTEGER)"


def width(ids: str):
    """A document's own padded length: the next multiple of 64."""
    return X.round_up_to(F.size(ids), 64).cast("int")


def docs_tokens(spark, sf):
    return T.tokenize(tables.spread_table(spark, sf, "documents", "doc_id", "text"), "text")


def docs_ids(spark, sf):
    d = docs_tokens(spark, sf)
    vocab = T.build_vocab(d, "tokens", VOCAB_SIZE)
    return T.encode(d, "doc_id", "tokens", vocab)


# TOK-1 -------------------------------------------------------------------------
@query("tok1_tokenize", rf"""
WITH {TOK} SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS tokens FROM tok""")
def tok1(spark, sf):
    d = docs_tokens(spark, sf)
    return d.select("doc_id", F.size("tokens").alias("n_tokens"),
                    F.array_join("tokens", " ").alias("tokens"))


# TOK-2 -------------------------------------------------------------------------
@query("tok2_build_vocab", f"WITH {VOCAB} SELECT token, id FROM vocab")
def tok2(spark, sf):
    return T.build_vocab(docs_tokens(spark, sf), "tokens", VOCAB_SIZE)


@query("tok2_encode_join", f"WITH {VOCAB} SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE {L('ids')} END AS input_ids FROM enc")
def tok2c(spark, sf):
    """The shuffle form, with NULL token lists."""
    d = docs_tokens(spark, sf)
    vocab = T.build_vocab(d, "tokens", VOCAB_SIZE)
    d = d.withColumn("tokens", F.when(F.col("doc_id") % 9 != 0, F.col("tokens")))
    return T.encode(d, "doc_id", "tokens", vocab, method="join").select("doc_id", arr_text("input_ids").alias("input_ids"))


@query("tok2_encode", f"WITH {VOCAB} SELECT doc_id, {L('ids')} AS input_ids FROM enc")
def tok2b(spark, sf):
    return docs_ids(spark, sf).select("doc_id", arr_text("input_ids").alias("input_ids"))


# TOK-3 -------------------------------------------------------------------------
@query("tok3_truncate", rf"""
WITH {TOK} SELECT doc_id, array_to_string(list_slice(t, 1, 32), ' ') AS right_cut,
  array_to_string(list_slice(t, greatest(len(t) - 32, 0) + 1, greatest(len(t) - 32, 0) + 32), ' ') AS left_cut
FROM tok""")
def tok3(spark, sf):
    d = docs_tokens(spark, sf)
    return d.select("doc_id", F.array_join(T.truncate("tokens", 32), " ").alias("right_cut"),
                    F.array_join(T.truncate("tokens", 32, side="left"), " ").alias("left_cut"))


# TOK-4 -------------------------------------------------------------------------
@query("tok4_pad", f"""
WITH {VOCAB}, c AS (SELECT doc_id, ids AS s, {WIDTH} AS n FROM enc)
SELECT doc_id, {L(PAD('s', 'n'))} AS input_ids, {L(MASK('s', 'n'))} AS attention_mask,
       {L("list_concat(list_transform(range(greatest(n - len(s), 0)), lambda x: 0), s)")} AS left_padded
FROM c""")
def tok4(spark, sf):
    d = docs_ids(spark, sf).withColumn("n", width("input_ids"))
    return d.select("doc_id", arr_text(T.pad("input_ids", F.col("n"))).alias("input_ids"),
                    arr_text(T.attention_mask("input_ids", F.col("n"))).alias("attention_mask"),
                    arr_text(T.pad("input_ids", F.col("n"), side="left")).alias("left_padded"))


# TOK-5 -------------------------------------------------------------------------
@query("tok5_pad_to_multiple", f"""
WITH {VOCAB},
b AS (SELECT doc_id, ids AS s,
             (row_number() OVER (ORDER BY substr(md5('42-' || CAST(doc_id AS VARCHAR)), 1, 15), doc_id) - 1) // 16 AS batch
      FROM enc),
m AS (SELECT *, CAST(((max(len(s)) OVER (PARTITION BY batch) + 7) // 8) * 8 AS INTEGER) AS target FROM b)
SELECT doc_id, CAST(batch AS BIGINT) AS batch, {L(PAD('s', 'target'))} AS padded, {L(MASK('s', 'target'))} AS attention_mask
FROM m""")
def tok5(spark, sf):
    d = docs_ids(spark, sf).withColumnRenamed("input_ids", "s")
    b = R.assign_batches(d, 16, [hash_key("doc_id", seed="42"), "doc_id"])
    out = T.pad_to_multiple(b, "batch", "s", m=8)
    return out.select("doc_id", "batch", arr_text("padded").alias("padded"),
                      arr_text("attention_mask").alias("attention_mask"))


# TOK-6 / TOK-7 -----------------------------------------------------------------
MASKED = f"list_transform({PAD('ids', 'n')}, lambda x: CASE WHEN x = 0 THEN -100 ELSE x END)"


@query("tok6_mask_labels", f"WITH {VOCAB} SELECT doc_id, {L(MASKED)} AS labels FROM (SELECT *, {WIDTH} AS n FROM enc)")
def tok6(spark, sf):
    d = docs_ids(spark, sf)
    return d.select("doc_id", arr_text(T.mask_labels(T.pad("input_ids", width("input_ids")))).alias("labels"))


@query("tok7_unmask_labels", f"""
WITH {VOCAB} SELECT doc_id, {L(f'list_transform({MASKED}, lambda x: CASE WHEN x = -100 THEN 0 ELSE x END)')} AS ids
FROM (SELECT *, {WIDTH} AS n FROM enc)""")
def tok7(spark, sf):
    d = docs_ids(spark, sf)
    masked = T.mask_labels(T.pad("input_ids", width("input_ids")))
    return d.select("doc_id", arr_text(T.unmask_labels(masked)).alias("ids"))


# TOK-8 / TOK-12 ------------------------------------------------------------------
@query("tok8_supervised_features", f"""
WITH {VOCAB}, c AS (SELECT doc_id, list_slice(ids, 1, 96) AS s, list_slice(ids, 1, 8) AS g FROM enc)
SELECT doc_id, {L(PAD('s', '96'))} AS input_ids, {L(MASK('s', '96'))} AS attention_mask,
       {L(f"list_transform({PAD('g', '12')}, lambda x: CASE WHEN x = 0 THEN -100 ELSE x END)")} AS labels
FROM c""")
def tok8(spark, sf):
    d = docs_ids(spark, sf).withColumnRenamed("input_ids", "src")
    f = T.supervised_features(d.withColumn("tgt", F.slice("src", 1, 8)), "src", "tgt", 96, 12)
    return f.select("doc_id", arr_text("input_ids").alias("input_ids"),
                    arr_text("attention_mask").alias("attention_mask"), arr_text("labels").alias("labels"))


@query("tok12_fixed_tensor_columns", f"WITH {VOCAB} SELECT doc_id, CAST(96 AS INTEGER) AS width FROM enc")
def tok12(spark, sf):
    d = docs_ids(spark, sf).withColumn("tgt", F.slice("input_ids", 1, 8))
    f = T.supervised_features(d.withColumnRenamed("input_ids", "src"), "src", "tgt", 96, 12)
    fixed = T.fixed_tensor_columns(f, ["input_ids", "attention_mask"], 96)
    return fixed.select("doc_id", F.size("input_ids").alias("width"))


# TOK-9 / TOK-10 / TOK-11 ---------------------------------------------------------
def PACK_SQL(src: str, order: str, block: int, cols: dict[str, str]) -> str:
    """``src`` yields ``order`` columns and a list ``t``; extra ``cols``
    are lists parallel to ``t`` (name -> expression over ``t``)."""
    extra_un = "".join(f", unnest({e}) AS {n}" for n, e in cols.items())
    extra_out = "".join(f", {L(f'list({n} ORDER BY gpos)')} AS {n}" for n in cols)
    return f"""
, o AS (SELECT *, coalesce(sum(len(t)) OVER (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
              sum(len(t)) OVER () AS total FROM ({src}) s),
x0 AS (SELECT start, total, unnest(t) AS tok, unnest(range(len(t))) AS i{extra_un} FROM o),
x AS (SELECT *, start + i AS gpos FROM x0)
SELECT CAST(gpos // {block} AS BIGINT) AS block_id, CAST(count(*) AS INTEGER) AS n_tokens,
       array_to_string(list(tok ORDER BY gpos), ' ') AS input_ids{extra_out}
FROM x WHERE gpos // {block} < total // {block} GROUP BY 1"""


@query("tok9_pack_blocks", f"WITH i AS ({INSTR})" + PACK_SQL(
    rf"SELECT doc_id, regexp_extract_all({FMT15_EXPR} || '<eos>', '\S+') AS t FROM i", "doc_id", 2048, {}))
def tok9(spark, sf):
    i = instr_records(spark, sf)
    txt = R.append_eos(R.instruction_context_answer("instruction", "context", "response"))
    t = i.select("doc_id", T.tokenize_col(txt).alias("input_ids"))
    p = T.pack_blocks(t, ["doc_id"], ["input_ids"], 2048)
    return p.select("block_id", F.size("input_ids").alias("n_tokens"),
                    F.array_join("input_ids", " ").alias("input_ids"))


@query("tok10_pack_texts", "WITH candidates AS (" + tables.CANDIDATES_SQL + ")" + PACK_SQL(
    r"SELECT prompt_id, cand_idx, list_concat(regexp_extract_all(text, '\S+'), ['<eos>']) AS t FROM candidates",
    "prompt_id, cand_idx", 512, {}))
def tok10(spark, sf):
    c = tables.candidates(spark, sf)
    p = T.pack_texts(c, ["prompt_id", "cand_idx"], "text", 512, separator="<eos>")
    return p.select("block_id", F.size("input_ids").alias("n_tokens"),
                    F.array_join("input_ids", " ").alias("input_ids"))


@query("tok11_pack_parallel_columns", f"WITH {TOK}" + PACK_SQL(
    "SELECT doc_id, t FROM tok", "doc_id", 1024, {"lens": "list_transform(t, lambda x: length(x))"}))
def tok11(spark, sf):
    d = docs_tokens(spark, sf).withColumn("lens", F.transform("tokens", lambda x: F.length(x)))
    p = T.pack_blocks(d, ["doc_id"], ["tokens", "lens"], 1024)
    return p.select("block_id", F.size("tokens").alias("n_tokens"),
                    F.array_join("tokens", " ").alias("input_ids"), arr_text("lens").alias("lens"))


# CAL-1 / CAL-2 / CAL-3 -----------------------------------------------------------
CAL1_CTE = r"""
h AS (SELECT doc_id, text || chr(10) AS piece FROM documents ORDER BY doc_id LIMIT 700),
p AS (SELECT doc_id, piece, regexp_extract_all(piece, '\S+') AS t FROM h),
c AS (SELECT doc_id, t, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS piece_idx,
             CAST(length(piece) AS BIGINT) AS n_chars, CAST(len(t) AS BIGINT) AS n_tokens,
             CAST(coalesce(sum(len(t)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS token_start,
             CAST(sum(len(t)) OVER () AS BIGINT) AS total_tokens FROM p)"""


def cal_corpus(spark, sf):
    d = tables.table(spark, sf, "documents").select("doc_id", "text")
    return T.calibration_corpus(d, "lines", 700, ["doc_id"], "text")


@query("cal1_calibration_corpus", f"""
WITH {CAL1_CTE} SELECT piece_idx, n_chars, n_tokens, token_start, total_tokens FROM c""")
def cal1(spark, sf):
    return cal_corpus(spark, sf).select("piece_idx", "n_chars", "n_tokens", "token_start", "total_tokens")


CAL_SOURCES = {"math": ("pair_colon", "source", "text"), "medical": ("pair_space", "lang", "text"),
               "code": ("lines", "text", None), "wikitext": ("concat", "text", None), "german": ("middle_part", "text", None)}
CAL_PIECES = {"math": "source || ': ' || text || chr(10)", "medical": "lang || ' ' || text || chr(10)", "code": "text || chr(10)",
              "wikitext": "CASE WHEN text = '' THEN ' ' || chr(10) ELSE text END",
              "german": "regexp_replace(CASE WHEN len(string_split(text, '===')) >= 3 THEN string_split(text, '===')[3] ELSE text END, '^\\s+|\\s+$', '', 'g') || chr(10)"}


@query("cal4_source_dispatch", " UNION ALL ".join(f"""
SELECT '{k}' AS source_name, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS piece_idx,
       md5(piece) AS piece_md5, CAST(length(piece) AS BIGINT) AS n_chars
FROM (SELECT doc_id, {v} AS piece FROM (SELECT doc_id, lang, source, CASE WHEN doc_id % 5 = 0 THEN 'a===b=== ' || text ELSE text END AS text FROM documents)
      ORDER BY doc_id LIMIT 300)""" for k, v in CAL_PIECES.items()))
def cal4(spark, sf):
    """All five kinds of calibration text, chosen by the name of their source."""
    d = tables.table(spark, sf, "documents").select("doc_id", "lang", "source", F.when(
        F.col("doc_id") % 5 == 0, F.concat(F.lit("a===b=== "), "text")).otherwise(F.col("text")).alias("text"))

    def builder(kind, a, b):
        return lambda: T.calibration_corpus(d, kind, 300, ["doc_id"], a, b)

    builders = {k: builder(*v) for k, v in CAL_SOURCES.items()}
    out = None
    for name in ("maths", "medical", "evol-instruct-code", "wikitext", "germanquad"):
        build = source_dispatch(name, builders, {"maths": "math", "evol-instruct-code": "code", "germanquad": "german"})
        real = {"maths": "math", "evol-instruct-code": "code", "germanquad": "german"}.get(name, name)
        part = build().select(F.lit(real).alias("source_name"), "piece_idx", F.md5("piece").alias("piece_md5"), "n_chars")
        out = part if out is None else out.unionByName(part)
    return out


@query("cal2_random_windows", f"""
WITH {CAL1_CTE},
w AS (SELECT window_id, ('0x' || substr(md5('crop0-' || CAST(window_id AS VARCHAR)), 1, 15))::BIGINT
                        % (max(total_tokens) - 128) AS crop_start
      FROM range(16) r(window_id), (SELECT max(total_tokens) AS total_tokens FROM c) GROUP BY window_id),
x AS (SELECT token_start + i AS gpos, tok FROM (SELECT token_start, unnest(t) AS tok, unnest(range(len(t))) AS i FROM c))
SELECT CAST(window_id AS BIGINT) AS window_id, CAST(crop_start AS BIGINT) AS crop_start,
       array_to_string(list(tok ORDER BY gpos), ' ') AS input_ids, CAST(count(*) AS INTEGER) AS n
FROM w JOIN x ON x.gpos >= w.crop_start AND x.gpos < w.crop_start + 128 GROUP BY window_id, crop_start""")
def cal2(spark, sf):
    w = T.random_windows(cal_corpus(spark, sf), 16, 128, seed=0)
    return w.select(F.col("window_id").cast("bigint").alias("window_id"), "crop_start",
                    F.array_join("input_ids", " ").alias("input_ids"),
                    F.size("attention_mask").alias("n"))


@query("cal3_random_doc_windows", rf"""
WITH {TOK},
p AS (SELECT * FROM tok WHERE len(t) >= 64
      ORDER BY substr(md5('0-' || CAST(doc_id AS VARCHAR)), 1, 15), doc_id LIMIT 8),
s AS (SELECT doc_id, t, ('0x' || substr(md5('docstart0-' || CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT
                      % greatest(len(t) - 64, 1) AS crop_start FROM p)
SELECT doc_id, CAST(crop_start AS BIGINT) AS crop_start,
       array_to_string(list_slice(t, crop_start + 1, crop_start + 64), ' ') AS input_ids FROM s""")
def cal3(spark, sf):
    d = docs_tokens(spark, sf)
    w = T.random_doc_windows(d, "doc_id", "tokens", 8, 64, seed=0)
    return w.select("doc_id", "crop_start", F.array_join("input_ids", " ").alias("input_ids"))

