"""Record shaping: projections (PRJ), filters (FLT) and formatting (FMT).

All functions map DataFrame -> DataFrame with native expressions; they
never collect and add no shuffle except where noted (FMT-4 groups turns,
FLT-6 reads a bounded list of rules or joins a longer one in blocks).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tokenmill.functions import chat, text
from tokenmill.operators.offsets import with_positions
from tokenmill.session import bounded_size

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# PRJ-1 ---------------------------------------------------------------
def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


# PRJ-2 ---------------------------------------------------------------
def keep(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.select(*cols)


# PRJ-3 ---------------------------------------------------------------
def replace_columns(df: DataFrame, exprs: dict[str, Column],
                    drop: Iterable[str] | None = None) -> DataFrame:
    """Map to new columns, then drop all input columns (or only ``drop``)."""
    if drop is None:
        return df.select(*[e.alias(k) for k, e in exprs.items()])
    kept = [c for c in df.columns if c not in set(drop) and c not in exprs]
    return df.select(*kept, *[e.alias(k) for k, e in exprs.items()])


# PRJ-4 ---------------------------------------------------------------
def keep_except(df: DataFrame, *names: str) -> DataFrame:
    """Drop every column but the named one(s)."""
    return df.select(*[c for c in df.columns if c in names])


# PRJ-5 ---------------------------------------------------------------
def with_row_id(df: DataFrame, order_by: list[ColumnOrName], col: str = "row_id") -> DataFrame:
    """Dense 0-based id in ``order_by`` order (bucketed, see offsets)."""
    return with_positions(df, order_by, pos_col=col)


# PRJ-6 ---------------------------------------------------------------
def map_rows(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    return df.withColumns(exprs)


# PRJ-7 ---------------------------------------------------------------
def map_batches(df: DataFrame, fn: Callable, schema: StructType | str,
                arrow: bool = False) -> DataFrame:
    """Batch-of-columns function; may change the row count."""
    return df.mapInArrow(fn, schema) if arrow else df.mapInPandas(fn, schema)


# PRJ-8 ---------------------------------------------------------------
def describe(df: DataFrame, by: str | None = None) -> DataFrame:
    """Row count (per ``by`` value) plus the column names and types."""
    schema_text = ", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields)
    grouped = df.groupBy(by) if by else df.groupBy()
    return grouped.agg(F.count(F.lit(1)).alias("num_rows")) \
        .withColumn("features", F.lit(schema_text))


# PRJ-9 ---------------------------------------------------------------
def assign_batches(df: DataFrame, size: int, order_by: list[ColumnOrName],
                   col: str = "batch") -> DataFrame:
    """Consecutive batches of ``size`` rows in ``order_by`` order."""
    return with_row_id(df, order_by).withColumn(
        col, F.floor(F.col("row_id") / F.lit(size)).cast("bigint"))


# FLT-1 ---------------------------------------------------------------
def filter_even_turns(df: DataFrame, messages: str = "messages") -> DataFrame:
    """Keep conversations with an even number of messages after the first."""
    return df.where((F.size(messages) - 1) % 2 == 0)


# FLT-2 ---------------------------------------------------------------
def filter_max_tokens(df: DataFrame, token_cols: list[str], cap: int) -> DataFrame:
    total = sum((F.size(c) for c in token_cols), F.lit(0))
    return df.where(total <= cap)


# FLT-3 ---------------------------------------------------------------
def filter_complete_pairs(df: DataFrame, chosen: str = "chosen",
                          rejected: str = "rejected") -> DataFrame:
    """Both texts present and non-empty (truthiness)."""
    return df.where((F.length(chosen) > 0) & (F.length(rejected) > 0))


# FLT-4 ---------------------------------------------------------------
def filter_last_turn_differs(df: DataFrame, chosen: str = "chosen",
                             rejected: str = "rejected") -> DataFrame:
    """Chosen and rejected agree on all turns but the last."""
    return df.where(text.all_but_last(chosen) == text.all_but_last(rejected))


# FLT-5 ---------------------------------------------------------------
def filter_min_tokens(df: DataFrame, tokens: str, n: int) -> DataFrame:
    return df.where(F.size(tokens) >= n)


# FLT-6 ---------------------------------------------------------------
def match_any_pattern(df: DataFrame, patterns: DataFrame, col: str,
                      pattern_col: str = "entry", block: int = 1_000, max_patterns: int = 100_000,
                      max_bytes: int = 16 << 20, buckets: int | None = None) -> DataFrame:
    """Rows whose ``col`` matches any regex of ``patterns`` at its start.

    The pattern list is a file of rules: where a bounded read proves that it
    has at most ``max_patterns`` rules of ``max_bytes`` in all, they are folded into
    anchored alternations of ``block`` patterns, tried one after the other on each
    row, so the filter is no join. A longer list never reaches the driver: its rules are folded
    in blocks by Spark, and the different values of ``col``, in ``buckets``
    (the session's shuffle partitions), meet every block; the rows then take
    the values that matched."""
    rules = patterns.select(F.col(pattern_col).alias("_p")).where("_p IS NOT NULL")
    rows, size = bounded_size(rules, max_patterns)
    if rows > max_patterns or size > max_bytes:
        return _match_in_blocks(df, rules, col, block, buckets)
    pats = [r[0] for r in rules.collect()]
    if not pats:
        return df.limit(0)
    hits = [F.col(col).rlike("(?d)^(?:" + "|".join(f"(?:{p})" for p in pats[i:i + block]) + ")")
            for i in range(0, len(pats), block)]
    return df.where(F.exists(F.array(*hits), lambda h: h) if len(hits) > 1 else hits[0])


def _match_in_blocks(df: DataFrame, patterns: DataFrame, col: str, block: int, buckets: int | None) -> DataFrame:
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    once = patterns.distinct()
    blocks = -(-once.count() // block) or 1
    dealt = once.groupBy(F.pmod(F.xxhash64("_p"), F.lit(blocks)).alias("_block"))
    folded = dealt.agg(F.concat(F.lit("(?d)^(?:"), F.array_join(F.collect_list(F.concat(F.lit("(?:"), "_p", F.lit(")"))), "|"),
                                F.lit(")")).alias("_re"))
    rules = folded.withColumn("_bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
    values = df.select(F.col(col).alias("_v")).where("_v IS NOT NULL").distinct()
    asked = values.select("_v", F.pmod(F.xxhash64("_v"), F.lit(buckets)).alias("_bucket"),
                          F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("_block"))
    # rows arrive in order of block, and regexp_instr keeps the last expression it compiled
    met = asked.join(rules.hint("merge"), ["_block", "_bucket"]).where(F.regexp_instr(F.col("_v"), F.col("_re")) > 0)
    name = "_v"
    while name in df.columns:
        name += "_"
    return df.join(met.select(F.col("_v").alias(name)).distinct().hint("merge"), df[col] == F.col(name), "left_semi")


# FLT-7 ---------------------------------------------------------------
def has_role(messages: ColumnOrName, pos: int, role: str) -> Column:
    m = F.try_element_at(_c(messages), F.lit(pos + 1 if pos >= 0 else pos))
    return F.coalesce(m["role"] == F.lit(role), F.lit(False))


# FMT-1 ---------------------------------------------------------------
def to_messages(df: DataFrame, system: ColumnOrName | None, user: ColumnOrName,
                assistant: ColumnOrName | None, out: str = "messages") -> DataFrame:
    parts = []
    if system is not None:
        parts.append(chat.message("system", system))
    parts.append(chat.message("user", user))
    if assistant is not None:
        parts.append(chat.message("assistant", assistant))
    return df.withColumn(out, F.array(*parts))


def template(tpl: str, **cols: ColumnOrName) -> Column:
    """Fill ``{name}`` slots of ``tpl`` with columns by concatenation
    (user text never becomes a format string)."""
    import re
    pieces: list[Column] = []
    pos = 0
    for m in re.finditer(r"\{(\w+)\}", tpl):
        if m.start() > pos:
            pieces.append(F.lit(tpl[pos:m.start()]))
        pieces.append(_c(cols[m.group(1)]).cast("string"))
        pos = m.end()
    if pos < len(tpl):
        pieces.append(F.lit(tpl[pos:]))
    return F.concat(*pieces) if pieces else F.lit("")


# FMT-2 ---------------------------------------------------------------
def to_multimodal_messages(df: DataFrame, system: str, user_text: ColumnOrName,
                           image: ColumnOrName, assistant: ColumnOrName,
                           out: str = "messages") -> DataFrame:
    """Contents are lists of typed parts; the user turn carries an image."""
    def part(kind, txt=None, img=None):
        return F.struct(F.lit(kind).alias("type"),
                        (txt if txt is not None else F.lit(None).cast("string")).alias("text"),
                        (img if img is not None else F.lit(None).cast("binary")).alias("image"))

    msgs = F.array(
        F.struct(F.lit("system").alias("role"), F.array(part("text", F.lit(system))).alias("content")),
        F.struct(F.lit("user").alias("role"),
                 F.array(part("text", _c(user_text)), part("image", None, _c(image).cast("binary")))
                 .alias("content")),
        F.struct(F.lit("assistant").alias("role"),
                 F.array(part("text", _c(assistant))).alias("content")))
    return df.withColumn(out, msgs)


# FMT-3 ---------------------------------------------------------------
def ensure_system(messages: ColumnOrName, system_text: ColumnOrName) -> Column:
    """Prepend a system message unless the first one already is."""
    m = _c(messages)
    sys_msg = chat.message("system", system_text if isinstance(system_text, Column)
                           else F.lit(system_text))
    return F.when(has_role(m, 0, "system"), m).otherwise(F.concat(F.array(sys_msg), m))


# FMT-4 ---------------------------------------------------------------
def assemble_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn",
                   role: str = "role", text_col: str = "text",
                   out: str = "messages") -> DataFrame:
    """Turn rows -> one conversation array per ``conv`` ordered by ``turn``.

    One shuffle on the conversation key; a conversation is one record, so
    its turns have to meet in one row.
    """
    packed = F.struct(F.col(turn).alias("t"), F.col(role).alias("role"),
                      F.col(text_col).alias("content"))
    return (df.groupBy(conv)
            .agg(F.array_sort(F.collect_list(packed)).alias("_tm_turns"))
            .select(conv, F.transform("_tm_turns", lambda s: F.struct(
                s["role"].alias("role"), s["content"].alias("content"))).alias(out)))


def chatml_token_counts(turns: DataFrame, system_text: str, conv: str = "conv_id",
                        turn: str = "turn", role: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation: number of messages and whitespace tokens of its
    ChatML rendering after ``ensure_system`` — without assembling it.

    Every ChatML message ends in a newline, so no token spans two
    messages: the count is a sum over turns (a partial aggregate). A
    conversation with very many turns is never collected into one row.
    """
    from tokenmill.operators.tokens import tokenize_col
    rendered = turns.select(
        conv, turn, role,
        F.size(tokenize_col(F.concat(F.lit(chat.IM_START), F.col(role), F.lit("\n"),
                                     F.col(text_col), F.lit(chat.IM_END + "\n")))).alias("_tm_tok"))
    sys_tokens = F.size(tokenize_col(F.lit(f"{chat.IM_START}system\n{system_text}{chat.IM_END}\n")))
    # fixed-width aggregate buffers (no string in min_by): hash aggregation
    per_conv = rendered.groupBy(conv).agg(
        F.count(F.lit(1)).alias("_tm_n"),
        F.min_by((F.col(role) == "system"), turn).alias("_tm_first_sys"),
        F.sum("_tm_tok").alias("_tm_sum"))
    has_sys = F.coalesce(F.col("_tm_first_sys"), F.lit(False))
    return per_conv.select(
        conv,
        (F.col("_tm_n") + F.when(has_sys, 0).otherwise(1)).alias("n_messages"),
        (F.col("_tm_sum") + F.when(has_sys, 0).otherwise(sys_tokens)).alias("tokens"))


# FMT-13 --------------------------------------------------------------
def list_text(nums: ColumnOrName) -> Column:
    """Python-style list text ``[a, b, c]``."""
    return F.concat(F.lit("["), F.array_join(F.transform(_c(nums), lambda x: x.cast("string")),
                                             ", "), F.lit("]"))


# Task wording of the countdown prompt (script version).
R1_SYSTEM = ("You are a helpful assistant. You first thinks about the reasoning process in the "
             "mind and then provides the user with the answer.")
R1_USER = ("Using the numbers {nums}, create an equation that equals {target}. You can use basic "
           "arithmetic operations (+, -, *, /) one or multiple times but each number can only be "
           "used once. Show your work in <think> </think> tags. And return the final equation "
           "in <answer> </answer> tags, for example <answer> (1 + 2) / 3 </answer>. Think step "
           "by step inside <think> tags.")
# The notebook's shorter task wording.
R1_USER_NOTEBOOK = ("Using the numbers {nums}, create an equation that equals {target}. You can use "
                    "basic arithmetic operations (+, -, *, /) and each number can only be used once. "
                    "Show your work in <think> </think> tags. And return the final equation and answer "
                    "in <answer> </answer> tags, for example <answer> (1 + 2) / 3 = 1 </answer>.")
R1_PREFILL = "Let me solve this step by step.\n<think>"


def r1_prompt(nums: ColumnOrName, target: ColumnOrName, wording: str = "script") -> Column:
    """System + task + assistant prefill, the last message left open;
    ``wording`` is ``"script"`` or ``"notebook"``."""
    task = {"script": R1_USER, "notebook": R1_USER_NOTEBOOK}[wording]
    msgs = F.array(
        chat.message("system", F.lit(R1_SYSTEM)),
        chat.message("user", template(task, nums=list_text(nums), target=target)),
        chat.message("assistant", F.lit(R1_PREFILL)))
    return chat.chatml(msgs, continue_final=True)


# FMT-14 / FMT-15 -----------------------------------------------------
# Instruction-record formats.
INSTRUCTION_BLOCK = ("### Instruction:\nUse the Input below to create an instruction, which could "
                     "have been used to generate the input using an LLM. \n\n### Input:\n{response}"
                     "\n\n### Response:\n{instruction}\n")
INSTRUCTION_HEADER = "### Instruction\n"
CONTEXT_HEADER = "### Context\n"
ANSWER_HEADER = "### Answer\n"


def instruction_block(instruction: ColumnOrName, response: ColumnOrName) -> Column:
    """``### Instruction / ### Input / ### Response``; the instruction is
    to be generated back from the response."""
    return template(INSTRUCTION_BLOCK, instruction=instruction, response=response)


def instruction_context_answer(instruction: ColumnOrName, context: ColumnOrName,
                               response: ColumnOrName) -> Column:
    """Context block omitted when empty; parts joined by a blank line."""
    ctx = F.when(F.length(_c(context)) > 0, F.concat(F.lit(CONTEXT_HEADER), _c(context)))
    return F.concat_ws("\n\n", F.concat(F.lit(INSTRUCTION_HEADER), _c(instruction)), ctx,
                       F.concat(F.lit(ANSWER_HEADER), _c(response)))


# FMT-16 --------------------------------------------------------------
def append_eos(x: ColumnOrName, eos: str = chat.EOS) -> Column:
    return F.concat(_c(x), F.lit(eos))


# FMT-17 --------------------------------------------------------------
def summarize_prompt(x: ColumnOrName, start: str = "summarize: ", end: str = "") -> Column:
    return F.concat(F.lit(start), _c(x), F.lit(end))


# FMT-18 --------------------------------------------------------------
# Product prompt wording.
PRODUCT_PROMPT = ("Create a Short Product description based on the provided ##PRODUCT NAME## and "
                  "##CATEGORY## and image. \nOnly return description. The description should be "
                  "SEO optimized and for a better mobile search experience.\n\n##PRODUCT NAME##: "
                  "{product_name}\n##CATEGORY##: {category}")


def product_prompt(name: ColumnOrName, category: ColumnOrName) -> Column:
    return template(PRODUCT_PROMPT, product_name=name, category=category)


# FMT-19 --------------------------------------------------------------
def system_user_prompt(df: DataFrame, system: str, col: str) -> DataFrame:
    """Keep both the message list and the rendered prompt (open assistant turn)."""
    msgs = F.array(chat.message("system", F.lit(system)), chat.message("user", col))
    return df.withColumn("messages", msgs).withColumn(
        "prompt", chat.chatml("messages", add_generation_prompt=True))


# FMT-20 --------------------------------------------------------------
def preference_triplets(df: DataFrame, default_system: str, chosen: str = "chosen",
                        rejected: str = "rejected") -> DataFrame:
    """prompt = all but the last turn of ``chosen`` (system ensured),
    chosen/rejected = last assistant message of each, all rendered."""
    prompt_msgs = ensure_system(text.all_but_last(chosen), F.lit(default_system))

    def last_assistant(col):
        m = text.last_where(col, lambda x: x["role"] == "assistant")
        return F.when(m.isNotNull(), chat.chatml(F.array(m)))

    return df.select(chat.chatml(prompt_msgs).alias("prompt"),
                     last_assistant(chosen).alias("chosen"),
                     last_assistant(rejected).alias("rejected"))


# FMT-21 --------------------------------------------------------------
def preference_columns(df: DataFrame, role: str = "assistant") -> DataFrame:
    """Flat pair -> rendered prompt (system+user), chosen and rejected as
    single ``role`` turns."""
    prompt = chat.chatml(F.array(chat.message("system", "system_prompt"),
                                 chat.message("user", "prompt")))
    return df.select(prompt.alias("prompt"),
                     chat.chatml(F.array(chat.message(role, "chosen"))).alias("chosen"),
                     chat.chatml(F.array(chat.message(role, "rejected"))).alias("rejected"))


# FMT-22 --------------------------------------------------------------
def strip_prompt(generated: ColumnOrName, prompt: ColumnOrName) -> Column:
    """Generated text minus the prompt prefix, whitespace-stripped."""
    return text.strip(F.substring(_c(generated), F.length(_c(prompt)) + 1, 1 << 30))


# FMT-23 --------------------------------------------------------------
def context_turns(messages: ColumnOrName, n: int = 2) -> Column:
    return F.slice(_c(messages), 1, n)


# FMT-24 --------------------------------------------------------------
def pair_records(df: DataFrame, kind: str, anchor: str, positive: str,
                 negative: str | None = None, score: str | None = None) -> DataFrame:
    """Embedding-training shapes: pair, triplet or scored pair."""
    cols = [F.col(anchor).alias("anchor"), F.col(positive).alias("positive")]
    if kind == "triplet":
        cols.append(F.col(negative).alias("negative"))
    elif kind == "scored":
        cols.append(F.col(score).cast("double").alias("score"))
    elif kind != "pair":
        raise ValueError(kind)
    out = df.select(*cols)
    return out.where(F.col("anchor").isNotNull() & F.col("positive").isNotNull())
