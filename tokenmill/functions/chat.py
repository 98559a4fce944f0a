"""Chat-template rendering as native Column expressions (FMT-5 … FMT-12).

A conversation is ``ARRAY<STRUCT<role STRING, content STRING>>``. Each
style renders it with ``transform`` + ``array_join`` — no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Special tokens and role markers of the supported styles.
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
BOS = "<bos>"
EOS = "<eos>"
LLAMA3_BOS = "<|begin_of_text|>"
LLAMA3_HEADER_START = "<|start_header_id|>"
LLAMA3_HEADER_END = "<|end_header_id|>"
LLAMA3_EOT = "<|eot_id|>"
HUMAN_PREFIX = "\n\nHuman: "
ASSISTANT_PREFIX = "\n\nAssistant: "
LLAMA2_INST_OPEN = "[INST] "
LLAMA2_INST_CLOSE = " [/INST]"
LLAMA2_SYS_OPEN = "<<SYS>>\n"
LLAMA2_SYS_CLOSE = "\n<</SYS>>\n\n"
STARCHAT_END = "<|end|>"
IDEFICS_USER = "User:"
IDEFICS_ASSISTANT = "Assistant:"
IDEFICS_END = "<end_of_utterance>\n"

STYLES = ("chatml", "human_assistant", "llama3_header", "gemma_chatml",
          "llama2_inst", "starchat", "idefics")


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def message(role: str | Column, content: ColumnOrName) -> Column:
    r = F.lit(role) if isinstance(role, str) else role
    return F.struct(r.alias("role"), _c(content).cast("string").alias("content"))


def _text(x: Column) -> Column:
    """A message's role or content; NULL renders as the empty text, so the
    message itself stays in the prompt."""
    return F.coalesce(x, F.lit(""))


def _join(parts: Column) -> Column:
    return F.array_join(parts, "")


def _last_open(msgs: Column, render_closed, render_open) -> Column:
    """Render all messages closed except the last one, left open."""
    n = F.size(msgs)
    return F.array_join(
        F.transform(msgs, lambda m, i: F.when(i == n - 1, render_open(m))
                    .otherwise(render_closed(m))), "")


def chatml(messages: ColumnOrName, add_generation_prompt: bool = False,
           continue_final: bool = False) -> Column:
    """ChatML: ``<|im_start|>role\\ncontent<|im_end|>\\n`` per message."""
    msgs = _c(messages)

    def closed(m):
        return F.concat(F.lit(IM_START), _text(m["role"]), F.lit("\n"), _text(m["content"]),
                        F.lit(IM_END + "\n"))

    def opened(m):
        return F.concat(F.lit(IM_START), _text(m["role"]), F.lit("\n"), _text(m["content"]))

    body = _last_open(msgs, closed, opened) if continue_final else \
        _join(F.transform(msgs, closed))
    if add_generation_prompt:
        body = F.concat(body, F.lit(IM_START + "assistant\n"))
    return body


def human_assistant(messages: ColumnOrName, eos: str = EOS,
                    add_generation_prompt: bool = False) -> Column:
    """System content bare; user/assistant turns prefixed, ``eos`` after
    each; any other role is skipped."""
    msgs = _c(messages)
    body = _join(F.transform(msgs, lambda m: F.when(_text(m["role"]) == "system", _text(m["content"]))
                             .when(_text(m["role"]) == "user",
                                   F.concat(F.lit(HUMAN_PREFIX), _text(m["content"]), F.lit(eos)))
                             .when(_text(m["role"]) == "assistant",
                                   F.concat(F.lit(ASSISTANT_PREFIX), _text(m["content"]), F.lit(eos)))
                             .otherwise(F.lit(""))))
    if add_generation_prompt:
        body = F.concat(body, F.lit(ASSISTANT_PREFIX))
    return body


def llama3_header(messages: ColumnOrName, add_generation_prompt: bool = False) -> Column:
    """Header tokens around the role, blank line, stripped content, eot;
    bos before the first message."""
    msgs = _c(messages)

    def render(m, i):
        body = F.concat(F.lit(LLAMA3_HEADER_START), _text(m["role"]), F.lit(LLAMA3_HEADER_END + "\n\n"),
                        F.regexp_replace(_text(m["content"]), r"^\s+|\s+$", ""), F.lit(LLAMA3_EOT))
        return F.when(i == 0, F.concat(F.lit(LLAMA3_BOS), body)).otherwise(body)

    out = _join(F.transform(msgs, render))
    if add_generation_prompt:
        out = F.concat(out, F.lit(LLAMA3_HEADER_START + "assistant" + LLAMA3_HEADER_END + "\n\n"))
    return out


def gemma_chatml(messages: ColumnOrName) -> Column:
    """bos + ChatML + newline + eos."""
    return F.concat(F.lit(BOS), chatml(messages), F.lit("\n" + EOS))


def llama2_inst(system: ColumnOrName, user: ColumnOrName) -> Column:
    """``[INST] <<SYS>>\\nsys\\n<</SYS>>\\n\\nuser [/INST]``."""
    return F.concat(F.lit(LLAMA2_INST_OPEN + LLAMA2_SYS_OPEN), _c(system),
                    F.lit(LLAMA2_SYS_CLOSE), _c(user), F.lit(LLAMA2_INST_CLOSE))


def starchat(messages: ColumnOrName, add_generation_prompt: bool = True) -> Column:
    """``<|role|>\\ncontent<|end|>\\n`` per message, open assistant tag."""
    msgs = _c(messages)
    out = _join(F.transform(msgs, lambda m: F.concat(
        F.lit("<|"), _text(m["role"]), F.lit("|>\n"), _text(m["content"]), F.lit(STARCHAT_END + "\n"))))
    if add_generation_prompt:
        out = F.concat(out, F.lit("<|assistant|>"))
    return out


def idefics(user: ColumnOrName, image_url: ColumnOrName | None = None) -> Column:
    """``User:`` + optional image marker + text + end of utterance."""
    img = F.lit("") if image_url is None else F.concat(
        F.lit("<fake_token_around_image>![]("), _c(image_url), F.lit(")<fake_token_around_image>"))
    return F.concat(F.lit(IDEFICS_USER), img, _c(user), F.lit(IDEFICS_END))


def first_content(messages: ColumnOrName, role: str) -> Column:
    """Content of the first message with ``role`` ('' if there is none)."""
    found = F.filter(_c(messages), lambda m: m["role"] == F.lit(role))
    return F.coalesce(F.get(found, 0)["content"], F.lit(""))


def render(messages: ColumnOrName, style: str = "chatml", **kw) -> Column:
    """Dispatch on a style name (UDF-4 registry of formatting functions)."""
    if style == "chatml":
        return chatml(messages, **kw)
    if style == "human_assistant":
        return human_assistant(messages, **kw)
    if style == "llama3_header":
        return llama3_header(messages, **kw)
    if style == "gemma_chatml":
        return gemma_chatml(messages)
    if style == "starchat":
        return starchat(messages, **kw)
    if style == "llama2_inst":
        return llama2_inst(first_content(messages, "system"), first_content(messages, "user"))
    if style == "idefics":
        return idefics(first_content(messages, "user"), **kw)
    raise ValueError(f"unknown chat style {style!r}; known: {STYLES}")
