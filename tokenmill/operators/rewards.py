"""Rewards, preference pairs and group statistics (RWD-*, WIN-1, WIN-3).

Rule-based rewards are native string expressions. The one step that
needs an arithmetic evaluator (RWD-6) runs in an Arrow-batched function
on the rows that pass every native gate; a small operator-precedence evaluator
runs there instead of ``eval``.
"""

from __future__ import annotations

import math
import operator
import re
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tokenmill.functions import text as X
from tokenmill.operators.sample import head

ColumnOrName = Column | str

# Tags of the reasoning format.
THINK_OPEN = "<think>"
THINK_CLOSE = "</think>"
ANSWER_OPEN = "<answer>"
ANSWER_CLOSE = "</answer>"


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# RWD-1 ---------------------------------------------------------------
def score_last_int(text_col: ColumnOrName, truth: ColumnOrName) -> Column:
    """Last ``\\b\\d+\\b`` of the text string-equals the truth (no number -> false)."""
    return F.coalesce(X.last_match(text_col, r"\b\d+\b") == _c(truth), F.lit(False))


# WIN-1 ---------------------------------------------------------------
def first_by(value: str, order: str, predicate: str) -> Column:
    """``value`` of the row with the smallest ``order`` among rows meeting
    ``predicate`` (SQL text); an aggregate with map-side combine."""
    return F.expr(f"min_by({value}, {order}) FILTER (WHERE {predicate})")


# RWD-2 ---------------------------------------------------------------
def preference_pairs(cands: DataFrame, key: str, idx: str, text_col: str, correct: str,
                     carry: tuple[str, ...] = ()) -> DataFrame:
    """Per prompt: first correct candidate = chosen, first wrong = rejected
    (even when empty, which then drops the pair); incomplete pairs dropped.

    One shuffle on ``key``; ``min_by … FILTER`` combines map-side, so a
    prompt with very many candidates ships one partial row per task.
    """
    aggs = [first_by(text_col, idx, f"{correct}").alias("chosen"),
            first_by(text_col, idx, f"NOT {correct}").alias("rejected")]
    aggs += [F.any_value(c).alias(c) for c in carry]
    pairs = cands.groupBy(key).agg(*aggs)
    return filter_complete(pairs)


def filter_complete(pairs: DataFrame) -> DataFrame:
    return pairs.where((F.length("chosen") > 0) & (F.length("rejected") > 0))


# RWD-3 ---------------------------------------------------------------
def limit_pairs(pairs: DataFrame, n: int | None, order: str) -> DataFrame:
    """The first ``n`` pairs in prompt order (exactly ``n``); without
    ``n`` all pairs."""
    if n is None:
        return pairs
    return head(pairs, n, [order])


# RWD-4 ---------------------------------------------------------------
def explode_candidates(df: DataFrame, key: str | list[str], outputs: str,
                       idx: str = "cand_idx") -> DataFrame:
    """``n`` completions per request as rows with their 0-based index."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.select(*keys, F.posexplode(outputs).alias(idx, "text"))


# RWD-5 ---------------------------------------------------------------
def format_reward(completion: ColumnOrName) -> Column:
    """1.0 when ``<think>`` + completion is: think body without nested
    think tags, ``</think>\\n<answer>``, anything, ``</answer>`` at the end
    (one trailing newline allowed); else 0.0.

    Evaluated with string positions, not the backtracking regex (which
    overflows the JVM stack on long runs of ``<``).
    """
    body = _c(completion)
    close = F.instr(body, THINK_CLOSE)  # 1-based, 0 = absent
    head = F.substring(body, 1, close - 1)
    sep = THINK_CLOSE + "\n" + ANSWER_OPEN
    n = F.length(body)
    tail_len = F.when(body.endswith(ANSWER_CLOSE + "\n"), len(ANSWER_CLOSE) + 1) \
        .when(body.endswith(ANSWER_CLOSE), len(ANSWER_CLOSE))
    ok = ((close > 0)
          & (F.instr(head, THINK_OPEN) == 0)
          & (F.substring(body, close, len(sep)) == sep)
          & tail_len.isNotNull()
          & (n - tail_len >= close - 1 + len(sep)))
    return F.when(F.coalesce(ok, F.lit(False)), 1.0).otherwise(0.0)


# RWD-6 ---------------------------------------------------------------
_BINARY: dict[str, Callable] = {"+": operator.add, "-": operator.sub, "*": operator.mul, "/": operator.truediv,
                                "//": operator.floordiv, "%": operator.mod}
_RANK = {"+": 1, "-": 1, "*": 2, "/": 2, "//": 2, "%": 2, "u+": 3, "u-": 3, "**": 4}
_LEXEME = re.compile(r"\s*(?:(\d+\.\d*|\.\d+|\d+)|(\*\*|//|[-+*/%()]))", re.ASCII)
# By default, an integer power whose result would have more bits than this is an error.
MAX_POWER_BITS = 1 << 22


def _power(a, b, max_bits: int | None):
    if max_bits is not None and isinstance(a, int) and isinstance(b, int) and b > 0 and a not in (-1, 0, 1) \
            and a.bit_length() * b > max_bits:
        raise OverflowError("power too large")
    return a ** b


def _number(lexeme: str):
    if "." in lexeme:
        return float(lexeme)
    if len(lexeme) > 1 and lexeme[0] == "0" and lexeme.strip("0"):
        raise ValueError("leading zero")
    return int(lexeme)


def _lexemes(expr: str):
    at, expr = 0, expr.rstrip()
    while at < len(expr):
        m = _LEXEME.match(expr, at)
        if m is None:
            raise ValueError("not arithmetic")
        at = m.end()
        yield m.group(1), m.group(2)


def evaluate_arithmetic(expr: str, max_power_bits: int | None = MAX_POWER_BITS) -> float | None:
    """Value of an arithmetic expression made of numbers, ``+ - * / // % **``,
    unary signs and parentheses; None for anything else or any error.

    Two explicit stacks, so neither length nor nesting is limited; only an
    integer power's result is (``max_power_bits``; None evaluates every
    power exactly, in time and memory of its size)."""
    if expr is None:
        return None
    values, ops = [], []

    def apply():
        op = ops.pop()
        right = values.pop()
        if op == "u-":
            values.append(-right)
        elif op == "u+":
            values.append(+right)
        elif op == "**":
            values.append(_power(values.pop(), right, max_power_bits))
        else:
            values.append(_BINARY[op](values.pop(), right))

    try:
        operand = True  # whether an operand comes next
        for number, sign in _lexemes(expr):
            if operand:
                if number is not None:
                    values.append(_number(number))
                    operand = False
                elif sign == "(":
                    ops.append(sign)
                elif sign in ("+", "-"):
                    ops.append("u" + sign)
                else:
                    return None
            elif sign == ")":
                while ops and ops[-1] != "(":
                    apply()
                if not ops:
                    return None
                ops.pop()
            elif sign is None or sign == "(":
                return None
            else:
                # ``**`` groups to the right, the rest to the left
                while ops and ops[-1] != "(" and (_RANK[ops[-1]] > _RANK[sign]
                                                  or (_RANK[ops[-1]] == _RANK[sign] and sign != "**")):
                    apply()
                ops.append(sign)
                operand = True
        if operand:
            return None
        while ops:
            if ops[-1] == "(":
                return None
            apply()
        v = values[0]
        if isinstance(v, complex):
            return None
        v = float(v)
        return v if math.isfinite(v) else None
    except (ArithmeticError, ValueError, TypeError):
        return None


def _evaluated(equation: Column, max_power_bits: int | None) -> Column:
    @F.pandas_udf(DoubleType())
    def run(exprs: pd.Series) -> pd.Series:
        cache: dict[str, float | None] = {None: None}
        for e in exprs.unique():
            cache[e] = evaluate_arithmetic(e, max_power_bits)
        return pd.Series([cache[e] for e in exprs], dtype="float64")

    return run(equation)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def answer_equation(completion: ColumnOrName) -> Column:
    """Stripped text of the first ``<answer>…</answer>`` on one line
    (after prefixing the think tag), NULL when there is none."""
    s = F.concat(F.lit(THINK_OPEN), _c(completion))
    # one regex pass: the first whole match (NULL when none), tags cut off
    m = F.regexp_substr(s, F.lit(X.py_regex(r"<answer>.*?</answer>")))
    return _bound(m, lambda x: X.strip(F.substring(x, len(ANSWER_OPEN) + 1, F.length(x) - len(ANSWER_OPEN) - len(ANSWER_CLOSE))))


def equation_gates(equation: ColumnOrName, nums: ColumnOrName) -> Column:
    """Native checks before evaluation: the integers used are exactly
    ``nums`` (as a multiset) and only digits, operators, parentheses, dots
    and blanks occur."""
    eq = _c(equation)
    wanted = F.array_sort(_c(nums).cast("array<bigint>"))
    used = F.transform(X.find_all(eq, r"\d+"), lambda d: d.try_cast("bigint"))
    same = _bound(used, lambda u: F.forall(u, lambda n: n.isNotNull()) & (F.array_sort(u) == wanted))
    charset = eq.rlike(r"(?d)^[\d+\-*/().\s]+$")
    return F.coalesce(eq.isNotNull() & charset & same, F.lit(False))


def equation_value(completion: ColumnOrName, target: ColumnOrName, nums: ColumnOrName, tol: float = 1e-5,
                   max_power_bits: int | None = MAX_POWER_BITS) -> Column:
    """1.0 when the answer uses each number once and evaluates to the
    target within ``tol``; else 0.0. Only gated rows reach Python: the
    others send NULL. ``max_power_bits`` as in :func:`evaluate_arithmetic`."""
    v = _evaluated(_bound(answer_equation(completion), lambda eq: F.when(equation_gates(eq, nums), eq)), max_power_bits)
    return F.when(F.coalesce(F.abs(v - _c(target).cast("double")) < tol, F.lit(False)), 1.0).otherwise(0.0)


def equation_reward(df: DataFrame, completion: str, target: str, nums: str,
                    out: str = "equation_reward", tol: float = 1e-5,
                    max_power_bits: int | None = MAX_POWER_BITS) -> DataFrame:
    """``df`` with :func:`equation_value` as column ``out``."""
    return df.withColumn(out, equation_value(completion, target, nums, tol, max_power_bits))


# RWD-7 ---------------------------------------------------------------
def rewards(df: DataFrame, fns: dict[str, Callable[[DataFrame], Column]],
            total: str | None = "reward") -> DataFrame:
    """Apply several reward functions, one column each, plus their sum.
    A function gets the frame (completion, target, numbers, ...) and
    returns a Column."""
    out = df.withColumns({name: fn(df) for name, fn in fns.items()})
    if total:
        out = out.withColumn(total, sum((F.col(n) for n in fns), F.lit(0.0)))
    return out


# UDF-5 ---------------------------------------------------------------
def reward_udf(fn: Callable[..., Sequence[float]], *fields: str):
    """Wrap a user reward ``fn(completions, **fields)`` over a batch as an
    Arrow-batched Column function of the completion and the fields'
    columns, in that order (for example ``target`` and ``nums``). Every
    argument is a pandas Series."""
    @F.pandas_udf(DoubleType())
    def run(*columns: pd.Series) -> pd.Series:
        return pd.Series(fn(columns[0], **dict(zip(fields, columns[1:], strict=True))), dtype="float64")

    return run


# WIN-3 ---------------------------------------------------------------
def group_advantage(df: DataFrame, key: str, reward: str, eps: float = 1e-4,
                    out: str = "advantage") -> DataFrame:
    """(reward − group mean) / (group sample std + eps).

    Group statistics are a partial aggregate joined back on the key (AQE
    splits a skewed key on the big side), not a window that would put a
    whole group into one task."""
    stats = df.groupBy(key).agg(F.avg(reward).alias("_tm_mu"), F.stddev_samp(reward).alias("_tm_sd"))
    stats = stats.withColumnRenamed(key, "_tm_key")
    # rows without a key are a group as well
    j = df.join(stats, df[key].eqNullSafe(stats["_tm_key"])).drop("_tm_key")
    return j.withColumn(out, (F.col(reward) - F.col("_tm_mu")) / (F.col("_tm_sd") + F.lit(eps))) \
        .drop("_tm_mu", "_tm_sd")
