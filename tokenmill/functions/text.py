"""Scalar Column functions (string, array, math, JSON) — SCA-*.

Every function takes Columns (or names) and returns a Column built from
native Spark expressions, so it stays inside whole-stage codegen.
Regex conventions: patterns get the ``(?d)`` flag so ``$`` and ``.``
treat only ``\\n`` as a line end, as Python's ``re`` does (Java would
also stop at ``\\r``, ``\\u0085``, ``\\u2028``). ``\\d``, ``\\s``, ``\\b``
are ASCII classes (documented difference to Python's Unicode classes).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_regex(pattern: str) -> str:
    """Java pattern with Python-like line-end semantics (G-2)."""
    return pattern if pattern.startswith("(?d)") else "(?d)" + pattern


# SCA-1 ---------------------------------------------------------------
def strip(x: ColumnOrName) -> Column:
    """Remove whitespace at both ends (``str.strip``; ``trim`` only drops blanks)."""
    return F.regexp_replace(_c(x), r"^\s+|\s+$", "")


# SCA-2 ---------------------------------------------------------------
def split_part_if(x: ColumnOrName, sep: str, index: int, min_parts: int = 3) -> Column:
    """Part ``index`` (0-based) of ``x`` split on the literal ``sep`` when
    there are at least ``min_parts`` parts, else ``x`` unchanged."""
    parts = F.split(_c(x), _quote(sep))
    return F.when(F.size(parts) >= min_parts, F.get(parts, index)).otherwise(_c(x))


def _quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\-/" else ch for ch in s)


# SCA-3 ---------------------------------------------------------------
def find_all(x: ColumnOrName, pattern: str) -> Column:
    """All non-overlapping matches of ``pattern`` (group 0)."""
    return F.regexp_extract_all(_c(x), F.lit(py_regex(pattern)), F.lit(0))


def last_match(x: ColumnOrName, pattern: str) -> Column:
    """Last match of ``pattern`` or NULL when there is none."""
    return F.try_element_at(find_all(x, pattern), F.lit(-1))


# SCA-4 ---------------------------------------------------------------
def search_group(x: ColumnOrName, pattern: str, group: int = 1) -> Column:
    """First match's capture group, NULL when the pattern does not occur
    (``re.search(...).group(g)``)."""
    p = py_regex(pattern)
    return F.when(_c(x).rlike(p), F.regexp_extract(_c(x), p, group))


# SCA-5 ---------------------------------------------------------------
def full_match(x: ColumnOrName, pattern: str) -> Column:
    return _c(x).rlike(py_regex("^(?:" + pattern + ")$"))


def prefix_match(x: ColumnOrName, pattern: str) -> Column:
    """``re.match``: anchored at the start only."""
    return _c(x).rlike(py_regex("^(?:" + pattern + ")"))


# SCA-6 ---------------------------------------------------------------
def replace_text(x: ColumnOrName, old: str, new: str) -> Column:
    return F.replace(_c(x), F.lit(old), F.lit(new))


def prefix(x: ColumnOrName, n: int) -> Column:
    return F.substring(_c(x), 1, n)


def last_path_segment(x: ColumnOrName, sep: str = "/") -> Column:
    return F.substring_index(_c(x), sep, -1)


# SCA-7 ---------------------------------------------------------------
def ends_with(x: ColumnOrName, suffix: str) -> Column:
    return _c(x).endswith(suffix)


def starts_with(x: ColumnOrName, pre: str) -> Column:
    return _c(x).startswith(pre)


# SCA-8 ---------------------------------------------------------------
def empty_to(x: ColumnOrName, replacement: str) -> Column:
    return F.when(_c(x) == "", F.lit(replacement)).otherwise(_c(x))


# SCA-10 / SCA-11 ------------------------------------------------------
def all_but_last(arr: ColumnOrName) -> Column:
    a = _c(arr)
    return F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))


def last_element(arr: ColumnOrName) -> Column:
    return F.try_element_at(_c(arr), F.lit(-1))


def last_where(arr: ColumnOrName, pred) -> Column:
    """Last element satisfying ``pred`` (searching backwards), else NULL."""
    return F.try_element_at(F.filter(_c(arr), pred), F.lit(-1))


def same_multiset(a: ColumnOrName, b: ColumnOrName) -> Column:
    return F.array_sort(_c(a)) == F.array_sort(_c(b))


# SCA-12 ---------------------------------------------------------------
def to_int(x: ColumnOrName) -> Column:
    return _c(x).try_cast("bigint")


def to_float(x: ColumnOrName) -> Column:
    return _c(x).try_cast("double")


def close_to(a: ColumnOrName, b: ColumnOrName, tol: float = 1e-5) -> Column:
    return F.abs(_c(a) - _c(b)) < F.lit(tol)


# SCA-13 ---------------------------------------------------------------
def argmax(scores: ColumnOrName) -> Column:
    """0-based index of the largest score (first on ties)."""
    s = _c(scores)
    return (F.array_position(s, F.array_max(s)) - 1).cast("int")


# SCA-14 ---------------------------------------------------------------
def round_up_to(x: ColumnOrName, m: int) -> Column:
    """Smallest multiple of ``m`` that is >= ``x`` (integer arithmetic)."""
    return F.floor((_c(x).cast("bigint") + F.lit(m - 1)) / F.lit(m)).cast("bigint") * F.lit(m)


# SCA-15 ---------------------------------------------------------------
def json_number(x: ColumnOrName, path: str) -> Column:
    """Numeric field out of a JSON text; NULL when absent or not a number."""
    return F.get_json_object(_c(x), path).try_cast("double")


# SCA-16 ---------------------------------------------------------------
def truncate_vector(v: ColumnOrName, dim: int | Column) -> Column:
    d = dim if isinstance(dim, Column) else F.lit(dim)
    return F.slice(_c(v), 1, d)


def dot(a: ColumnOrName, b: ColumnOrName) -> Column:
    return F.aggregate(
        F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0), lambda acc, v: acc + v)


def norm(a: ColumnOrName) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0),
                              lambda acc, v: acc + v.cast("double") * v.cast("double")))


def cosine(a: ColumnOrName, b: ColumnOrName) -> Column:
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


# SCA-18 ---------------------------------------------------------------
# Unit suffix -> factor to milliseconds.
UNIT_TO_MS = {"s": 1000.0, "ms": 1.0, "µs": 0.001, "us": 0.001, "ns": 0.000001}


def parse_timings(line: ColumnOrName) -> Column:
    """``key="12.3ms"`` pairs of a log line -> map key -> milliseconds."""
    pair = r'([A-Za-z_]+)="([0-9.]+)(s|ms|µs|us|ns)"'
    keys = F.regexp_extract_all(_c(line), F.lit(pair), F.lit(1))
    nums = F.regexp_extract_all(_c(line), F.lit(pair), F.lit(2))
    units = F.regexp_extract_all(_c(line), F.lit(pair), F.lit(3))
    factor = F.create_map(*[e for k, v in UNIT_TO_MS.items() for e in (F.lit(k), F.lit(v))])
    ms = F.zip_with(nums, units,
                    lambda n, u: n.try_cast("double") * F.element_at(factor, u))
    return F.map_from_arrays(keys, ms)


def lower_bound(sorted_arr: ColumnOrName, v: ColumnOrName, max_len: int) -> Column:
    """Number of elements of an ascending array that are ``< v``: a binary
    search as a fixed ``aggregate`` loop of ``ceil(log2(max_len + 1))``
    steps (arrays up to ``max_len`` long)."""
    a, x = _c(sorted_arr), _c(v)
    steps = max(1, int(max_len).bit_length())

    def step(acc, _):
        lo, hi = acc["lo"], acc["hi"]
        mid = F.floor((lo + hi) / 2).cast("int")
        go_right = (lo < hi) & (F.try_element_at(a, mid + 1) < x)
        go_left = (lo < hi) & ~go_right
        return F.struct(F.when(go_right, mid + 1).otherwise(lo).alias("lo"),
                        F.when(go_left, mid).otherwise(hi).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.size(a).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda acc: acc["lo"])
