"""Registry of named queries over the driver tables and their SQL oracles.

``@query(name, sql)`` registers a ``(spark, sf_dir) -> DataFrame``
builder and, when the operator is expressible in plain SQL, the text a
second engine runs on the same tables (derived shapes come from
``tables.views_sql()``). Output columns are aliased identically on both
sides; doubles are rounded to 6 decimals and arrays rendered as text so
results compare value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.plans.tables import views_sql

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            if views:
                body = sql.lstrip()
                if body[:4].upper() == "WITH":
                    body = "," + body[4:]
                else:
                    body = "\n" + body
                ORACLE[name] = views_sql().rstrip().rstrip("\n") + body
            else:
                ORACLE[name] = sql
        return fn
    return deco


def r6(c: Column | str) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), 6)


def arr_text(c: Column | str, sep: str = ",") -> Column:
    """Array of scalars as ``a,b,c`` (SQL: ``array_to_string``)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.transform(col, lambda x: x.cast("string")), sep, "null")


def msgs_text(c: Column | str) -> Column:
    """Message array as ``role:content`` joined by ``|``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.transform(col, lambda m: F.concat(m["role"], F.lit(":"), m["content"])),
                        "|")


def load_all() -> None:
    """Import every query module (registration happens on import)."""
    from tokenmill.plans import (  # noqa: F401
        q_exact,
        q_functions,
        q_metrics,
        q_ranges,
        q_records,
        q_retrieval,
        q_rewards,
        q_runs,
        q_sample,
        q_sets,
        q_streams,
        q_tokens,
    )
