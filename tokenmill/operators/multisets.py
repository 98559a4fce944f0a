"""Multiset intersection and difference of tables (SET-2).

Rows of any type, nested ones and maps included, are compared by the
SHA-256 of their canonical bytes and counted on both sides in one
aggregation; equal rows combine before the shuffle, so a row that makes up
a third of a table is one partial count a task. Each row carries a second
hash of other kind; two rows of one digest that differ in it end the query with an error.

Nulls equal nulls, at any depth, and differ from empty values. Doubles:
NaN equals NaN, -0.0 equals 0.0. Maps are equal when their entries are, in
any order. Both tables need the same column names and types; the result
has the left one's columns, in its order. Rows that are wanted many times
are made in pieces of ``PIECE`` copies that spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIECE = 10_000


def canonical(c: Column, kind: T.DataType) -> Column:
    """A string that is equal for equal values of a type only: every value as its length and text,
    every list as its number of entries and their strings; ``~`` is null."""
    def sized(s: Column) -> Column:
        return F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)

    if isinstance(kind, T.StructType):
        body = F.concat(F.lit("("), *[canonical(c[f.name], f.dataType) for f in kind.fields], F.lit(")"))
    elif isinstance(kind, T.ArrayType):
        body = F.concat(F.size(c).cast("string"), F.lit("["),
                        F.array_join(F.transform(c, lambda x: canonical(x, kind.elementType)), ""))
    elif isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.concat(canonical(e["key"], kind.keyType),
                                                                   canonical(e["value"], kind.valueType)))
        body = F.concat(F.size(c).cast("string"), F.lit("{"), F.array_join(F.array_sort(entries), ""))
    elif isinstance(kind, T.BinaryType):
        body = sized(F.hex(c))
    elif isinstance(kind, T.DoubleType | T.FloatType):
        body = sized(F.when(c == 0, F.lit("0")).otherwise(c.cast("string")))
    elif isinstance(kind, T.TimestampType):
        body = sized(F.unix_micros(c).cast("string"))  # local time repeats an hour each autumn
    else:
        body = sized(c.cast("string"))
    return F.when(c.isNotNull(), body).otherwise(F.lit("~"))


def _counted(left: DataFrame, right: DataFrame) -> DataFrame:
    """(digest, row, l, r): every different row of the left table with its counts in both."""
    kinds = {f.name: f.dataType for f in left.schema.fields}
    if len(kinds) != len(left.columns) or sorted(kinds) != sorted(right.columns):
        raise ValueError("both tables need the same columns, each name once")
    for f in right.schema.fields:
        if f.dataType.simpleString() != kinds[f.name].simpleString():
            raise ValueError(f"{f.name}: {kinds[f.name].simpleString()} and {f.dataType.simpleString()}")

    def side(df: DataFrame, mine: int) -> DataFrame:
        text = F.concat(F.lit(""), *[canonical(F.col(f"`{c}`"), k) for c, k in kinds.items()])
        row = F.struct(*[F.col(f"`{c}`") for c in kinds])
        return (df.select(text.alias("t"), (row if mine == 0 else F.lit(None).cast(df.select(row.alias("x")).schema["x"].dataType)).alias("row"))
                .select(F.sha2("t", 256).alias("digest"), F.xxhash64("t").alias("other"), "row",
                        F.lit(1 - mine).cast("long").alias("l"), F.lit(mine).cast("long").alias("r")))

    both = side(left, 0).unionByName(side(right, 1))
    one = both.groupBy("digest").agg(F.any_value("row", True).alias("row"), F.sum("l").alias("l"), F.sum("r").alias("r"),
                                     F.min("other").alias("low"), F.max("other").alias("high"))
    checked = F.when(F.col("low") == F.col("high"), F.col("l")).otherwise(
        F.raise_error(F.lit("different rows share a digest")).cast("long"))
    return one.select("digest", "row", checked.alias("l"), "r").where("l > 0")


def _copies(rows: DataFrame, n: Column) -> DataFrame:
    """Each row ``n`` times, made in pieces that may go to different tasks."""
    some = rows.select("digest", "row", n.alias("n")).where("n > 0")
    step = F.lit(PIECE).cast("long")
    pieces = some.select("digest", "row", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, step)).alias("at"))
    # only rows of more than one piece are dealt out; the others stay where they are
    few, many = pieces.where(F.col("n") <= PIECE), pieces.where(F.col("n") > PIECE).repartition("digest", "at")
    sized = few.unionByName(many).select("row", F.least(F.col("n") - F.col("at"), step).alias("n"))
    return sized.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select("row.*")


def intersect_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every row as often as in the table that has it less often."""
    return _copies(_counted(left, right), F.least("l", "r"))


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every row of ``left`` as often as it has it more often than ``right``."""
    return _copies(_counted(left, right), F.col("l") - F.col("r"))


def intersect_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """The different rows that both tables have."""
    return _counted(left, right).where("r > 0").select("row.*")


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """The different rows of ``left`` that ``right`` has not."""
    return _counted(left, right).where("r = 0").select("row.*")
