"""Scans, sources and sinks (SRC-*, SNK-*).

Named datasets are Parquet directories under a root folder; a dataset
with splits is written ``partitionBy("split")`` so choosing a split is
partition pruning, not a filter after the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tokenmill.operators.offsets import hash_cut, hash_key


LOG_SEPARATOR = "\n\n==============\n"  # Fixed value: written before every logged text.


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of the file system that holds it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def _path(spark: SparkSession, name: str, root: str | None) -> str:
    if root is None or os.path.isabs(name) or "://" in name:
        return name
    p = os.path.join(root, name)
    return p + ".parquet" if exists(spark, p + ".parquet") else p


# SRC-1 --------------------------------------------------------------
def read_table(spark: SparkSession, name: str, split: str | None = None,
               root: str | None = None) -> DataFrame:
    """Load a named dataset; with ``split`` only that partition is read."""
    df = spark.read.parquet(_path(spark, name, root))
    if split is not None:
        df = df.where(F.col("split") == F.lit(split))
    return df


def spread(df: DataFrame, min_partitions: int) -> DataFrame:
    """``df``, dealt over ``min_partitions`` where its scan has fewer splits.

    A file of one row group is one task, and so is all per-row work behind
    it. A large table has more splits than that and stays as it is, without
    a shuffle; columns and filters are still pruned in the scan."""
    return df.repartition(min_partitions) if df.rdd.getNumPartitions() < min_partitions else df


# SRC-2 --------------------------------------------------------------
def read_splits(spark: SparkSession, name: str, config: str | None = None,
                root: str | None = None) -> DataFrame:
    """Every split of a dataset as one frame with a ``split`` column;
    ``config`` selects a named sub-folder (dataset configuration)."""
    base = _path(spark, name, root)
    if config:
        base = os.path.join(base, config)
    return spark.read.option("basePath", base).parquet(base)


# SRC-3 / SRC-5 ------------------------------------------------------
def read_jsonl(spark: SparkSession, paths: str | list[str], schema: StructType | str,
               min_partitions: int | None = None) -> DataFrame:
    """JSON-lines with an explicit schema (never inferred).

    Compressed ``*.json.gz`` shards are not splittable: each is one task,
    so ``min_partitions`` spreads the rows after the read.
    """
    df = spark.read.schema(schema).json(paths)
    if min_partitions:
        df = df.repartition(min_partitions)
    return df


# SRC-4 --------------------------------------------------------------
def resolve_source(spark: SparkSession, id_or_path: str, split: str | None = None,
                   schema: StructType | str | None = None,
                   root: str | None = None) -> DataFrame:
    """``*.json``/``*.jsonl``/``*.json.gz`` -> JSON reader, else named table + split."""
    lower = id_or_path.lower()
    if lower.endswith((".json", ".jsonl", ".json.gz", ".jsonl.gz")):
        if schema is None:
            raise ValueError("JSON sources need an explicit schema")
        return read_jsonl(spark, id_or_path, schema)
    return read_table(spark, id_or_path, split=split, root=root)


# SRC-6 --------------------------------------------------------------
def read_prepared(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    return read_table(spark, path, split=split)


# SRC-7 --------------------------------------------------------------
def read_images(spark: SparkSession, path: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """Binary files (images) as rows ``path, length, content BINARY``; the
    content stays an opaque column (read lazily, only when selected)."""
    r = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.load(path).select("path", "length", "content")


def write_files(df: DataFrame, path: str) -> None:
    """One text file for each row of ``df`` (one string column), all in one
    folder. Tasks move their own files into place: the driver would move
    them one by one."""
    (df.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
     .text(path))


# SRC-8 --------------------------------------------------------------
def list_lines(lines: DataFrame, col: str = "value", prefix: str = "- ") -> DataFrame:
    """Keep lines starting with ``prefix``; take the text after it."""
    c = F.col(col)
    return (lines.where(c.startswith(prefix))
            .select(F.substring(c, len(prefix) + 1, 1 << 30).alias("entry")))


def read_list_file(spark: SparkSession, path: str, prefix: str = "- ") -> DataFrame:
    return list_lines(spark.read.text(path), "value", prefix)


# SNK-1 --------------------------------------------------------------
def write_prepared(df: DataFrame, path: str, split_col: str = "split",
                   mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(split_col).parquet(path)


# SNK-2 --------------------------------------------------------------
def write_jsonl(df: DataFrame, path: str, ascii: bool = True, mode: str = "overwrite",
                compression: str | None = None) -> None:
    """One JSON object per line; non-ASCII escaped as ``\\uXXXX`` unless
    ``ascii=False``."""
    w = df.write.mode(mode).option("writeNonAsciiCharacterAsCodePoint", str(ascii).lower())
    if compression:
        w = w.option("compression", compression)
    w.json(path)


# SNK-3 --------------------------------------------------------------
def publish_name(generator: Column | str, source: Column | str, width: int = 40) -> Column:
    """``gen[:40]-src[:40]-candidates`` with ``/`` replaced by ``-``."""
    g = F.lit(generator) if isinstance(generator, str) else generator
    s = F.lit(source) if isinstance(source, str) else source

    def part(x):
        return F.substring(F.replace(x, F.lit("/"), F.lit("-")), 1, width)

    return F.concat(part(g), F.lit("-"), part(s), F.lit("-candidates"))


def publish(df: DataFrame, root: str, generator: str, source: str,
            mode: str = "overwrite") -> str:
    name = df.sparkSession.range(1).select(publish_name(generator, source)).first()[0]
    path = os.path.join(root, name)
    df.write.mode(mode).parquet(path)
    return path


# SNK-4 --------------------------------------------------------------
def sample_fraction(df: DataFrame, fraction: float, seed: str, *key: str) -> DataFrame:
    """Reproducible Bernoulli-like sample: rows whose md5 bucket is below
    ``fraction`` (same rows in any engine, on any recomputation)."""
    return df.where(hash_key(*key, seed=seed) < F.lit(hash_cut(fraction)))


def sample_log(df: DataFrame, path: str, text_col: str, fraction: float, seed: str,
               *key: str) -> None:
    """Append ~``fraction`` of the texts to a log folder."""
    (sample_fraction(df, fraction, seed, *key)
     .select(F.concat(F.lit(LOG_SEPARATOR), F.col(text_col)).alias("value"))
     .write.mode("append").text(path))


# SNK-5 --------------------------------------------------------------
def run_metrics(df: DataFrame, **fixed) -> DataFrame:
    """One-row metrics record: number of rows plus fixed fields."""
    out = df.agg(F.count(F.lit(1)).alias("train_samples"))
    for k, v in fixed.items():
        out = out.withColumn(k, F.lit(v))
    return out


def append_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").json(path)


# SNK-6 --------------------------------------------------------------
def from_rows(spark: SparkSession, rows: list[dict], schema: StructType | str) -> DataFrame:
    """Small tables from Python rows (tests and fixtures only)."""
    return spark.createDataFrame(rows, schema=schema)
