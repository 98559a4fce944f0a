"""Helpers shared by the operators of this subpackage.

Texts are handled inside partitioned Spark tasks, one Arrow batch at a
time; nothing here keeps more than one batch. ``words`` is the word
definition of the contracts: A-Z lower-cased, split at ASCII white space.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from tokenmill.session import scratch_path

SHINGLE = 5
SIMILARITY_PCT = 75
_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and
    read back: later steps read it again without its lineage, and a lost
    executor re-reads files instead of recomputing."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    release()
    return spark.read.schema(df.schema).parquet(path)


SLICE_BYTES = 4 << 20
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give freed memory back at a task's end: a worker process lives on and
    runs tasks of later stages beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of at most ``limit`` bytes (a longer
    row alone): Python objects are made of one run at a time."""
    for b in batches:
        todo = [b]
        while todo:
            part = todo.pop()
            if part.num_rows > 1 and part.nbytes > limit:
                half = part.num_rows // 2
                todo += [part.slice(half), part.slice(0, half)]
            else:
                yield part


def arrow_map(df: DataFrame, fn: Callable[..., tuple], schema: str) -> DataFrame:
    """Map runs of rows (see ``slices``): ``fn`` gets one Python list per
    column of ``df`` and returns one sequence per column of ``schema`` (any
    number of rows). Empty runs give empty output."""
    st = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    target = to_arrow_schema(st)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            cols = fn(*[c.to_pylist() for c in b.columns])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(cols, target, strict=True)], schema=target)
            del cols
        release()

    return df.mapInArrow(run, st)


def held_out(id_col: str | Column, modulus: int, remainder: int) -> Column:
    """``crc32(id as text) mod modulus = remainder``; a null id is never held out."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string")) % F.lit(modulus) == F.lit(remainder), F.lit(False))


def words(text: str | None) -> list[bytes]:
    """Words of a text (UTF-8 bytes); null and blank texts have none."""
    # bytes.lower() changes A-Z only and bytes.split() cuts at \x20 and \x09-\x0D only
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


def word_hashes(ws: list[bytes]) -> np.ndarray:
    h = xxhash.xxh3_64_intdigest
    return np.fromiter(map(h, ws), dtype=np.uint64, count=len(ws))


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64): spreads every input bit."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_lists(texts: list[str | None], width: int = SHINGLE) -> list[np.ndarray]:
    """Per text the 64-bit hashes of its consecutive ``width``-word shingles
    in text order; a shorter text is one shingle of all its words, a text
    without words has none. All texts are hashed in one pass."""
    split = [words(t) for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    total = int(sizes.sum())
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(split)), np.uint64, total)
    ends = np.cumsum(sizes)
    with np.errstate(over="ignore"):
        rolled = np.full(max(0, total - width + 1), width, np.uint64)
        for i in range(width):
            rolled = rolled * _STEP + h[i:i + len(rolled)]
        rolled = mix(rolled)
        out = []
        for n, end in zip(sizes.tolist(), ends.tolist(), strict=True):
            if n >= width:
                out.append(rolled[end - n:end - width + 1])
            else:
                one = np.full(min(n, 1), n, np.uint64)
                for x in h[end - n:end]:
                    one = one * _STEP + x
                out.append(mix(one))
    return out


def shingle_sets(texts: list[str | None], width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    return [np.unique(x) for x in shingle_lists(texts, width)]


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    return shingle_sets([text], width)[0]


def spans_text(spans: Column) -> Column:
    """``array<struct<kind,start,end>>`` as ``kind:start:end,...``."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == F.lit(kind))).cast("long")
