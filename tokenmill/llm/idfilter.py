"""A bounded bit filter of 64-bit keys, sent to the workers to pick rows early.

False positives only let more rows through to the exact join behind it, so
results never depend on the filter; its size is a constant.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

FILTER_BITS = 1 << 24
TASKS = 8


class KeyFilter:
    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(keys: np.ndarray) -> list[np.ndarray]:
        u = keys.astype(np.int64).view(np.uint64)
        with np.errstate(over="ignore"):
            h = (u ^ (u >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return [(h >> np.uint64(s)) % np.uint64(FILTER_BITS) for s in (8, 36)]

    @classmethod
    def build(cls, keys: DataFrame) -> KeyFilter:
        """The filter of the one long column of ``keys`` (nulls are left out)."""
        def mark(batches):
            flags = np.zeros(FILTER_BITS, bool)
            for b in batches:
                for at in cls.places(b.column(0).drop_null().to_numpy(zero_copy_only=False)):
                    flags[at] = True
            yield pa.RecordBatch.from_pydict({"bits": pa.array([np.packbits(flags, bitorder="little").tobytes()])})

        # TASKS constant-size bit sets, whatever the number of keys
        parts = keys.coalesce(TASKS).mapInArrow(mark, "bits binary").collect()
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for r in parts:
            bits |= np.frombuffer(r[0], np.uint8)
        return cls(bits)

    def hits(self, column: pa.Array) -> np.ndarray:
        """Whether each key may be in the filter (false for null)."""
        keys = pc.fill_null(column, 0).to_numpy(zero_copy_only=False)
        out = pc.is_valid(column).to_numpy(zero_copy_only=False).copy()
        for at in self.places(keys):
            out &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def matching(df: DataFrame, column: str, keys: DataFrame, keep: bool = True) -> DataFrame:
    """Rows of ``df`` whose long ``column`` may be in ``keys`` (or, without
    ``keep``, is surely not)."""
    shared = df.sparkSession.sparkContext.broadcast(KeyFilter.build(keys))
    at = df.columns.index(column)

    def run(batches):
        for b in batches:
            hits = shared.value.hits(b.column(at))
            yield b.filter(pa.array(hits if keep else ~hits))

    return df.mapInArrow(run, df.schema)


def without(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``column`` is not in ``keys``: only rows that
    may be in ``keys`` are shuffled for the exact test. Null keys stay."""
    sure = matching(df, column, keys, keep=False)
    unsure = matching(df, column, keys).join(keys.toDF(column).distinct(), column, "left_anti")
    return sure.unionByName(unsure.select(*df.columns))
