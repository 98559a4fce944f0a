"""Whitening of embeddings from an exact, bit-sliced scatter matrix.

Entries become whole numbers, ``x = floor(256 c)``, and every distinct
vector counts once (the fit list). A task shifts each dimension of a chunk
of vectors to start at zero, cuts the shifted values into bit planes and
packs a plane's bits across the rows into 64-bit words. The sum of products
of two dimensions is then a weighted sum of set bits,

    sum(y_a * y_b) = sum over p, q of 2^(p+q) * popcount(plane_a_p & plane_b_q),

exact at any width. Un-shifting, the totals over tasks and the centring
``n * sum(x_a x_b) - S_a S_b`` stay in whole numbers (32-bit limbs summed by
Spark, whole numbers of any size on the driver); only the centred matrix is
rounded to doubles for ``eigh``. Where the spectrum falls by more than
``GAP``, the small part is projected exactly and solved again, so that a
dimension of large scale doesn't drown the rest.

The driver holds matrices of dimensions x dimensions, never rows.

Edge cases: a null vector and one with null or non-finite entries is left
out; shorter vectors (an empty one too) count as ending in zeros; entries
beyond the range of a long saturate; repeated rows are fitted once and all
returned; null and repeated ids stay as they are; fewer dimensions than
components give fewer components; where a component has no variance
(one distinct vector, say) ``whitened`` is null, and ``explained`` is null
where there is no variance at all; a ``deviation`` that no long can hold is
null there and stands in ``deviation_digits``; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.common import written

SCALE = 256
COMPONENTS = 4
CHUNK = 8192  # vectors whose planes are packed together
LIMB = 32
GAP = 1e-6  # eigenvalues below this share of the largest are solved again
LONG = 1 << 63


def quantised(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, x) of the rows whose vectors are whole; ``x`` has the width of the longest."""
    c = F.col(vec_col).cast("array<double>")
    odd = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    rows = df.select(F.col(id_col).alias("vec_id"), c.alias("c")).where(c.isNotNull() & ~odd)
    low, high = rows.agg(F.min(F.size("c")), F.max(F.size("c"))).first()
    x = F.transform("c", lambda v: F.floor(v * F.lit(float(SCALE))) + F.lit(0))
    if low != high:
        x = F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(high) - F.size("c")))
    return rows.select("vec_id", x.cast("array<long>").alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as rows of an array."""
    width = len(column[0]) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), width)


def planes(y: np.ndarray) -> np.ndarray:
    """Bit planes of unsigned ``y`` (rows x dimensions), packed across rows:
    dimensions x planes x words."""
    depth = max(1, int(y.max()).bit_length())
    rows = -(-len(y) // 64) * 64
    padded = np.zeros((rows, y.shape[1]), np.uint64)
    padded[:len(y)] = y
    out = np.empty((y.shape[1], depth, rows // 64), np.uint64)
    for p in range(depth):
        bits = ((padded >> np.uint64(p)) & np.uint64(1)).astype(np.uint8)
        out[:, p] = np.ascontiguousarray(np.packbits(bits, axis=0).T).view(np.uint64)
    return out


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, sums of products) of the columns of ``x``, whole numbers of any size."""
    low = x.min(axis=0)
    y = x.view(np.uint64) - low.view(np.uint64)  # wraps to the true distance, which fits 64 bits
    bits = planes(y)
    width, depth, words = bits.shape
    exact = np.int64 if 2 * depth + (64 * words).bit_length() <= 62 else object
    weight = np.array([1 << q for q in range(depth)], exact)
    own = np.bitwise_count(bits).sum(axis=2, dtype=np.int64).astype(exact) @ weight
    cross = np.zeros((width, width), object)
    for a in range(width):
        row = np.zeros(width - a, exact)
        for p in range(depth):
            met = np.bitwise_count(bits[a:] & bits[a, p]).sum(axis=2, dtype=np.int64)
            row = row + (met.astype(exact) @ weight) * weight[p]
        cross[a, a:] = row
        cross[a:, a] = row
    own, low = own.astype(object), low.astype(object)
    n = len(x)
    return own + n * low, cross + np.outer(low, own) + np.outer(own, low) + n * np.outer(low, low)


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """(k, limb) with ``value = sum(limb << (LIMB * k))``; the last limb has the sign."""
    k = 0
    while not -(1 << LIMB - 1) <= value < 1 << LIMB - 1:
        yield k, value & ((1 << LIMB) - 1)
        value >>= LIMB
        k += 1
    if value or not k:
        yield k, value


def chunks(batches, rows: int) -> Iterator[np.ndarray]:
    for b in batches:
        x = matrix(b.column(0))
        for at in range(0, len(x), rows):
            yield x[at:at + rows]


@dataclass
class Whitening:
    """Fit of ``n`` vectors: sums, unit eigenvectors (columns) and eigenvalues
    by falling size, and the trace of the covariance."""
    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float | None = None

    def bound(self, x: np.ndarray) -> int:
        """No entry of ``n x - S`` is larger."""
        most = max(int(x.max()), -int(x.min())) if x.size else 0
        return self.n * most + max(map(abs, self.sums), default=0)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows; columns without variance are NaN."""
        if self.bound(x) < LONG:
            centred = (self.n * x - np.array(self.sums, np.int64)) / self.n
        else:
            centred = ((self.n * x.astype(object) - np.array(self.sums, object)) / self.n).astype(np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, centred @ self.vectors / np.sqrt(self.values), np.nan)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sum over dimensions of ``(n x - S)^2``, exact."""
        if x.shape[1] * self.bound(x) ** 2 < LONG:
            d = self.n * x - np.array(self.sums, np.int64)
            return (d * d).sum(axis=1)
        d = self.n * x.astype(object) - np.array(self.sums, object)
        return (d * d).sum(axis=1)


def eigen(centred: np.ndarray, square: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit eigenvectors (columns) and eigenvalues, falling, of the whole
    numbers ``centred / square``; at least the first ``wanted`` are solved
    to double precision whatever their scale."""
    width = len(centred)
    vectors, values, done = np.eye(width), np.zeros(width), 0
    part, scale = centred, square
    while done < width:
        v = np.array([[int(c) / scale for c in row] for row in part], np.float64)
        e, q = np.linalg.eigh((v + v.T) / 2)
        e, q = e[::-1], q[:, ::-1]
        vectors[:, done:] = vectors[:, done:] @ q
        values[done:] = e
        settled = int((e > GAP * max(e[0], 0.0)).sum())
        done += settled
        if not settled or done >= min(wanted, width):
            break
        left = np.array([[round(t * (1 << 53)) for t in row] for row in vectors[:, done:]], object)
        part, scale = left.T @ centred @ left, square << 106
    # exact projections of directions without variance are squares of rounding errors
    values[values < 1e-24 * values.max(initial=0.0)] = 0.0
    return vectors, np.maximum(values, 0.0)


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit over the rows of ``distinct(x)``; None where there are none."""
    def run(batches):
        n, sums, cross = 0, 0, 0
        for x in chunks(batches, CHUNK):
            s, c = scatter(x) if x.shape[1] else (np.zeros(0, object), np.zeros((0, 0), object))
            n, sums, cross = n + len(x), sums + s, cross + c
        if n:
            entries = [(-1, -1, n), *((a, -1, int(v)) for a, v in enumerate(sums)),
                       *((a, b, int(cross[a, b])) for a in range(len(sums)) for b in range(a, len(sums)))]
            rows = [(a, b, k, v) for a, b, value in entries for k, v in limbs(value)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["a", "b", "k", "v"])

    # dimensions x dimensions sums, whatever the number of vectors
    total: dict[tuple[int, int], int] = {}
    for r in distinct.select("x").mapInArrow(run, "a int, b int, k int, v long").groupBy("a", "b", "k").agg(
            F.sum("v").alias("v")).collect():
        total[r["a"], r["b"]] = total.get((r["a"], r["b"]), 0) + (r["v"] << (LIMB * r["k"]))
    n = total.pop((-1, -1), 0)
    if not n:
        return None
    width = sum(1 for _, b in total if b == -1)
    sums = [total[a, -1] for a in range(width)]
    centred = np.empty((width, width), object)
    for a in range(width):
        for b in range(a, width):
            centred[a, b] = centred[b, a] = n * total[a, b] - sums[a] * sums[b]
    vectors, values = eigen(centred, n * n, components)
    keep = min(components, width)
    trace = sum(centred[a, a] for a in range(width)) / (n * n)
    return Whitening(n, sums, vectors[:, :keep], values[:keep], trace)


def identity_error(distinct: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity, as measured."""
    some = np.flatnonzero(model.values > 0)
    k = len(some)
    if not k:
        return None

    def run(batches):
        first, second = np.zeros(k), np.zeros((k, k))
        for x in chunks(batches, CHUNK):
            w = model.project(x)[:, some]
            first += w.sum(axis=0)
            second += w.T @ w
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(k + k * k), pa.int32()),
                                          "v": pa.array(np.concatenate([first, second.ravel()]))})

    got = distinct.select("x").mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(k + k * k)
    for r in got:
        flat[r["at"]] = r["v"]
    mean = flat[:k] / model.n
    return float(np.abs(flat[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: ``vec_id, component, n, deviation,
    deviation_digits, whitened, explained, identity_error``."""
    rows = quantised(df, id_col, vec_col)
    distinct = written(rows.select("x").distinct(), "fit")
    model = fit(distinct, components)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, deviation_digits string, whitened double, "
              "explained double, identity_error double")
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    model.identity_error = identity_error(distinct, model)
    count = len(model.values)
    explained = [float(e / model.trace) if model.trace > 0 else None for e in model.values]

    def run(batches):
        for b in batches:
            for at in range(0, len(b), CHUNK):
                part = b.slice(at, CHUNK)
                x = matrix(part.column(1))
                if not len(x):
                    continue
                dev = model.deviations(x).tolist() if x.shape[1] else [0] * len(x)
                w = model.project(x).ravel()
                each = np.repeat(np.arange(len(x)), count)
                held = pa.array([d if d < LONG else None for d in dev], pa.int64())
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), model.n)),
                    held.take(pa.array(each)),
                    pa.array([str(d) for d in dev]).take(pa.array(each)),
                    pa.array(w, mask=np.isnan(w)),
                    pa.array(explained * len(x), pa.float64()),
                    pa.array([model.identity_error] * len(each), pa.float64())],
                    ["vec_id", "component", "n", "deviation", "deviation_digits", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
