"""Near-duplicate vectors by Euclidean p-stable hashing.

Equal vectors form a class first; only one vector per class goes on. Each
is normalised and hashed in several tables: ``k`` Gaussian projections with
a random shift, quantised to steps of ``WIDTH``. ``k`` follows the number of
classes, so that a random far vector shares a bucket about ``STRAY`` times
per table at any size, and the number of tables follows from the collision
chance of vectors just at the threshold and the ``recall`` asked for.
Vectors that share a bucket are compared by their exact cosine in double
precision. A pair that meets in several tables counts in the first of them.
Buckets beyond ``BLOCK`` members are cut into blocks that are compared pair
by pair of blocks in separate tasks; only counts and local roots leave a
task, never pairs.

Edge cases: vectors that are null, empty or zero, or hold null or
non-finite components, link with nothing and are their own component;
vectors of different lengths never link; repeated rows are vectors of
their own; a null id keeps its row (not kept, component of the smallest id
it links with, else null); an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.common import arrow_map, written
from tokenmill.llm.components import components

COSINE = 0.95
WIDTH = 2.0
STRAY = 0.125
RECALL = 0.99
BLOCK = 512
SEED = 711


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that one quantised Gaussian projection agrees for two vectors at ``distance``."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_plan(n: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(projections per table, tables) for ``n`` vectors."""
    near, far = collision(math.sqrt(max(1e-12, 2 - 2 * cosine))), collision(math.sqrt(2))
    k = max(4, math.ceil(math.log(max(n, 2) / STRAY) / -math.log(far)))
    return k, math.ceil(math.log(1 - recall) / math.log(1 - near ** k))


def usable(v) -> np.ndarray | None:
    """The vector as doubles, or None if it links with nothing."""
    if not v or any(x is None for x in v):
        return None
    a = np.asarray(v, np.float64)
    return a + 0.0 if np.isfinite(a).all() and a.any() else None


def normalised(a: np.ndarray) -> np.ndarray:
    a = a / np.abs(a).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return a / np.sqrt((a * a).sum(axis=1, keepdims=True))


def buckets(x: np.ndarray, k: int, tables: int) -> np.ndarray:
    """Bucket numbers (int32), one row per vector and one column per table."""
    rng = np.random.default_rng([SEED, x.shape[1], k, tables])
    proj = rng.standard_normal((x.shape[1], tables * k))
    q = np.floor((x @ proj + rng.uniform(0, WIDTH, tables * k)) / WIDTH).astype(np.int64).reshape(len(x), tables, k)
    odd = rng.integers(1, 1 << 62, k).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    with np.errstate(over="ignore"):
        h = (q.astype(np.uint64) * odd).sum(axis=2, dtype=np.uint64)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)


def link_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE,
                 recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``df``."""
    cols = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))
    kind = cols.schema["vec_id"].dataType.simpleString()

    def keyed(ids, vectors):
        good = [usable(v) for v in vectors]
        return (ids, [None if a is None else xxhash.xxh3_128_digest(a.tobytes()) for a in good],
                [None if a is None else a.tobytes() for a in good])

    rows = written(arrow_map(cols, keyed, f"vec_id {kind}, key binary, vector binary"), "vectors")
    classes = written(rows.where("key is not null").groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"), F.first("vector").alias("vector")), "classes")
    k, tables = table_plan(classes.count(), cosine, recall)

    def hashed(keys, sizes, vectors):
        out_b = [None] * len(keys)
        by_dim: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            by_dim.setdefault(len(v) // 8, []).append(i)
        for members in by_dim.values():
            x = normalised(np.stack([np.frombuffer(vectors[i]) for i in members]))
            for i, b in zip(members, buckets(x, k, tables), strict=True):
                out_b[i] = b.tolist()
        return keys, sizes, vectors, out_b

    marked = written(arrow_map(classes.select("key", "n", "vector"), hashed,
                               "key binary, n long, vector binary, marks array<int>"), "marks")
    spots = marked.select("key", F.octet_length("vector").alias("dim"), F.posexplode("marks").alias("table", "bucket"))
    place = ["dim", "table", "bucket"]
    shared = spots.groupBy(*place).count().where("count > 1")
    # a member of block i of m meets the blocks i..m-1 as the left side and 0..i as the right side
    m = F.ceil(F.col("count") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("key"), F.col("m")).cast("int")
    meets = (spots.join(shared, place).withColumn("m", m).withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
             .select("key", *place, "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        table, i, j = int(pdf["table"].iloc[0]), pdf["i"].iloc[0], pdf["j"].iloc[0]
        x = normalised(np.stack([np.frombuffer(v) for v in pdf["vector"]]))
        marks, n, keys = np.stack(pdf["marks"].to_numpy()), pdf["n"].to_numpy(), pdf["key"].to_numpy()
        left = np.flatnonzero(pdf["block"].to_numpy() == i)
        right = left if i == j else np.flatnonzero(pdf["block"].to_numpy() == j)
        links, root = np.zeros(len(pdf), np.int64), np.arange(len(pdf))

        def find(a: int) -> int:
            while root[a] != a:
                root[a] = a = root[root[a]]
            return a

        a, b = np.nonzero(x[left] @ x[right].T >= cosine) if len(left) and len(right) else ((), ())
        a, b = left[np.asarray(a, int)], right[np.asarray(b, int)]
        once = a < b if i == j else np.ones(len(a), bool)
        a, b = a[once], b[once]
        first = ~(marks[a, :table] == marks[b, :table]).any(axis=1) if table else np.ones(len(a), bool)
        a, b = a[first], b[first]  # the others were counted and joined in an earlier table
        np.add.at(links, a, n[b])
        np.add.at(links, b, n[a])
        for p, q in zip(a.tolist(), b.tolist(), strict=True):
            p, q = find(p), find(q)
            if p != q:
                root[max(p, q, key=lambda z: keys[z])] = min(p, q, key=lambda z: keys[z])
        tops = [keys[find(z)] for z in range(len(pdf))]
        keep = np.array([links[z] > 0 or tops[z] != keys[z] for z in range(len(pdf))], bool)
        return pd.DataFrame({"a": keys[keep], "b": np.array(tops, object)[keep], "links": links[keep]})

    found = written(meets.join(marked, "key").groupBy(*place, "i", "j").applyInPandas(
        compare, "a binary, b binary, links long"), "links")
    roots = components(found.select("a", "b"))
    links = found.groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    known = (classes.select("key", "n", "least").join(links, "key", "left")
             .join(roots.withColumnRenamed("node", "key"), "key", "left")
             .withColumn("root", F.coalesce("root", "key")))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(least, "root").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "key").join(known, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
