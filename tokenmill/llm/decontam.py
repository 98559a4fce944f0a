"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are partitioned by the number of their shingles (powers of
two). For a partition of items with up to S shingles, documents are read
as overlapping windows of 2 S shingles, so that a short item and the
window around its copy are of comparable size and their Jaccard similarity
stays well above zero however long the document is. Window and item are
candidates when any of ``PERMUTATIONS`` minima agree; minima of larger
windows are minima of smaller ones. A candidate is kept when the whole
document holds at least ``pct`` percent of the item's distinct shingles,
checked exactly.

Distinct item sets go to the workers in blocks of bounded size, and every
block meets all documents; documents are never shuffled. The ids of items
with equal sets are joined to the hits afterwards. An item or document of fewer
words than a shingle is one shingle of all its words. Edge cases: null and
empty texts hold nothing and are held by nothing; repeated rows give
repeated results; items without an id are reported with a null id; an
empty table gives an empty result; extra columns are ignored by
``find_contained`` and kept by ``decontaminate``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.common import SHINGLE, SIMILARITY_PCT, arrow_map, release, shingle_lists, shingle_sets, slices

PERMUTATIONS = 64
BLOCK_BYTES = 16 << 20  # of item shingles sent to the workers at once
SLICE_SHINGLES = 400_000
SEED = 20_24


def permutations(n: int = PERMUTATIONS) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(1, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)


def size_class(n: int) -> int:
    """The c for which ``2**(c-1) < n <= 2**c``."""
    return max(0, int(n - 1).bit_length())


@dataclass
class ItemIndex:
    """Items of one block: their shingle sets, and per size class and
    permutation the sorted minima with the item they belong to."""

    ids: list
    sets: list[np.ndarray]
    minima: dict[int, list[tuple[np.ndarray, np.ndarray]]]

    @classmethod
    def build(cls, ids: list, sets: list[np.ndarray]) -> ItemIndex:
        mul, add = permutations()
        of_class: dict[int, list[int]] = {}
        for i, s in enumerate(sets):
            of_class.setdefault(size_class(len(s)), []).append(i)
        minima = {}
        with np.errstate(over="ignore"):
            for c, members in of_class.items():
                low = np.array([[(sets[i] * m + a).min() for i in members] for m, a in zip(mul, add, strict=True)])
                order = np.argsort(low, axis=1)
                where = np.array(members)
                minima[c] = [(low[j][order[j]], where[order[j]]) for j in range(len(mul))]
        return cls(ids, sets, minima)


def window_minima(h: np.ndarray, sizes: np.ndarray, classes: list[int]):
    """Yield (class, permutation, document of each window, minimum of each window).

    ``h`` holds the shingle hashes of all documents in text order."""
    mul, add = permutations()
    doc = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    layout = []  # per class: starts in the finer blocks, document of each block
    at_doc, at_in, step = doc, inside, 0
    for c in classes:
        starts = np.flatnonzero(at_in % (1 << (c - step)) == 0)
        at_in, at_doc, step = at_in[starts] >> (c - step), at_doc[starts], c
        layout.append((starts, at_doc))
    with np.errstate(over="ignore"):
        for j, (m, a) in enumerate(zip(mul, add, strict=True)):
            low = h * m + a
            for c, (starts, owner) in zip(classes, layout, strict=True):
                low = np.minimum.reduceat(low, starts)
                window = low.copy()
                same = owner[1:] == owner[:-1]
                window[:-1][same] = np.minimum(low[:-1], low[1:])[same]
                yield c, j, owner, window


def contained(texts: list[str | None], index: ItemIndex, pct: int, width: int) -> list[list[tuple[int, int]]]:
    """Per text the (item position, shared shingles) of every item found in it."""
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    classes = sorted(index.minima)
    if not classes:
        return out
    at = 0
    while at < len(texts):
        seqs, total, first = [], 0, at
        while at < len(texts) and (not seqs or total < SLICE_SHINGLES):
            new = shingle_lists(texts[at:at + 50], width)
            seqs += new
            total += sum(map(len, new))
            at += len(new)
        sizes = np.array([len(s) for s in seqs])
        if not total:
            continue
        full = np.flatnonzero(sizes)
        pairs = set()
        for c, j, owner, window in window_minima(np.concatenate(seqs), sizes[full], classes):
            low, items = index.minima[c][j]
            lo = np.searchsorted(low, window, "left")
            for k in np.flatnonzero(low[np.minimum(lo, len(low) - 1)] == window):
                hi = np.searchsorted(low, window[k], "right")
                pairs.update((int(full[owner[k]]), int(i)) for i in items[lo[k]:hi])
        sets = {d: np.unique(seqs[d]) for d in {d for d, _ in pairs}}
        for d, i in sorted(pairs):
            item = index.sets[i]
            shared = int(np.isin(item, sets[d], assume_unique=True).sum())
            if 100 * shared >= pct * len(item):
                out[first + d].append((i, shared))
    return out


def item_sets(items: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(item_id, set_key, shingles) of the items with words; equal sets have equal keys."""
    cols = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    kind = cols.schema["item_id"].dataType.simpleString()

    def run(ids, texts):
        sets = shingle_sets(texts, width)
        return ids, [s.tobytes() for s in sets]

    return (arrow_map(cols, run, f"item_id {kind}, shingles binary").where(F.octet_length("shingles") > 0)
            .withColumn("set_key", F.sha2("shingles", 256)))


def item_blocks(sets: DataFrame):
    """Indexes of the distinct sets, in blocks of bounded size (an item of many copies is there once)."""
    once = sets.groupBy("set_key").agg(F.any_value("shingles").alias("shingles"))
    size = once.agg(F.coalesce(F.sum(F.octet_length("shingles")), F.lit(0))).first()[0]
    blocks = -(-size // BLOCK_BYTES)
    for b in range(blocks):
        part = once if blocks == 1 else once.where(F.pmod(F.xxhash64("set_key"), F.lit(blocks)) == b)
        rows = part.collect()  # about BLOCK_BYTES
        yield ItemIndex.build([r[0] for r in rows], [np.frombuffer(r[1], np.uint64) for r in rows])


def find_contained(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_id: str = "item_id", item_text: str = "text", pct: int = SIMILARITY_PCT,
                   width: int = SHINGLE) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared) for every item that a document
    holds to at least ``pct`` percent of the item's distinct shingles."""
    cols = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = (cols.schema["doc_id"].dataType.simpleString(), items.schema[item_id].dataType.simpleString())
    sets = item_sets(items, item_id, item_text, width)
    schema = f"doc_id {kinds[0]}, set_key string, n_item long, n_shared long"
    found = None
    for index in item_blocks(sets):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(ids, texts, shared=shared):
            x = shared.value
            rows = [(d, x.ids[i], len(x.sets[i]), n)
                    for d, hits in zip(ids, contained(texts, x, pct, width), strict=True) for i, n in hits]
            return tuple(zip(*rows)) if rows else ((),) * 4

        part = arrow_map(cols, run, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], f"doc_id {kinds[0]}, item_id {kinds[1]}, n_item long, n_shared long")
    return (found.join(sets.select("item_id", "set_key").hint("merge"), "set_key")
            .select("doc_id", "item_id", "n_item", "n_shared"))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", pct: int = SIMILARITY_PCT, width: int = SHINGLE) -> DataFrame:
    """``docs`` (all columns) without the documents that hold a test item."""
    at = docs.columns.index(text_col)
    schema = docs.schema
    for index in item_blocks(item_sets(items, item_id, item_text, width)):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for b in slices(batches):
                hits = contained(b.column(at).to_pylist(), shared.value, pct, width)
                yield b.filter(pa.array([not h for h in hits], pa.bool_()))
            release()

        docs = docs.mapInArrow(run, schema)
    return docs
