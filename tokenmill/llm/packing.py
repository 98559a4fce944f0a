"""Best-fit packing planned over a length histogram.

Documents are tokenised (an end id after each) and those longer than a
sequence are cut into full pieces, the first of which takes the rest.
Only the histogram of piece lengths (at most ``capacity`` rows) reaches
the driver. There, best-fit decreasing runs over counts: open sequences
with the same free space are one interval, and a whole interval is filled
in one step. The plan says which ranks of a length go to which sequences;
pieces take their planned slots by a join on length and rank.

Edge cases: null and empty texts are documents of the end id alone; equal
lengths are ranked by row block (interchangeable); repeated rows are
separate documents; an empty table gives no pieces; extra columns are
ignored.
"""

from __future__ import annotations

import bisect
import json
from functools import cached_property, lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.common import arrow_map, written
from tokenmill.llm.sharding import ROWS_PER_NUMBERING, numbered

CAPACITY = 2048
END_ID = 0

# Fixed value: how byte-level BPE files of this kind cut texts before merging.
PATTERN = (r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s")
_SAMPLE = ["", " ", "a  b\n\n c \t d", "don't we'll 12ab 3.14", "  x", "tail  ", "\u00e9\u00df \u4f60\u597d \U0001f600!", "\x85a\x85 b\xa0c"]


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the others for 256 and up in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class TextTokenizer:
    """Ids of a ``tokenizers`` file.

    A byte-level BPE file whose ids follow its merges is run by ``tiktoken``'s
    encoder over the same vocabulary (several times faster, same ids); any
    other file, and texts with special strings, by ``tokenizers`` itself."""

    def __init__(self, path: str):
        self.path = path
        tok = self.library
        self.special = [t.content for t in tok.get_added_tokens_decoder().values()]
        self.fast = self._ranked(path, tok)
        if self.fast and any(self.fast.encode_ordinary(t) != self._plain(t) for t in _SAMPLE):
            self.fast = None
        if self.fast:
            del self.library  # loaded again where a text needs it

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _ranked(self, path: str, tok):
        import tiktoken

        spec = json.loads(tok.to_str())
        cutter = spec["pre_tokenizer"] or {}
        if (spec["model"]["type"] != "BPE" or spec["normalizer"] or cutter.get("type") != "ByteLevel"
                or cutter.get("add_prefix_space") or not cutter.get("use_regex", True) or spec["model"].get("ignore_merges")):
            return None
        byte = byte_alphabet()
        vocab = {k: i for k, i in spec["model"]["vocab"].items() if k not in self.special}
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in spec["model"]["merges"]]
        if any(vocab[x] >= vocab[y] for x, y in zip(merges, merges[1:])):
            return None
        ranks = {bytes(byte[c] for c in k): i for k, i in vocab.items()}
        return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _plain(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def ids(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of the text."""
        if not text:
            return b""
        if self.fast is None or any(s in text for s in self.special):
            return np.asarray(self._plain(text), "<u4").tobytes()
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


@lru_cache(maxsize=2)
def text_tokenizer(path: str) -> TextTokenizer:
    return TextTokenizer(path)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    out = [(0, first)] if first else []
    return out + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(df: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids): ids are little-endian unsigned 32-bit."""
    cols = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = cols.schema["doc_id"].dataType.simpleString()
    end = np.asarray([end_id], "<u4").tobytes()

    def run(ids, texts):
        tok = text_tokenizer(tokenizer)
        rows = []
        for i, t in zip(ids, texts, strict=True):
            data = tok.ids(t) + end
            rows += [(i, p, s, n, data[4 * s:4 * (s + n)]) for p, (s, n) in enumerate(cut(len(data) // 4, capacity))]
        return tuple(zip(*rows)) if rows else ((),) * 5

    return arrow_map(cols, run, f"doc_id {kind}, piece int, start long, length long, ids binary")


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Plan of best-fit decreasing over counts.

    Entries (length, rank_from, rank_to, per_sequence, first_sequence,
    offset): rank r of the length goes to sequence ``first + (r - from) //
    per`` at ``offset + (r - from) % per * length``."""
    plan: list[tuple[int, int, int, int, int, int]] = []
    free: list[int] = []  # sorted amounts of free space that occur
    bins: dict[int, list[tuple[int, int]]] = {}  # free space -> intervals (first sequence, how many)
    opened = 0

    def put(space: int, first: int, n: int) -> None:
        if n and space:
            if space not in bins:
                bins[space] = []
                bisect.insort(free, space)
            bins[space].append((first, n))

    for length in sorted((x for x, c in histogram.items() if c), reverse=True):
        rank, left = 0, histogram[length]
        while left:
            i = bisect.bisect_left(free, length)
            if i == len(free):
                per = min(capacity // length, left)
                n, first, space = left // per, opened, capacity
                opened += n
            else:
                space = free[i]
                first, n = bins[space].pop()
                per = min(space // length, left)
                n, rest = min(n, left // per), n
                put(space, first + n, rest - n)
                if not bins[space]:
                    del bins[space]
                    free.pop(bisect.bisect_left(free, space))
            plan.append((length, rank, rank + n * per, per, first, capacity - space))
            put(space - per * length, first, n)
            rank, left = rank + n * per, left - n * per
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces`` (with a ``length``
    of 1 to ``capacity``, read several times: pass a written table)."""
    spark = pieces.sparkSession
    blocked = written(pieces.withColumn("_part", F.monotonically_increasing_id()), "pieces")
    histogram = {r[0]: r[1] for r in blocked.groupBy("length").count().collect()}
    blocks = max(1, -(-sum(histogram.values()) // ROWS_PER_NUMBERING))
    blocked = blocked.withColumn("_part", F.pmod("_part", F.lit(blocks)))
    plan = spark.createDataFrame(best_fit(histogram, capacity),
                                 "length long, _from long, _to long, _per long, _first long, _offset long")
    ranked = numbered(blocked, "length", "_part", "_rank")
    slot = F.col("_rank") - F.col("_from")
    return (ranked.join(F.broadcast(plan), "length")  # a few rows per length
            .where((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
            .withColumn("sequence_id", F.col("_first") + F.floor(slot / F.col("_per")))
            .withColumn("offset", F.col("_offset") + slot % F.col("_per") * F.col("length"))
            .select(*pieces.columns, "sequence_id", "offset"))


def pack_documents(df: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places in packed sequences.

    Columns doc_id, piece, start, length, ids_crc32, sequence_id, offset,
    and ``ids`` when kept (they are then moved with their rows)."""
    pieces = token_pieces(df, tokenizer, capacity, end_id, id_col, text_col)
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids"))
    return pack(pieces if keep_ids else pieces.drop("ids"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, pieces, ids) from pieces packed with their ids:
    one row per sequence, at most ``capacity`` ids each."""
    part = F.struct("offset", "doc_id", "piece", "start", "length", "ids")
    grouped = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("_parts"),
                                                F.sum("length").alias("n_tokens"))
    return grouped.select(
        "sequence_id", "n_tokens",
        F.transform("_parts", lambda p: p.dropFields("ids")).alias("pieces"),
        F.aggregate("_parts", F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["ids"])).alias("ids"))
