"""Language-model scores from a log-frequency Bloom filter.

Training counts unigrams and bigrams of the training texts exactly: tasks
count their own tokens first, and hashed n-grams with their counts meet in
buckets whose number follows the size of the corpus. Each bucket then
quantises its counts (level = 1 + floor(log_base count)) and enters every
n-gram once per level, from 1 up to its own, into its slice of one Bloom
filter, at ``BITS_PER_ENTRY`` whatever its size. A filter of at most
``MAX_FILTER_BYTES`` is gathered and broadcast; with a larger one, the
n-grams of the texts go to the buckets that hold their slices and the counts
come back by share of texts. The scores are the same. A count is read back by asking for level 1, 2, ... until a
probe fails. The text's probability is the bigram frequency interpolated
with the add-one unigram estimate, both from such probes.

The plain add-one unigram score (``base_score``) uses exact counts: the
most frequent words' counts are broadcast (``HOT_WORDS`` at most), all other
words of a text go to their bucket, and partial sums come back per text.

Words are identified by 64-bit hashes. Edge cases: null and empty texts
are the end token alone; a null id belongs to the training part; repeated
rows are scored, and counted in training, once each; without training
texts every count is 0; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from tokenmill.llm.common import held_out, mix, word_hashes, words, written

BYTES_PER_BUCKET = 32 << 20
TOKENS_PER_FLUSH = 1_200_000  # of a task's share when counting; half of it when scoring
HOT_WORDS = 1 << 17
BASES = {1: 1.2, 2: 1.5}  # quantisation base of unigram and bigram counts
BITS_PER_ENTRY, PROBES = 8, 4
FOLDS = 16  # slices can be halved so many times
MAX_FILTER_BYTES = 512 << 20
BIGRAM_WEIGHT = 0.25
END = np.uint64(xxhash.xxh3_64_intdigest(b"\0end"))
_LOW40 = np.uint64((1 << 40) - 1)
SUMMARY_DOCS = 2_000  # of a share, in one row
_LEVEL = 1.1  # classes of the count-of-counts histogram


def token_stream(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes of all texts, first position of each text); every text ends with END."""
    parts = [np.append(word_hashes(words(t)), END) for t in texts]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.cumsum(sizes) - sizes


def bigrams(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of (previous token, token) at every position; a text starts after END."""
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[starts] = END
    with np.errstate(over="ignore"):
        return mix(before * np.uint64(0x9E3779B97F4A7C15) + h)


def pack40(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unpack40(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel().astype(np.uint64)


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, positions) for every bucket that occurs."""
    if not len(bucket):
        return
    if bucket.max() < 1 << 16:
        bucket = bucket.astype(np.uint16)  # sorted by digits
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    for name, at in zip(names, np.split(order, first[1:]), strict=True):
        yield int(name), at


def bucket_of(order: int, h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(40)) if order == 2 else (h >> np.uint64(20))) % np.uint64(buckets)


def batches_of(df: DataFrame, fn, schema: str, flush: int = TOKENS_PER_FLUSH) -> DataFrame:
    """Map (ids, texts) of some million tokens at a time; ``fn`` yields rows."""
    st = _parse_datatype_string(schema)
    target = to_arrow_schema(st)

    def emit(ids, texts):
        rows = list(fn(ids, texts))
        cols = list(zip(*rows)) if rows else [()] * len(target)
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, target, strict=True)],
                                          schema=target)

    def run(batches):
        ids, texts, chars = [], [], 0
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                new = part.column(1).to_pylist()
                ids += part.column(0).to_pylist()
                texts += new
                chars += sum(len(t) for t in new if t)
                if chars > 5 * flush:
                    yield emit(ids, texts)
                    ids, texts, chars = [], [], 0
        if ids:
            yield emit(ids, texts)

    return df.mapInArrow(run, st)


def count_ngrams(train: DataFrame, buckets: int) -> DataFrame:
    """Rows (bucket, n, once, often, counts): hashes seen once in a task's
    share, and hashes seen more often with their counts."""

    def count(ids, texts):
        h, starts = token_stream(texts)
        for n, grams in ((1, h), (2, bigrams(h, starts))):
            seen, counts = np.unique(grams, return_counts=True)
            shrink = pack40 if n == 2 else (lambda x: x.tobytes())
            for b, at in by_bucket(bucket_of(n, seen, buckets)):
                g, c = seen[at], counts[at]
                yield b, n, shrink(g[c == 1]), shrink(g[c > 1]), c[c > 1].astype("<u4").tobytes()

    return batches_of(train, count, "bucket long, n int, once binary, often binary, counts binary")


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.concatenate([p[0] for p in parts])
    c = np.concatenate([p[1] for p in parts])
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
    return h[first], (np.add.reduceat(c, first) if len(h) else c)


def level(counts: np.ndarray, n: int) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / np.log(BASES[n]) + 1e-9).astype(np.int64)


def value(levels: np.ndarray, n: int) -> np.ndarray:
    """The count that a level stands for (middle of its class, 0 for none)."""
    low = BASES[n] ** (levels - 1.0)
    first, last = np.ceil(low - 1e-9), np.maximum(np.ceil(low * BASES[n] - 1e-9) - 1, np.ceil(low - 1e-9))
    return np.where(levels > 0, (first + last) / 2, 0.0)


def probe_keys(h: np.ndarray, n: int, at_level: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes from which the probe positions of an entry follow."""
    with np.errstate(over="ignore"):
        a = mix(h * np.uint64(0xD6E8FEB86659FD93) + np.uint64(at_level * 4 + n))
        return a, mix(a + np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def build_slice(grams: dict[int, tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Bits (packed) of one bucket's slice."""
    entries, todo = 0, []
    for n, (h, c) in grams.items():
        q = level(c, n)
        for j in range(1, int(q.max(initial=0)) + 1):
            todo.append((n, j, h[q >= j]))
            entries += len(todo[-1][2])
    unit = 8 << FOLDS if entries * BITS_PER_ENTRY >= 8 << FOLDS else 64
    size = max(1, -(-entries * BITS_PER_ENTRY // unit)) * unit
    flags = np.zeros(size, bool)
    with np.errstate(over="ignore"):
        for n, j, h in todo:
            a, b = probe_keys(h, n, j)
            for i in range(PROBES):
                flags[(a + np.uint64(i) * b) % np.uint64(size)] = True
    return np.packbits(flags, bitorder="little")


def fold(bits: bytes, times: int) -> bytes:
    """The slice for a ``2**times`` smaller size (as far as it divides)."""
    a = np.frombuffer(bits, np.uint8)
    for _ in range(times):
        if len(a) % 2 or len(a) < 2:
            break
        a = a[: len(a) // 2] | a[len(a) // 2:]
    return a.tobytes()


class LogFrequencyFilter:
    """The gathered filter: slices one behind the other, probed by bucket."""

    def __init__(self, slices: list[bytes]):
        # kept apart until the first look-up, so that the driver holds the filter once
        self.slices: list[bytes] | None = slices
        self.size = np.array([8 * len(s) for s in slices], np.uint64)

    def _join(self) -> None:
        if self.slices is not None:
            self.bits = np.frombuffer(b"".join(self.slices), np.uint8)
            self.first = np.cumsum(self.size, dtype=np.uint64) - self.size
            self.slices = None

    def count(self, grams: np.ndarray, n: int) -> np.ndarray:
        """Quantised counts of n-gram hashes, by one membership probe after another."""
        out = np.zeros(len(grams), np.int64)
        if not len(self.size):
            return value(out, n)
        self._join()
        slot = bucket_of(n, grams, len(self.size)).astype(np.int64)
        h = grams & _LOW40 if n == 2 else grams
        left, j = np.arange(len(grams)), 0
        while len(left):
            j += 1
            a, b = probe_keys(h[left], n, j)
            size, first = self.size[slot[left]], self.first[slot[left]]
            member = np.ones(len(left), bool)
            with np.errstate(over="ignore"):
                for i in range(PROBES):
                    at = first + (a + np.uint64(i) * b) % size
                    member &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            left = left[member]
            out[left] = j
            if j > 400:  # beyond any count: a saturated filter
                break
        return value(out, n)


class LanguageModel:
    """Filter, exact counts by bucket (written), and the frequent words' counts."""

    def __init__(self, spark, lm: LogFrequencyFilter | None, slices: DataFrame, tokens: int, vocabulary: int,
                 counts: DataFrame, hot: tuple[np.ndarray, np.ndarray], buckets: int):
        self.tokens, self.vocabulary, self.buckets, self.counts = tokens, vocabulary, buckets, counts
        self.slices = slices
        # none: too large to be gathered
        self.filter = None if lm is None else spark.sparkContext.broadcast(lm)
        self.hot = spark.sparkContext.broadcast(hot)


def train(docs: DataFrame, buckets: int) -> LanguageModel:
    """Learn from every row of ``docs(doc_id, text)``."""
    spark = docs.sparkSession

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        grams = {}
        for n, unpack in ((1, lambda x: np.frombuffer(x, "<u8").astype(np.uint64)), (2, unpack40)):
            own = pdf[pdf["n"] == n]
            parts = [(u, np.ones(len(u), np.int64)) for u in map(unpack, own["once"])]
            parts += [(unpack(x), np.frombuffer(c, "<u4").astype(np.int64)) for x, c in zip(own["often"], own["counts"])]
            grams[n] = merge_counts(parts)
        h, c = grams[1]
        classes = np.bincount((np.log(c) / np.log(_LEVEL)).astype(np.int64)) if len(c) else np.zeros(0, np.int64)
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "tokens": [int(c.sum())], "vocabulary": [len(h)],
                             "hashes": [h.astype("<u8").tobytes()], "counts": [c.astype("<i8").tobytes()],
                             "classes": [classes.tolist()], "bits": [build_slice(grams).tobytes()]})

    table = written(count_ngrams(docs, buckets).groupBy("bucket").applyInPandas(
        merge, "bucket long, tokens long, vocabulary long, hashes binary, counts binary, classes array<long>, bits binary"),
        "ngrams")
    zero = F.lit(0).cast("long")
    tokens, vocabulary, size = table.agg(*[F.coalesce(F.sum(x), zero) for x in (
        "tokens", "vocabulary", F.octet_length("bits"))]).first()
    bits = table.select("bucket", "bits")
    lm = None
    if size <= MAX_FILTER_BYTES:
        slices = {r["bucket"]: bytes(r["bits"]) for r in bits.toLocalIterator()}
        lm = LogFrequencyFilter([slices.get(b, b"\0" * 8) for b in range(buckets)])
    counts = table.select("bucket", "hashes", "counts")
    return LanguageModel(spark, lm, bits, tokens, vocabulary, counts, frequent(table), buckets)


def frequent(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and exact counts of the most frequent words: all
    classes of counts that together hold at most ``HOT_WORDS`` words."""
    classes = table.select(F.posexplode("classes").alias("class", "n")).groupBy("class").agg(F.sum("n").alias("n")).collect()
    room, least = HOT_WORDS, None
    for r in sorted(classes, key=lambda r: -r["class"]):
        if r["n"] > room:
            break
        room, least = room - r["n"], r["class"]
    if least is None:
        return np.empty(0, np.uint64), np.empty(0, np.int64)

    def pick(batches):
        for b in batches:
            for hs, cs in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                h, c = np.frombuffer(hs, "<u8"), np.frombuffer(cs, "<i8")
                keep = (np.log(np.maximum(c, 1)) / np.log(_LEVEL)).astype(np.int64) >= least
                yield pa.RecordBatch.from_arrays([pa.array(h[keep].astype("<i8")), pa.array(c[keep])], ["h", "c"])

    # a bounded number of pairs
    got = table.select("hashes", "counts").mapInArrow(pick, "h long, c long").collect()
    h = np.array([r["h"] for r in got], np.int64).astype(np.uint64)
    order = np.argsort(h)
    return h[order], np.array([r["c"] for r in got], np.int64)[order]


def text_key(text: str | None) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63) if text else 0


def summary_rows(ids: list, keys: list[int], columns: list[list], buckets: int):
    """Rows (bucket, ids, keys, *columns) of a share's documents, some at a time. They may go to any
    bucket; it is drawn from the documents' names, so that shares with words in common spread."""
    for at in range(0, len(ids), SUMMARY_DOCS):
        part = slice(at, at + SUMMARY_DOCS)
        name = xxhash.xxh3_64_intdigest(repr((ids[part], keys[part])))
        yield name % buckets, ids[part], keys[part], *[c[part] for c in columns]


def exchanged(docs: DataFrame, slices: DataFrame, buckets: int, fn, schema: str) -> DataFrame:
    """Rows of ``fn(ids, texts, unigram counts, bigram counts)`` for shares of
    the texts. The counts, of the share's distinct n-grams in order, are read
    in the buckets that hold their slices."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    target = to_arrow_schema(_parse_datatype_string(schema))

    def name(ids, texts):
        yield uuid.uuid4().int >> 65, ids, texts

    # written, so that a share keeps its name
    shares = written(batches_of(docs.select("doc_id", "text"), name, f"share long, ids array<{kind}>, texts array<string>",
                                TOKENS_PER_FLUSH // 2), "shares")

    def ask(batches):
        for b in batches:
            for share, texts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                h, starts = token_stream(texts)
                rows = []
                for n, grams in ((1, h), (2, bigrams(h, starts))):
                    seen = np.unique(grams)
                    rows += [(g, share, n, seen[at].astype("<u8").tobytes())
                             for g, at in by_bucket(bucket_of(n, seen, buckets))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], ["bucket", "share", "n", "grams"])

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        bits = right.column("bits").to_pylist()
        f = LogFrequencyFilter([bits[0] if bits else b"\0" * 8])
        cols = left.select(["share", "n", "grams"]).to_pydict()
        counts = [f.count(np.frombuffer(g, "<u8").astype(np.uint64), n).astype("<f8").tobytes()
                  for g, n in zip(cols["grams"], cols["n"], strict=True)]
        return pa.table({"share": pa.array(cols["share"], pa.int64()), "n": pa.array(cols["n"], pa.int32()),
                         "grams": pa.array(cols["grams"], pa.binary()), "counts": pa.array(counts, pa.binary())})

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        found = {}
        cols = right.to_pydict()
        for n in (1, 2):
            own = [i for i, x in enumerate(cols["n"]) if x == n]
            grams = np.frombuffer(b"".join(cols["grams"][i] for i in own), "<u8")
            found[n] = np.frombuffer(b"".join(cols["counts"][i] for i in own), "<f8")[np.argsort(grams)]
        out = []
        for ids, texts in zip(left.column("ids").to_pylist(), left.column("texts").to_pylist(), strict=True):
            out += fn(ids, texts, found[1], found[2])
        cols = list(zip(*out)) if out else [()] * len(target)
        return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, target, strict=True)], schema=target)

    asks = shares.select("share", "texts").mapInArrow(ask, "bucket long, share long, n int, grams binary")
    counts = asks.groupBy("bucket").cogroup(slices.groupBy("bucket")).applyInArrow(
        probe, "share long, n int, grams binary, counts binary")
    return shares.groupBy("share").cogroup(counts.groupBy("share")).applyInArrow(answer, schema)


def score(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) for every row of ``docs(doc_id, text)``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    lm, hot_words, buckets = model.filter, model.hot, model.buckets
    scale = float(model.tokens + model.vocabulary + 1)

    def share(ids, texts, of_words=None, of_pairs=None):
        """Rows for the texts, and per bucket one with their infrequent words."""
        hot, hot_count = hot_words.value
        h, starts = token_stream(texts)
        doc = np.repeat(np.arange(len(texts)), np.diff(np.append(starts, len(h))))
        seen, at = np.unique(h, return_inverse=True)
        pairs, pair_at = np.unique(bigrams(h, starts), return_inverse=True)
        if of_words is None:
            of_words, of_pairs = lm.value.count(seen, 1), lm.value.count(pairs, 2)
        c1, c2 = of_words, of_pairs[pair_at]
        end = c1[np.searchsorted(seen, END)]
        before = np.empty(len(h))
        before[1:] = c1[at][:-1]
        before[starts] = end
        p1 = (c1[at] + 1) / scale
        p2 = np.minimum(1.0, np.divide(c2, before, out=np.zeros(len(h)), where=before > 0))
        p = np.where(before > 0, BIGRAM_WEIGHT * p2 + (1 - BIGRAM_WEIGHT) * p1, p1)
        exact = np.zeros(len(seen), np.int64)
        if len(hot):
            place = np.minimum(np.searchsorted(hot, seen), len(hot) - 1)
            exact = np.where(hot[place] == seen, hot_count[place], 0)
        is_hot = exact > 0
        logs = np.where(is_hot, np.log10((exact + 1) / scale), 0.0)
        sums = [np.add.reduceat(x, starts) for x in (logs[at], np.log10(p), is_hot[at].astype(np.int64))]
        keys = [text_key(t) for t in texts]
        sizes = np.diff(np.append(starts, len(h)))
        for row in summary_rows(ids, keys, [x.tolist() for x in (sizes, sums[2], sums[0], sums[1])], buckets):
            yield *row, None, None, None
        cold = np.flatnonzero(~is_hot[at])
        word_doc, times = np.unique(at[cold].astype(np.int64) * len(texts) + doc[cold], return_counts=True)
        words_at, docs_at = np.divmod(word_doc, max(1, len(texts)))
        for b, rows in by_bucket(bucket_of(1, seen[words_at], buckets)):
            used, local = np.unique(docs_at[rows], return_inverse=True)
            yield (b, [ids[i] for i in used], [keys[i] for i in used], None, None, None, None,
                   seen[words_at[rows]].astype("<u8").tobytes(), local.astype("<u4").tobytes(),
                   times[rows].astype("<u4").tobytes())

    rows = (f"bucket long, ids array<{kind}>, keys array<long>, n_tokens array<long>, known array<long>, "
            "base array<double>, score array<double>, hashes binary, docs binary, times binary")
    if lm is None:
        asked = exchanged(docs, model.slices, buckets, share, rows)
    else:
        asked = batches_of(docs.select("doc_id", "text"), share, rows, TOKENS_PER_FLUSH // 2)

    def answer(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        known_h = np.frombuffer(right["hashes"].iloc[0], "<u8") if len(right) else np.empty(0, "<u8")
        known_c = np.frombuffer(right["counts"].iloc[0], "<i8") if len(right) else np.empty(0, "<i8")
        out = []
        for r in left.itertuples(index=False):
            if r.hashes is None:
                out.append(pd.DataFrame({"doc_id": r.ids, "key": r.keys, "n_tokens": r.n_tokens, "known": r.known,
                                         "base": r.base, "score": r.score, "copies": 1}))
                continue
            h, local, times = (np.frombuffer(x, t) for x, t in ((r.hashes, "<u8"), (r.docs, "<u4"), (r.times, "<u4")))
            c = np.zeros(len(h), np.int64)
            if len(known_h):
                place = np.minimum(np.searchsorted(known_h, h), len(known_h) - 1)
                c = np.where(known_h[place] == h, known_c[place], 0)
            n = len(r.ids)
            out.append(pd.DataFrame({
                "doc_id": r.ids, "key": r.keys, "n_tokens": 0,
                "known": np.bincount(local, times * (c > 0), n).astype(np.int64),
                "base": np.bincount(local, times * np.log10((c + 1) / scale), n), "score": 0.0, "copies": 0}))
        return pd.concat(out) if out else pd.DataFrame(
            {c: [] for c in ("doc_id", "key", "n_tokens", "known", "base", "score", "copies")})

    parts = asked.groupBy("bucket").cogroup(model.counts.groupBy("bucket")).applyInPandas(
        answer, f"doc_id {kind}, key long, n_tokens long, known long, base double, score double, copies long")
    whole = parts.groupBy("doc_id", "key").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "known", "base", "score", "copies")])
    # repeated rows (same id and text) were added up: give each its own share
    n = F.col("copies")
    return (whole.withColumn("_row", F.explode(F.sequence(F.lit(1), n)))
            .select("doc_id", (F.col("n_tokens") / n).cast("long").alias("n_tokens"),
                    (F.col("known") / n).cast("long").alias("n_known"),
                    (F.col("base") / n).alias("base_score"), (F.col("score") / n).alias("score")))


def score_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, remainder: int = 2,
                    held: Column | None = None) -> DataFrame:
    """Scores of every row from a model of the rows that are not held out."""
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = held_out("doc_id", modulus, remainder) if held is None else held
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    model = train(docs.where(~out), max(8, -(-size // BYTES_PER_BUCKET)))
    return score(docs, model).select("doc_id", out.alias("held_out"), "n_tokens", "n_known",
                                     F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
