"""Token sequences: tokenise, encode, truncate, pad, mask, pack (TOK-*),
and calibration samples (CAL-*).

Tokens are whitespace-delimited pieces (``\\S+``) — sub-word tokenisers
are per-row codecs and can be plugged in with ``map_batches``. Packing
uses global running offsets (see ``offsets``), never a sequential loop
or a single-partition window; every group it forms is bounded by the
block length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from tokenmill.operators.offsets import hash_key, with_positions
from tokenmill.operators.sample import TAKE_ORDERED_MAX, head
from tokenmill.session import BROADCAST_LIMIT_BYTES, bounded_size, broadcast_if_bounded, materialize

ColumnOrName = Column | str

TOKEN_PATTERN = r"\S+"
IGNORE_INDEX = -100
# Reserved vocabulary entries (id = position).
SPECIALS = ("<pad>", "<eos>", "<unk>")
PAD_ID, EOS_ID, UNK_ID = 0, 1, 2
LOOKUP_TOKENS = 1 << 18  # looked up at once; a longer row alone


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# TOK-1 ---------------------------------------------------------------
def tokenize_col(x: ColumnOrName, pattern: str = TOKEN_PATTERN) -> Column:
    return F.regexp_extract_all(_c(x), F.lit(pattern), F.lit(0))


def tokenize(df: DataFrame, col: str, out: str = "tokens", pattern: str = TOKEN_PATTERN) -> DataFrame:
    return df.withColumn(out, tokenize_col(col, pattern))


# TOK-2 ---------------------------------------------------------------
def build_vocab(df: DataFrame, tokens: str, max_size: int,
                specials: tuple[str, ...] = SPECIALS) -> DataFrame:
    """``token, id``: specials first, then the ``max_size`` most frequent
    tokens (ties by token). Counting is a partial aggregate; the top-n is
    a bounded heap per task."""
    counts = (df.select(F.explode(tokens).alias("token"))
              .where(~F.col("token").isin(list(specials)))
              .groupBy("token").agg(F.count(F.lit(1)).alias("freq")))
    order = [F.desc("freq"), F.col("token")]
    top = head(counts, max_size, order)
    if max_size <= TAKE_ORDERED_MAX:  # few rows: one window is bounded
        ranked = top.withColumn("pos", F.row_number().over(Window.orderBy(*order)) - 1)
    else:
        ranked = with_positions(top, order, pos_col="pos")
    ranked = ranked.select("token", (F.col("pos") + len(specials)).cast("int").alias("id"))
    spec = df.sparkSession.createDataFrame([(t, i) for i, t in enumerate(specials)], "token string, id int")
    return spec.unionByName(ranked)


def vocab_lookup(df: DataFrame, key: str, tokens: str, vocab: DataFrame,
                 unk_id: int = UNK_ID) -> DataFrame:
    """JON-8: one row per token occurrence ``key, pos, token, id`` (left
    join with the vocabulary; broadcast when a bounded count proves it
    small, else a shuffle join)."""
    exploded = df.select(key, F.posexplode(tokens).alias("pos", "token"))
    v = vocab.select(F.col("token"), F.col("id").alias("_tm_vid"))
    return exploded.join(broadcast_if_bounded(v, 1_000_000), "token", "left") \
        .withColumn("id", F.coalesce("_tm_vid", F.lit(unk_id))).drop("_tm_vid")


def encode(df: DataFrame, key: str, tokens: str, vocab: DataFrame, out: str = "input_ids",
           unk_id: int = UNK_ID, method: str = "auto", max_entries: int = 1_000_000) -> DataFrame:
    """Token list -> id list; a NULL list stays NULL.

    ``"broadcast"`` (default when a bounded read proves that the vocabulary
    has at most ``max_entries`` rows and fits the broadcast limit): the
    table is broadcast once and every row is mapped in Arrow batches; no
    shuffle, other columns untouched.
    ``"join"``: tokens are exploded with their position, joined with the
    vocabulary and put back in order per row (shuffles, any size). Rows
    are told apart by a number written with them, so ``key`` may repeat.
    """
    if method in ("auto", "broadcast"):
        # read twice, or joined: what it was counted from is not counted again
        vocab = materialize(vocab.select("token", "id"))
        rows, size = bounded_size(vocab, max_entries)
        if rows <= max_entries and size <= BROADCAST_LIMIT_BYTES:
            return _encode_broadcast(df, tokens, vocab.collect(), out, unk_id)
        if method == "broadcast":
            raise ValueError(f"vocabulary larger than {max_entries} entries or {BROADCAST_LIMIT_BYTES} bytes")
    df = materialize(df.withColumn("_tm_row", F.monotonically_increasing_id()))
    exploded = df.select("_tm_row", F.posexplode(tokens).alias("_tm_pos", "_tm_token"))
    v = vocab.select(F.col("token").alias("_tm_token"), F.col("id").alias("_tm_vid"))
    # only reached for large vocabularies: a shuffle join; AQE splits the
    # partitions of very common tokens
    joined = exploded.join(v, "_tm_token", "left")
    packed = joined.groupBy("_tm_row").agg(F.array_sort(F.collect_list(
        F.struct("_tm_pos", F.coalesce("_tm_vid", F.lit(unk_id)).alias("id")))).alias("_tm_p"))
    ids = packed.select("_tm_row", F.transform("_tm_p", lambda s: s["id"]).alias(out))
    found = F.coalesce(F.col(out), F.array().cast("array<int>"))
    return df.join(ids, "_tm_row", "left").withColumn(out, F.when(F.col(tokens).isNotNull(), found)).drop("_tm_row")


def _encode_broadcast(df: DataFrame, tokens: str, entries, out: str, unk_id: int) -> DataFrame:
    table = df.sparkSession.sparkContext.broadcast(
        (pa.array([r["token"] for r in entries], pa.string()), np.array([int(r["id"]) for r in entries], np.int32)))

    @F.arrow_udf(ArrayType(IntegerType()))
    def lookup(lists: pa.Array) -> pa.Array:
        # all tokens of some rows at once: one hash table, one look-up pass
        words, ids = table.value
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        found = np.empty(int(sizes.sum()), np.int32)
        ends = np.cumsum(sizes, dtype=np.int64)
        lo = 0
        while lo < len(lists):
            first = int(ends[lo] - sizes[lo])
            hi = max(lo + 1, int(np.searchsorted(ends, first + LOOKUP_TOKENS, "right")))
            at = pc.index_in(lists.slice(lo, hi - lo).flatten(), value_set=words)
            at = pc.fill_null(at, -1).to_numpy(zero_copy_only=False)
            found[first:int(ends[hi - 1])] = np.where(at >= 0, ids[np.maximum(at, 0)] if len(ids) else unk_id, unk_id)
            lo = hi
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(found), mask=lists.is_null())

    return df.withColumn(out, lookup(F.col(tokens)))


# TOK-3 ---------------------------------------------------------------
def truncate(ids: ColumnOrName, n: int, side: str = "right") -> Column:
    a = _c(ids)
    if side == "right":
        return F.slice(a, 1, n)
    return F.slice(a, F.greatest(F.size(a) - n, F.lit(0)) + 1, n)


# TOK-4 ---------------------------------------------------------------
def pad(ids: ColumnOrName, n: int | Column, pad_id: int = PAD_ID, side: str = "right") -> Column:
    a = _c(ids)
    target = n if isinstance(n, Column) else F.lit(n)
    fill = F.array_repeat(F.lit(pad_id), F.greatest(target - F.size(a), F.lit(0)))
    return F.concat(a, fill) if side == "right" else F.concat(fill, a)


def attention_mask(ids: ColumnOrName, n: int | Column, side: str = "right") -> Column:
    a = _c(ids)
    target = n if isinstance(n, Column) else F.lit(n)
    ones = F.array_repeat(F.lit(1), F.size(a))
    zeros = F.array_repeat(F.lit(0), F.greatest(target - F.size(a), F.lit(0)))
    return F.concat(ones, zeros) if side == "right" else F.concat(zeros, ones)


# TOK-5 ---------------------------------------------------------------
def pad_to_multiple(df: DataFrame, batch: str, ids: str, m: int = 8, pad_id: int = PAD_ID,
                    out: str = "padded") -> DataFrame:
    """Pad every row to its batch's longest list rounded up to ``m``."""
    longest = F.max(F.size(ids)).over(Window.partitionBy(batch))
    target = (F.floor((longest + F.lit(m - 1)) / F.lit(m)) * F.lit(m)).cast("int")
    return df.withColumn("_tm_len", target).withColumn(out, pad(ids, F.col("_tm_len"), pad_id)) \
        .withColumn("attention_mask", attention_mask(ids, F.col("_tm_len"))).drop("_tm_len")


# TOK-6 / TOK-7 -------------------------------------------------------
def mask_labels(ids: ColumnOrName, drop: tuple[int, ...] = (PAD_ID,),
                ignore: int = IGNORE_INDEX) -> Column:
    d = F.array(*[F.lit(x) for x in drop])
    return F.transform(_c(ids), lambda x: F.when(F.array_contains(d, x), F.lit(ignore)).otherwise(x))


def unmask_labels(ids: ColumnOrName, pad_id: int = PAD_ID, ignore: int = IGNORE_INDEX) -> Column:
    return F.transform(_c(ids), lambda x: F.when(x == ignore, F.lit(pad_id)).otherwise(x))


# TOK-8 ---------------------------------------------------------------
def supervised_features(df: DataFrame, src_ids: str, tgt_ids: str, max_src: int, max_tgt: int,
                        pad_id: int = PAD_ID) -> DataFrame:
    """Input ids + mask and masked label ids, both cut and padded, in one
    projection."""
    s = truncate(src_ids, max_src)
    t = truncate(tgt_ids, max_tgt)
    return df.select("*", pad(s, max_src, pad_id).alias("input_ids"),
                     attention_mask(s, max_src).alias("attention_mask"),
                     mask_labels(pad(t, max_tgt, pad_id), (pad_id,)).alias("labels"))


# TOK-9 / TOK-10 / TOK-11 --------------------------------------------
def pack_blocks(df: DataFrame, order: list[ColumnOrName], cols: list[str], block: int,
                separator: Column | None = None, labels_from: str | None = None,
                materialize_input: bool = False) -> DataFrame:
    """Concatenate the lists in ``cols`` over all rows in ``order``, cut
    full blocks of ``block`` elements, drop the last partial block.

    All ``cols`` are cut identically (they are zipped first). With
    ``separator`` one element is appended to each row's list (of the
    first column; the others get the same element). ``labels`` is a copy
    of ``labels_from`` (default: the first column).

    Plan: running offsets of list lengths (bucketed prefix sums) -> each
    row is exploded into the (at most ``len/block + 2``) blocks it
    touches -> slice -> group by block (<= ``block`` pieces) -> ordered
    flatten.
    """
    first = cols[0]
    # one list travels as it is: a struct for each element would be many times as large
    single = len(cols) == 1
    zipped = _c(first) if single else F.arrays_zip(*[F.col(c).alias(c) for c in cols])
    if separator is not None:
        sep = separator if single else F.struct(*[separator.alias(c) for c in cols])
        zipped = F.concat(zipped, F.array(sep))
    base = df.select(*[_c(o).alias(f"_tm_o{i}") for i, o in enumerate(order)],
                     zipped.alias("_tm_z"))
    base = base.withColumn("_tm_len", F.size("_tm_z").cast("bigint"))
    if materialize_input:
        # the offsets read their input twice; checkpoint it so an expensive
        # upstream (tokenisation) runs once
        base = materialize(base)
    pos = with_positions(base, [f"_tm_o{i}" for i in range(len(order))], size="_tm_len",
                         start_col="_tm_start", total_size_col="_tm_total", pos_col="_tm_row")
    n_blocks = F.floor(F.col("_tm_total") / F.lit(block)).cast("bigint")
    start, ln = F.col("_tm_start"), F.col("_tm_len")
    first_b = F.floor(start / F.lit(block)).cast("bigint")
    last_b = F.least(F.floor((start + ln - 1) / F.lit(block)).cast("bigint"), n_blocks - 1)
    touched = pos.where((ln > 0) & (first_b < n_blocks)).select(
        "_tm_z", "_tm_start", "_tm_len", F.explode(F.sequence(first_b, last_b)).alias("block_id"))
    lo = F.greatest(F.col("block_id") * block, F.col("_tm_start"))
    hi = F.least((F.col("block_id") + 1) * block, F.col("_tm_start") + F.col("_tm_len"))
    pieces = touched.select("block_id", F.struct(
        F.col("_tm_start").alias("s"),
        F.slice("_tm_z", (lo - F.col("_tm_start") + 1).cast("int"), (hi - lo).cast("int")).alias("p")
    ).alias("_tm_piece"))
    blocks = pieces.groupBy("block_id").agg(F.array_sort(F.collect_list("_tm_piece")).alias("_tm_ps"))
    flat = blocks.select("block_id", F.flatten(F.transform("_tm_ps", lambda x: x["p"])).alias("_tm_f"))
    def field(name):
        return lambda e: e[name]

    outs = [F.col("_tm_f").alias(first)] if single else [F.transform("_tm_f", field(c)).alias(c) for c in cols]
    res = flat.select("block_id", *outs)
    return res.withColumn("labels", F.col(labels_from or first))


def pack_texts(df: DataFrame, order: list[ColumnOrName], text_col: str, block: int,
               separator: str | None = "<eos>", materialize_input: bool = False) -> DataFrame:
    """Whitespace-tokenise a text column and pack it (``packing=True``)."""
    t = df.withColumn("_tm_tokens", tokenize_col(text_col))
    sep = F.lit(separator) if separator is not None else None
    out = pack_blocks(t, order, ["_tm_tokens"], block, separator=sep,
                      materialize_input=materialize_input)
    return out.select("block_id", F.col("_tm_tokens").alias("input_ids"), "labels")


# TOK-12 --------------------------------------------------------------
def fixed_tensor_columns(df: DataFrame, cols: list[str], n: int) -> DataFrame:
    """Equal-size ``ARRAY<INT>`` columns; fails on a row of another size."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.col(c).cast("array<int>"))
        out = out.withColumn(c, F.when(F.size(c) == n, F.col(c))
                             .otherwise(F.raise_error(F.lit(f"{c}: row is not {n} long"))))
    return out


# CAL-1 ---------------------------------------------------------------
CAL_KINDS = ("pair_colon", "pair_space", "lines", "concat", "middle_part")


def calibration_pieces(df: DataFrame, kind: str, a: str, b: str | None = None) -> Column:
    """Per-row piece of the calibration text; the corpus is the ordered
    concatenation of the pieces (never built as one string)."""
    if kind == "pair_colon":
        return F.concat(F.col(a), F.lit(": "), F.col(b), F.lit("\n"))
    if kind == "pair_space":
        return F.concat(F.col(a), F.lit(" "), F.col(b), F.lit("\n"))
    if kind == "lines":
        return F.concat(F.col(a), F.lit("\n"))
    if kind == "concat":
        return F.when(F.col(a) == "", F.lit(" \n")).otherwise(F.col(a))
    if kind == "middle_part":
        parts = F.split(F.col(a), "===")
        mid = F.when(F.size(parts) >= 3, F.get(parts, 2)).otherwise(F.col(a))
        return F.concat(F.regexp_replace(mid, r"^\s+|\s+$", ""), F.lit("\n"))
    raise ValueError(f"unknown calibration kind {kind!r}; known: {CAL_KINDS}")


def calibration_corpus(df: DataFrame, kind: str, n: int, order: list[ColumnOrName],
                       a: str, b: str | None = None) -> DataFrame:
    """First ``n`` rows as ordered pieces with character and token offsets.

    For the newline-ending kinds tokens never span two pieces, so a
    window over the corpus is a window over the piece token lists.
    """
    from tokenmill.operators.sample import head
    first = head(df, n, order)
    pieces = first.select(*[_c(o).alias(f"_tm_o{i}") for i, o in enumerate(order)],
                          calibration_pieces(first, kind, a, b).alias("piece"))
    pieces = pieces.withColumn("n_chars", F.length("piece").cast("bigint")) \
        .withColumn("tokens", tokenize_col("piece"))
    pieces = pieces.withColumn("n_tokens", F.size("tokens").cast("bigint"))
    out = with_positions(pieces, [f"_tm_o{i}" for i in range(len(order))], size="n_tokens",
                         pos_col="piece_idx", start_col="token_start", total_size_col="total_tokens")
    return out.drop(*[f"_tm_o{i}" for i in range(len(order))])


# CAL-2 ---------------------------------------------------------------
def random_windows(pieces: DataFrame, n: int, length: int, seed: int = 0) -> DataFrame:
    """``n`` crops of ``length`` tokens out of the concatenated corpus.

    ``pieces`` has ``tokens, token_start, total_tokens`` (from
    :func:`calibration_corpus`). Crops are joined to pieces through the
    ``length``-sized token bins they touch (an equi-join on the bin, then
    an overlap test), so no piece is compared with every crop.
    """
    span = F.greatest(F.col("total_tokens") - F.lit(length), F.lit(1))
    crops = (pieces.select("total_tokens").limit(1)
             .select("total_tokens", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("window_id"))
             .withColumn("crop_start", F.pmod(hash_key("window_id", seed=f"crop{seed}"), span)))
    crops = crops.withColumn("bin", F.explode(F.sequence(
        F.floor(F.col("crop_start") / length), F.floor((F.col("crop_start") + length - 1) / length)
    ).cast("array<bigint>")))
    ps = pieces.where(F.col("n_tokens") > 0).select("tokens", "token_start", "n_tokens")
    ps = ps.withColumn("bin", F.explode(F.sequence(
        F.floor(F.col("token_start") / length),
        F.floor((F.col("token_start") + F.col("n_tokens") - 1) / length)).cast("array<bigint>")))
    j = ps.join(F.broadcast(crops.drop("total_tokens")), "bin")
    j = j.where((F.col("token_start") < F.col("crop_start") + length) &
                (F.col("token_start") + F.col("n_tokens") > F.col("crop_start")))
    # a (crop, piece) pair can share two bins: keep it on the first shared one
    j = j.where(F.col("bin") == F.greatest(F.floor(F.col("crop_start") / length),
                                           F.floor(F.col("token_start") / length)))
    lo = F.greatest(F.col("crop_start"), F.col("token_start"))
    hi = F.least(F.col("crop_start") + length, F.col("token_start") + F.col("n_tokens"))
    piece = F.struct(F.col("token_start").alias("s"),
                     F.slice("tokens", (lo - F.col("token_start") + 1).cast("int"),
                             (hi - lo).cast("int")).alias("p"))
    w = j.groupBy("window_id", "crop_start").agg(F.array_sort(F.collect_list(piece)).alias("_tm_ps"))
    ids = F.flatten(F.transform("_tm_ps", lambda x: x["p"]))
    return w.select("window_id", "crop_start", ids.alias("input_ids"),
                    F.array_repeat(F.lit(1), F.size(ids)).alias("attention_mask"))


# CAL-3 ---------------------------------------------------------------
def random_doc_windows(df: DataFrame, id_col: str, tokens: str, n: int, length: int,
                       seed: int = 0) -> DataFrame:
    """``n`` documents with at least ``length`` tokens (sampled without
    replacement), each cropped at an md5-derived start."""
    from tokenmill.operators.sample import sample_n
    long_docs = df.where(F.size(tokens) >= length)
    picked = sample_n(long_docs, n, seed, id_col)
    span = F.greatest(F.size(tokens) - F.lit(length), F.lit(1))
    start = F.pmod(hash_key(id_col, seed=f"docstart{seed}"), span)
    return picked.select(id_col, start.alias("crop_start"),
                         F.slice(tokens, (start + 1).cast("int"), length).alias("input_ids"),
                         F.array_repeat(F.lit(1), length).alias("attention_mask"))
