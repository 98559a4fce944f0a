"""Aggregations and evaluation metrics (AGG-*, MET-6…8, MET-12, JON-6/7).

Everything is a DataFrame -> DataFrame aggregate. Algebraic aggregates
(count, sum, avg, min_by, …) are combined map-side, so a hot group only
ships one partial row per task. Exact percentiles of continuous values
are computed by rank (hot groups are split into value sub-ranges), never
by collecting a group's values into one buffer.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.functions import text as X
from tokenmill.operators.offsets import with_positions
from tokenmill.session import broadcast_if_bounded

ColumnOrName = Column | str
_NOT_WORD = re.compile("[^a-z0-9]+")


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _group(df: DataFrame, by: Sequence[str] | str | None):
    if by is None:
        return df.groupBy()
    return df.groupBy(*([by] if isinstance(by, str) else by))


# AGG-1 ---------------------------------------------------------------
def row_count(df: DataFrame, by: Sequence[str] | str | None = None) -> DataFrame:
    return _group(df, by).agg(F.count(F.lit(1)).alias("num_rows"))


# AGG-2 ---------------------------------------------------------------
def max_length(df: DataFrame, col: ColumnOrName, cap: int | None = None,
               by: Sequence[str] | str | None = None) -> DataFrame:
    m = F.max(F.size(_c(col)))
    return _group(df, by).agg((F.least(m, F.lit(cap)) if cap else m).alias("max_length"))


# AGG-3 ---------------------------------------------------------------
def length_percentile(df: DataFrame, lengths: ColumnOrName, p: float | Sequence[float],
                      by: Sequence[str] | str | None = None, out: str = "p_length") -> DataFrame:
    """Exact percentile (linear interpolation) of integer lengths, truncated
    to int; for several ``p`` one column ``p{100p}`` each. The aggregate
    buffer is a value -> count map, bounded by the number of distinct
    lengths, and merges map-side."""
    many = {out: p} if isinstance(p, float) else {_pname(x): x for x in p}
    return _group(df, by).agg(*[F.percentile(_c(lengths), x).cast("int").alias(name) for name, x in many.items()])


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; the left side's keys stay."""
    named = right.withColumnsRenamed({k: f"_tm_r_{k}" for k in keys})
    on = [left[k].eqNullSafe(named[f"_tm_r_{k}"]) for k in keys]
    return left.join(named, on, how).drop(*[f"_tm_r_{k}" for k in keys])


def exact_percentiles(df: DataFrame, value: str, ps: Sequence[float], by: Sequence[str] = (),
                      sub_ranges: int | None = None, rows_per_task: int = 2_000_000) -> DataFrame:
    """Exact percentiles (linear interpolation, as numpy's default) of a
    continuous column per group, by rank; a NULL group is a group.

    1. rows are counted per (group, value), so a repeated value is one row,
    2. approximate cut points per group split each group's distinct values
       into ``sub_ranges`` ranges (a hot group becomes many tasks),
    3. counts per (group, range) -> prefix offsets (small table),
    4. running counts inside each range + offset = ranks of a value,
    5. only the values at ranks ``floor/ceil(p * (n - 1))`` are kept and
       interpolated.
    Output: ``by`` columns + one ``p{100p}`` column per p (double).
    Without ``sub_ranges`` the count is sized from the group with the most
    distinct values: about ``rows_per_task`` of them per range.
    """
    keys = list(by) or ["_tm_all"]
    base = (df.select(*(list(by) or [F.lit(0).alias("_tm_all")]), F.col(value).cast("double").alias("_v"))
            .where(F.col("_v").isNotNull()).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")))
    if sub_ranges is None:
        most = base.groupBy(*keys).count().agg(F.max("count")).first()[0]
        sub_ranges = max(8, -(-int(most or 0) // rows_per_task))
    probs = [i / sub_ranges for i in range(1, sub_ranges)]
    cuts = base.groupBy(*keys).agg(F.percentile_approx("_v", probs, max(10000, 4 * sub_ranges)).alias("_cuts"))
    b = null_safe_join(base, broadcast_if_bounded(cuts, 100_000), keys)
    # range index = number of cut points below the value: a scan for a few
    # cut points, a binary search for many
    below = (F.size(F.filter("_cuts", lambda c: c < F.col("_v"))) if sub_ranges <= 64
             else X.lower_bound("_cuts", "_v", sub_ranges))
    b = b.withColumn("_sub", below).drop("_cuts")
    counts = b.groupBy(*keys, "_sub").agg(F.sum("_c").alias("_k"))
    wk = Window.partitionBy(*keys).orderBy("_sub")
    offsets = counts.select(*keys, "_sub",
                            F.coalesce(F.sum("_k").over(wk.rowsBetween(Window.unboundedPreceding, -1)),
                                       F.lit(0)).alias("_off"),
                            F.sum("_k").over(Window.partitionBy(*keys)).alias("_n"))
    ranked = null_safe_join(b, broadcast_if_bounded(offsets, 1_000_000), keys + ["_sub"])
    wr = Window.partitionBy(*keys, "_sub").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    # a value holds the ranks _first .. _first + _c - 1 of its group
    ranked = ranked.withColumn("_first", F.col("_off") + F.coalesce(F.sum("_c").over(wr), F.lit(0)))

    def holds(rank: Column) -> Column:
        return (F.col("_first") <= rank) & (rank < F.col("_first") + F.col("_c"))

    lo = {p: F.floor(F.lit(p) * (F.col("_n") - 1)).cast("bigint") for p in ps}
    hi = {p: F.ceil(F.lit(p) * (F.col("_n") - 1)).cast("bigint") for p in ps}
    needed = None
    for p in ps:
        cond = holds(lo[p]) | holds(hi[p])
        needed = cond if needed is None else (needed | cond)
    picked = ranked.where(needed)
    aggs = []
    for p in ps:
        frac = F.lit(p) * (F.max("_n") - 1) - F.floor(F.lit(p) * (F.max("_n") - 1))
        vlo = F.max(F.when(holds(lo[p]), F.col("_v")))
        vhi = F.max(F.when(holds(hi[p]), F.col("_v")))
        aggs.append((vlo + (vhi - vlo) * frac).alias(_pname(p)))
    out = picked.groupBy(*keys).agg(*aggs)
    return out if by else out.drop("_tm_all")


def _pname(p: float) -> str:
    s = f"{p * 100:g}".replace(".", "_")
    return f"p{s}"


# AGG-4 ---------------------------------------------------------------
def length_budget(df: DataFrame, prompt_len: str, chosen_len: str, rejected_len: str,
                  p: float = 0.95, multiple: int = 2) -> DataFrame:
    """p95 of the prompt, and max of the p95 of prompt+chosen and
    prompt+rejected, each rounded up to a multiple of 2."""
    pl = F.percentile(F.col(prompt_len), p)
    pc = F.percentile(F.col(prompt_len) + F.col(chosen_len), p)
    pr = F.percentile(F.col(prompt_len) + F.col(rejected_len), p)
    agg = df.agg(pl.cast("int").alias("_p"), F.greatest(pc, pr).cast("int").alias("_t"))
    return agg.select(X.round_up_to("_p", multiple).alias("max_prompt_length"),
                      X.round_up_to("_t", multiple).alias("max_length"))


# AGG-5 ---------------------------------------------------------------
def prompt_overhead(template: str, max_len: int, tokenize) -> Column:
    """Tokens of the template with an empty input; remaining budget."""
    overhead = F.size(tokenize(F.lit(template.replace("{input}", ""))))
    return F.lit(max_len) - overhead


# AGG-6 ---------------------------------------------------------------
def accuracy(df: DataFrame, pred: ColumnOrName, truth: ColumnOrName,
             by: Sequence[str] | str | None = None) -> DataFrame:
    hit = F.coalesce((_c(pred) == _c(truth)).cast("int"), F.lit(0))
    return _group(df, by).agg(F.avg(hit).alias("accuracy"),
                              F.format_number(F.avg(hit) * 100, 2).alias("accuracy_pct"))


# AGG-7 ---------------------------------------------------------------
def nonpad_length(ids: ColumnOrName, pad_id: int = 0) -> Column:
    return F.size(F.filter(_c(ids), lambda x: x != pad_id))


# AGG-8 ---------------------------------------------------------------
def weighted_f1(df: DataFrame, pred: str, truth: str,
                by: Sequence[str] | str | None = None) -> DataFrame:
    """Per-class F1 weighted by class support (classes = truth ∪ pred;
    a class with no support weighs 0)."""
    keys = [] if by is None else ([by] if isinstance(by, str) else list(by))
    pairs = df.groupBy(*keys, pred, truth).agg(F.count(F.lit(1)).alias("_n"))
    as_truth = pairs.groupBy(*keys, F.col(truth).alias("cls")).agg(
        F.sum("_n").alias("support"),
        F.sum(F.when(F.col(pred) == F.col(truth), F.col("_n")).otherwise(0)).alias("tp"))
    as_pred = pairs.groupBy(*keys, F.col(pred).alias("cls")).agg(F.sum("_n").alias("predicted"))
    per = as_truth.join(as_pred, keys + ["cls"], "full").fillna(0, subset=["support", "tp", "predicted"])
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    per = per.withColumn("f1", f1)
    return _group(per, keys or None).agg(
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"))


# AGG-9 / JON-6 -------------------------------------------------------
def class_names(df: DataFrame, label: str) -> DataFrame:
    """Distinct labels -> dense 0-based ids in sorted name order, numbered
    by ranges of names (no task needs all of them)."""
    names = df.select(F.col(label).alias("name")).where(F.col("name").isNotNull()).distinct()
    return with_positions(names, ["name"], pos_col="id").select(F.col("id").cast("int").alias("id"), "name")


def label_join(df: DataFrame, label: str, label_map: DataFrame, out: str = "label_id",
               max_classes: int = 1_000_000) -> DataFrame:
    """Attach the id of each row's class name; the map is broadcast when a
    bounded count proves it small, else joined by shuffle."""
    m = label_map.select(F.col("name").alias(label), F.col("id").alias(out))
    return df.join(broadcast_if_bounded(m, max_classes), label, "left")


# AGG-10 --------------------------------------------------------------
def best_run(metrics: DataFrame, run: str, metric: str, mode: str = "max",
             by: Sequence[str] | str | None = None) -> DataFrame:
    """Best ``run`` by ``metric`` (ties: smallest run)."""
    key = F.struct((-F.col(metric) if mode == "max" else F.col(metric)).alias("m"), F.col(run).alias("r"))
    best = F.min(F.when(F.col(metric).isNotNull(), key))["r"]
    agg = F.max(metric) if mode == "max" else F.min(metric)
    return _group(metrics, by).agg(best.alias(f"best_{run}"), agg.alias(f"best_{metric}"))


# AGG-11 --------------------------------------------------------------
def latency_summary(df: DataFrame, value: str, by: Sequence[str],
                    ps: Sequence[float] = (0.5, 0.9, 0.95), counter: str | None = None) -> DataFrame:
    """Trend statistics (exact percentiles, min, max, avg, count) and an
    optional counter sum per group."""
    aggs = [F.count(F.lit(1)).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"),
            F.avg(value).alias("avg")]
    if counter:
        aggs.append(F.sum(counter).alias(f"{counter}_sum"))
    simple = df.groupBy(*by).agg(*aggs)
    pcts = exact_percentiles(df, value, ps, by)
    return null_safe_join(simple, pcts, list(by), "left")


# AGG-12 --------------------------------------------------------------
def failure_rate(df: DataFrame, failed: str, by: Sequence[str] | str | None = None,
                 max_rate: float = 0.0) -> DataFrame:
    rate = F.avg(F.col(failed).cast("int"))
    return _group(df, by).agg(rate.alias("failure_rate"),
                              (rate <= F.lit(max_rate)).alias("passed"),
                              F.bool_and(~F.col(failed)).alias("all_ok"))


# AGG-13 --------------------------------------------------------------
def peak_by(df: DataFrame, metric: str | Sequence[str], arg: str, by: Sequence[str] | str) -> DataFrame:
    """Maximum of each metric and the ``arg`` where it occurs (ties: the
    smallest ``arg``) per group — e.g. peak requests/s and peak tokens/s
    with their request rates."""
    metrics = [metric] if isinstance(metric, str) else list(metric)
    aggs = []
    for m in metrics:
        aggs.append(F.max(m).alias(f"peak_{m}"))
        name = f"peak_{arg}" if len(metrics) == 1 else f"{m}_peak_{arg}"
        aggs.append(F.max_by(F.col(arg), F.struct(F.col(m), -F.col(arg))).alias(name))
    return _group(df, by).agg(*aggs)


# AGG-15 --------------------------------------------------------------
def mean_reward(df: DataFrame, reward: str, by: Sequence[str] | str | None = None) -> DataFrame:
    return _group(df, by).agg(F.avg(reward).alias("mean_reward"),
                              F.avg((F.col(reward) >= 1.0).cast("int")).alias("solve_rate"))


# AGG-16 --------------------------------------------------------------
def win_rates(df: DataFrame, a: str = "model_a", b: str = "model_b",
              outcome: str = "outcome") -> DataFrame:
    """Per model win/loss/tie counts and rates from both viewpoints;
    ``win_rate_adjusted = (win + tie / 2) / n``."""
    flip = F.when(F.col(outcome) == "win", "loss").when(F.col(outcome) == "loss", "win") \
        .otherwise(F.col(outcome))
    both = df.select(F.col(a).alias("model"), F.col(outcome).alias("o")).unionByName(
        df.select(F.col(b).alias("model"), flip.alias("o")))
    g = both.groupBy("model").agg(
        F.count_if(F.col("o") == "win").alias("win"), F.count_if(F.col("o") == "loss").alias("loss"),
        F.count_if(F.col("o") == "tie").alias("tie"), F.count(F.lit(1)).alias("n"))
    return g.select("model", "win", "loss", "tie", "n",
                    (F.col("win") / F.col("n")).alias("win_rate"),
                    (F.col("loss") / F.col("n")).alias("loss_rate"),
                    ((F.col("win") + F.col("tie") / 2) / F.col("n")).alias("win_rate_adjusted"))


# UDF-6 ---------------------------------------------------------------
def compute_metrics(df: DataFrame, fns: dict, by: Sequence[str] | str | None = None) -> DataFrame:
    """``compute_metrics``: named aggregate builders -> one row (per group)."""
    return _group(df, by).agg(*[f().alias(name) for name, f in fns.items()])


# MET-6 ---------------------------------------------------------------
def rouge_tokens(x: ColumnOrName) -> Column:
    """Lower-case, non-alphanumerics to blanks, split (ROUGE's default
    tokeniser, no stemming)."""
    cleaned = F.regexp_replace(F.lower(_c(x)), r"[^a-z0-9]+", " ")
    return F.filter(F.split(F.trim(cleaned), " "), lambda t: t != "")


def ngrams(tokens: ColumnOrName, n: int) -> Column:
    """Space-joined n-grams, built from ``n`` shifted slices zipped
    together. (A lambda that indexes the token array per element would
    let the optimizer inline the whole tokenisation into every element.)"""
    t = _c(tokens)
    if n == 1:
        return t
    m = F.greatest(F.size(t) - (n - 1), F.lit(0))
    shifted = [F.slice(t, i + 1, m).alias(f"g{i}") for i in range(n)]
    zipped = F.arrays_zip(*shifted)
    return F.transform(zipped, lambda s: F.concat_ws(" ", *[s[f"g{i}"] for i in range(n)]))


def _rouge_words(text: str | None) -> list[str]:
    return _NOT_WORD.sub(" ", (text or "").lower()).split()


def _rouge_map(df: DataFrame, key: str, pred: str, ref: str, score, schema: str) -> DataFrame:
    """Per-row scores of two texts: whole texts, one Arrow batch at a time, no shuffle."""
    kt = df.schema[key].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            rows = [score(p, r) for p, r in zip(pdf[pred], pdf[ref])]
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
            out.insert(0, key, pdf[key].to_numpy())
            yield out

    return df.select(key, pred, ref).mapInPandas(run, f"{key} {kt}, {schema}")


def rouge_n(df: DataFrame, key: str, pred: str, ref: str, n: int = 1) -> DataFrame:
    """Per-row ROUGE-n precision/recall/F (multiset n-gram overlap),
    counted inside the row."""
    def score(p_text, r_text):
        p, r = (list(zip(*[_rouge_words(x)[i:] for i in range(n)])) for x in (p_text, r_text))
        overlap = sum((Counter(p) & Counter(r)).values())
        prec, rec = (overlap / len(x) if x else 0.0 for x in (p, r))
        return prec, rec, 2 * prec * rec / (prec + rec) if prec + rec > 0 else 0.0

    return _rouge_map(df, key, pred, ref, score, "precision double, recall double, fmeasure double")


def rouge_summary(per_row: DataFrame, name: str) -> DataFrame:
    """Mean F ×100, 4 decimals."""
    return per_row.agg(F.round(F.avg("fmeasure") * 100, 4).alias(name))


# MET-7 ---------------------------------------------------------------
def _places(b: Sequence) -> dict:
    """For each token of ``b`` one integer with a bit for every place."""
    at: dict = {}
    for j, t in enumerate(b):
        at[t] = at.get(t, 0) | (1 << j)
    return at


def _lcs_rows(a: Sequence, b: Sequence, at: dict | None = None) -> list[int]:
    """Bit-parallel LCS: after each token of ``a`` one integer whose zero
    bits mark where the LCS with a prefix of ``b`` grows."""
    at = _places(b) if at is None else at
    full = (1 << len(b)) - 1
    v, rows = full, []
    for t in a:
        u = v & at.get(t, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    return rows


def _lcs_len(a: list, b: list) -> int:
    if not a or not b:
        return 0
    if len(a) > len(b):
        a, b = b, a
    return len(b) - _lcs_rows(a, b)[-1].bit_count()


def _f(lcs: int, n_pred: int, n_ref: int) -> float:
    if lcs == 0 or n_pred == 0 or n_ref == 0:
        return 0.0
    p, r = lcs / n_pred, lcs / n_ref
    return 2 * p * r / (p + r)


def rouge_l(df: DataFrame, key: str, pred: str, ref: str, summary_level: bool = False) -> DataFrame:
    """ROUGE-L (LCS F) per row; ``summary_level`` = ROUGE-Lsum: sentences
    on separate lines, union-LCS over the reference lines.

    The LCS is bit-parallel (one big-integer step per token)."""
    def lines(text):
        return [w for w in map(_rouge_words, (text or "").split("\n")) if w]

    def lsum(p_text, r_text):
        p_lines, r_lines = lines(p_text), lines(r_text)
        n_p, n_r = sum(map(len, p_lines)), sum(map(len, r_lines))
        p_left, r_left = (Counter(t for x in ls for t in x) for ls in (p_lines, r_lines))
        hits = 0
        placed = [(p, _places(p)) for p in dict.fromkeys(map(tuple, p_lines))]
        found: dict = {}  # lines may repeat
        for r in map(tuple, r_lines):
            if r not in found:
                found[r] = _union_positions(r, placed)
            for i in found[r]:
                t = r[i]
                if p_left[t] > 0 and r_left[t] > 0:
                    hits += 1
                    p_left[t] -= 1
                    r_left[t] -= 1
        return (_f(hits, n_p, n_r),)

    def whole(p_text, r_text):
        p, r = _rouge_words(p_text), _rouge_words(r_text)
        return (_f(_lcs_len(p, r), len(p), len(r)),)

    return _rouge_map(df, key, pred, ref, lsum if summary_level else whole, "fmeasure double")


def _union_positions(r: Sequence, placed: list[tuple[Sequence, dict]]) -> list[int]:
    """Indices of ``r`` on its longest common subsequence with any of the lines.
    A line whose tokens cover no further place of ``r`` is left out."""
    out: set[int] = set()
    for p, at in placed:
        if any(t in at and i not in out for i, t in enumerate(r)):
            out.update(_lcs_positions(r, p, at))
    return sorted(out)


def _lcs_positions(r: Sequence, p: Sequence, at: dict) -> list[int]:
    """Indices of ``r`` on one longest common subsequence with ``p`` (found
    from the ends; at a tie a token of ``r`` is left out first), whose
    tokens have the places ``at``."""
    kept = [i for i, t in enumerate(r) if t in at]  # other tokens are on none
    r = [r[i] for i in kept]
    rows = _lcs_rows(r, p, at)
    zeros = [0, *rows]  # zeros[i]: bits after i tokens of r; no tokens leave no zero bit

    def length(i: int, j: int) -> int:
        return 0 if i == 0 else j - (zeros[i] & ((1 << j) - 1)).bit_count()

    i, j, out = len(r), len(p), []
    here = length(i, j)
    while i > 0 and j > 0 and here:
        if r[i - 1] == p[j - 1]:
            out.append(kept[i - 1])
            i, j, here = i - 1, j - 1, here - 1
        elif not zeros[i] >> (j - 1) & 1 or length(i - 1, j) == here:
            i -= 1  # the column grows here, or the row above is as good
        else:
            j -= 1
    return out[::-1]


# MET-8 ---------------------------------------------------------------
def sentence_lines(x: ColumnOrName) -> Column:
    """One sentence per line: a break after ``.``, ``!`` or ``?`` + blanks."""
    return F.regexp_replace(_c(x), r"([.!?])\s+", "$1\n")


# MET-12 --------------------------------------------------------------
def latency_per_token(elapsed_s: ColumnOrName, tokens: ColumnOrName,
                      decimals: int | None = 2) -> Column:
    """Milliseconds per generated token (2 decimals by default); NULL for
    0 tokens."""
    v = _c(elapsed_s) / F.nullif(_c(tokens).cast("double"), F.lit(0.0)) * 1000
    return v if decimals is None else F.round(v, decimals)


# JON-7 / RUN-3 -------------------------------------------------------
def improvement(base: ColumnOrName, cand: ColumnOrName) -> Column:
    """Relative change of ``cand`` against ``base`` in percent."""
    return (_c(cand) - _c(base)) / F.nullif(_c(base).cast("double"), F.lit(0.0)) * 100


def compare_runs(metrics: DataFrame, key: Sequence[str], variant: str, value: str,
                 base: str, cand: str) -> DataFrame:
    """Baseline and candidate side by side per ``key`` with % change
    (a pivot on two known values: one aggregate, no self join)."""
    side = metrics.groupBy(*key).agg(
        F.max(F.when(F.col(variant) == base, F.col(value))).alias(f"{value}_{base}"),
        F.max(F.when(F.col(variant) == cand, F.col(value))).alias(f"{value}_{cand}"))
    return side.withColumn("improvement_pct",
                           improvement(f"{value}_{base}", f"{value}_{cand}"))
