"""End-to-end jobs composed from the operators — the four data flows of
the survey (§3), each one Spark plan from tables to tables.

* ``supervised_dataset``: template -> token lengths -> budgets -> ids,
  masks and labels cut/padded -> prepared splits (entry 1).
* ``preference_dataset``: candidates -> last-integer score -> first
  correct / first wrong pair -> exact limit (entry 2).
* ``reward_tasks``: sampled countdown tasks -> prompts -> exact
  train/test split (entry 3).
* ``retrieval_report``: matryoshka evaluation at several widths with
  result keys (entry 4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.operators import metrics as M
from tokenmill.operators import records as R
from tokenmill.operators import retrieval as V
from tokenmill.operators import rewards as W
from tokenmill.operators import sample as S
from tokenmill.operators import tokens as T
from tokenmill.sources import io


def supervised_dataset(df: DataFrame, source: str, target: str, split: str = "split",
                       prompt_start: str = "Summarize the following news article:\n",
                       generation_start: str = "\nSummary:\n", max_source: int | None = None,
                       target_percentile: float = 0.95, vocab_size: int = 32_000,
                       out_dir: str | None = None) -> DataFrame:
    """Supervised seq2seq features: templated source ids (+ mask) and
    target labels with pads masked.

    The two length budgets (max source length capped by the template's
    remaining budget, truncated p95 of the target) are one small
    aggregate; the features are one projection over the table."""
    templ = F.concat(F.lit(prompt_start), F.col(source), F.lit(generation_start))
    t = df.select(split, T.tokenize_col(templ).alias("_src"), T.tokenize_col(target).alias("_tgt"),
                  F.monotonically_increasing_id().alias("_row"))
    budget = M.prompt_overhead(prompt_start + "{input}" + generation_start, max_source or 1 << 30,
                               T.tokenize_col)
    lengths = t.agg(F.max(F.size("_src")).alias("src"),
                    F.percentile(F.size("_tgt"), target_percentile).cast("int").alias("tgt"),
                    budget.alias("budget")).first()
    max_src = min(int(lengths["src"] or 0), int(lengths["budget"])) if max_source else int(lengths["src"] or 0)
    max_tgt = int(lengths["tgt"] or 0)
    words = t.select(F.concat("_src", "_tgt").alias("_all"))
    vocab = T.build_vocab(words, "_all", vocab_size)
    # the vocabulary is bounded by vocab_size: broadcast lookup, no regrouping
    enc = T.encode(t, "_row", "_src", vocab, out="_src_ids", method="broadcast")
    enc = T.encode(enc, "_row", "_tgt", vocab, out="_tgt_ids", method="broadcast")
    feats = T.supervised_features(enc, "_src_ids", "_tgt_ids", max(max_src, 1), max(max_tgt, 1))
    out = feats.select(split, "input_ids", "attention_mask", "labels")
    if out_dir:
        io.write_prepared(out, out_dir, split)
    return out


def preference_dataset(candidates: DataFrame, key: str = "prompt_id", idx: str = "cand_idx",
                       text: str = "text", truth: str = "ground_truth", system_prompt: str | None = None,
                       sample_size: int | None = None, carry: Sequence[str] = ("prompt",)) -> DataFrame:
    """Chosen/rejected pairs from scored candidates, at most
    ``sample_size`` of them in prompt order."""
    scored = candidates.withColumn("_correct", W.score_last_int(text, truth))
    pairs = W.preference_pairs(scored, key, idx, text, "_correct", carry=tuple(carry) + (truth,))
    if system_prompt is not None:
        pairs = pairs.withColumn("system_prompt", F.lit(system_prompt))
    return W.limit_pairs(pairs, sample_size, key)


def reward_tasks(tasks: DataFrame, id_col: str, nums: str = "nums", target: str = "target",
                 n: int | None = None, seed: int = 42, test: float = 0.1) -> DataFrame:
    """Shuffled (optionally ``n``) countdown tasks with their prompt and an
    exact train/test split."""
    base = S.sample_n(tasks, n, seed, id_col) if n else tasks
    prompts = base.withColumn("prompt", R.r1_prompt(nums, target))
    return S.split_fraction(prompts, test, seed, id_col)


def retrieval_report(queries: DataFrame, corpus: DataFrame, dims: Sequence[int], k: int = 10,
                     **kw) -> DataFrame:
    """Every IR metric at every width, keyed ``dim_{d}_cosine_ndcg@{k}``."""
    return V.matryoshka_eval(queries, corpus, dims, k, **kw)
