"""Toxicity scores: gradient-boosted trees over dense features, then isotonic calibration.

Features of a text (labels, language, source and id are never among them):
lexicon densities (a short general list, and words and word beginnings
learned from labelled texts), how many lexicon hits stand near a second
person, capitals, punctuation, and obfuscation rates. Training rows are a
bounded sample (``max_train``) of the labelled documents outside the
held-out fold; one part picks the lexicon and grows the trees, the rest
fits the calibration. Scoring is one map over all documents with the
lexicon (at most ``LEXICON`` entries) and the model sent along.

Edge cases: null and empty texts have the features of no words and get a
score like any text; a label of null is ignored, and of several labels of
one document the largest holds; without labels of both classes every score
is the share of toxic labels (0 without labels); ties in score are kept;
repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.common import arrow_map, held_out, release, written

MAX_TRAIN = 20_000
LEXICON = 1_000
PREFIXES = (4, 5, 6)
TREES, DEPTH = 20, 3
PLATEAU = 0.001  # weight of the uncalibrated score: keeps order inside a calibration step

# Common insults and second-person forms (en, de, fr, es).
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb loser losers scum trash pathetic worthless disgusting clown fool jerk "
    "hate ugly garbage filth vermin idiota imbecile imbécile crétin stupide débile dummkopf trottel abschaum "
    "dumm blöd wertlos estúpido basura asqueroso inútil".split())
SECOND = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre "
                   "tú ti usted ustedes vosotros".split())
_PLAIN = str.maketrans("013457@$!|", "oieastasil")
_WORD = re.compile(r"[^\W_]+(?:[@$!|*.'_-]+[^\W_]+)*")
_MIXED = re.compile(r"[^\W\d_][0-9@$!|*]+[^\W\d_]")
_SPACED = re.compile(r"(?<!\w)(?:\w[ .*_-]){3,}\w(?!\w)")
_PUNCT = re.compile(r"[!?.,;:]")
_REPEATED = re.compile(r"[!?]{2,}|[#$%&*@]{2,}")
NEAR = 5
FEATURES = ("words", "insult_density", "insults", "learned_density", "learned", "learned_weight", "learned_kinds",
            "near_second", "second_density", "capitals", "shouting", "exclaim", "question", "punctuation", "repeated",
            "mixed", "spaced", "hidden", "word_length")


def tokens(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def keys(word: str) -> list[str]:
    """The word and its beginnings (marked by a star) that the lexicon may hold."""
    return [word] + [word[:n] + "*" for n in PREFIXES if len(word) > n]


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """Dense features of a text, in the order of ``FEATURES``."""
    text = text or ""
    ws = tokens(text)
    n, chars = max(1, len(ws)), max(1, len(text))
    weight: dict[str, float] = {}
    hidden = insults = hits = 0
    total = 0.0
    for w, c in Counter(ws).items():
        got = max((lexicon.get(k, 0.0) for k in keys(w)), default=0.0)
        plain = w
        if got == 0.0 and w not in INSULTS and not w.isalpha():
            plain = re.sub(r"[^\w]|_", "", w.translate(_PLAIN))
            got = max((lexicon.get(k, 0.0) for k in keys(plain)), default=0.0)
            hidden += c * (got > 0 or plain in INSULTS)
        insults += c * (plain in INSULTS)
        if got > 0 or plain in INSULTS:
            weight[w] = got
            hits += c * (got > 0)
            total += c * got
    near = 0
    second = [i for i, w in enumerate(ws) if w in SECOND]
    if weight and second:
        around = {i + d for i in second for d in range(-NEAR, NEAR + 1)}
        near = sum(1 for i, w in enumerate(ws) if w in weight and i in around)
    upper = sum(1 for x in text if x.isupper()) if text else 0
    shout = len(re.findall(r"\b[^\W\d_a-zß-ÿ]{3,}\b", text))
    return [math.log1p(len(ws)), insults / n, math.log1p(insults), hits / n, math.log1p(hits), total / n,
            float(len(weight)), near / n, len(second) / n, upper / chars, shout / n, text.count("!") / chars,
            text.count("?") / chars, len(_PUNCT.findall(text)) / chars, len(_REPEATED.findall(text)) / n,
            len(_MIXED.findall(text)) / n, len(_SPACED.findall(text)) / n, hidden / n,
            sum(map(len, ws)) / n]


def feature_table(df: DataFrame, lexicon: dict[str, float], *carry: str) -> DataFrame:
    """``carry`` columns and ``features`` (array of doubles) per row of ``df``, which has ``text``."""
    cols = df.select(*carry, "text")
    schema = ", ".join(f"{c} {cols.schema[c].dataType.simpleString()}" for c in carry)

    def run(*columns):
        return *columns[:-1], [features(t, lexicon) for t in columns[-1]]

    return arrow_map(cols, run, f"{schema}, features array<double>")


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, target: str,
                  max_train: int, modulus: int, remainder: int) -> DataFrame:
    """(doc_id, text, label, fit) of a bounded sample of labelled rows outside the held-out fold."""
    usable = (labels.select(F.col(id_col).alias("doc_id"), F.col(target).cast("int").alias("label"))
              .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("doc_id", modulus, remainder))
              .groupBy("doc_id").agg(F.max("label").alias("label")))
    n = usable.count()
    if n > max_train:
        share = int(0.98 * max_train / n * (1 << 30))
        usable = usable.where(F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1 << 30)) < share).limit(max_train)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # at most max_train pairs of an id and a bit
    return written(rows.join(F.broadcast(usable), "doc_id")
                   .withColumn("fit", F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(4)) > 0), "labelled")


def learn_lexicon(rows: DataFrame, size: int = LEXICON) -> dict[str, float]:
    """Words and word beginnings that toxic texts hold far more often than
    others: smoothed log odds of document counts, strongest first."""
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not n.get(0) or not n.get(1):
        return {}

    def run(labels, texts):
        out = [(k, y) for y, t in zip(labels, texts, strict=True) for k in {k for w in set(tokens(t)) for k in keys(w)}]
        return tuple(zip(*out)) if out else ((), ())

    counts = (arrow_map(rows.select("label", "text"), run, "term string, label int")
              .groupBy("term").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("o")))
    odds = F.log((F.col("t") + 0.5) / (n[1] + 1)) - F.log((F.col("o") + 0.5) / (n[0] + 1))
    # a term counts when its odds are high and enough texts agree
    sure = odds - 1.64 * F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("o") + 0.5))
    top = (counts.where("t >= 3").select("term", odds.alias("odds"), sure.alias("sure"))
           .where("sure > 1.0").orderBy(F.desc("sure"), "term").limit(size))
    return {r["term"]: float(r["odds"]) for r in top.collect()}


class ToxicityModel:
    """Lexicon, trees and calibration; ``with_score`` maps a table of texts."""

    def __init__(self, lexicon, trees, steps, constant):
        self.lexicon, self.trees, self.steps, self.constant = lexicon, trees, steps, constant

    def with_score(self, df: DataFrame, text_col: str = "text", out: str = "score") -> DataFrame:
        """All rows and columns of ``df`` and the score (0..1) of each text."""
        if self.trees is None:
            return df.withColumn(out, F.lit(self.constant))
        lexicon = self.lexicon

        @F.pandas_udf("array<double>")
        def dense(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in parts:
                yield texts.map(lambda t: features(t, lexicon))
            release()

        # own columns ride in one struct beside the row, so no name can clash
        rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), dense(F.col(text_col)).alias("features"))
        scored = with_raw(self.trees, rows)
        score = F.col("raw")
        if self.steps is not None:
            scored = self.steps.transform(scored)
            step = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("calibrated")))
            score = (1 - PLATEAU) * step + PLATEAU * F.col("raw")
        return scored.select("_row.*", score.alias(out))


def with_raw(trees, table: DataFrame) -> DataFrame:
    scored = trees.transform(table.withColumn("vector", array_to_vector("features")))
    return (scored.withColumn("raw", vector_to_array("probability")[1])
            .drop("vector", "rawPrediction", "probability", "prediction", "features"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          target: str = "toxic", max_train: int = MAX_TRAIN, modulus: int = 5, remainder: int = 0) -> ToxicityModel:
    rows = training_rows(docs, labels, id_col, text_col, target, max_train, modulus, remainder)
    n, positive = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    fit = rows.where("fit")
    both = fit.agg(F.min("label"), F.max("label")).first()
    if n == 0 or both[0] is None or both[0] == both[1]:
        return ToxicityModel({}, None, None, positive / n if n else 0.0)
    lexicon = learn_lexicon(fit)
    table = written(feature_table(rows, lexicon, "doc_id", "label", "fit"), "features")
    grow = table.where("fit").select(array_to_vector("features").alias("vector"), F.col("label").cast("double").alias("y"))
    # a bounded table: few partitions, kept in memory while the trees grow
    grow = grow.coalesce(8).cache()
    trees = GBTClassifier(featuresCol="vector", labelCol="y", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7,
                          checkpointInterval=-1).fit(grow)
    grow.unpersist()
    rest = with_raw(trees, table.where("not fit")).select("raw", F.col("label").cast("double").alias("y"))
    steps = None
    if rest.agg(F.countDistinct("y")).first()[0] == 2:
        steps = IsotonicRegression(featuresCol="raw", labelCol="y", predictionCol="calibrated").fit(rest.coalesce(8))
    return ToxicityModel(lexicon, trees, steps, positive / n)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``, learned from ``labels``."""
    modulus, remainder = options.get("modulus", 5), options.get("remainder", 0)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = train(docs, labels, id_col, text_col, **options).with_score(rows)
    return scored.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = 0.5, **options) -> DataFrame:
    """``docs`` (all columns) without the texts that score ``threshold`` or more."""
    model = train(docs, labels, id_col, text_col, **options)
    return model.with_score(docs, text_col, "_toxicity").where(F.col("_toxicity") < threshold).drop("_toxicity")
