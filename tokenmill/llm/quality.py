"""Quality scores by Bradley-Terry ranking of labelled documents.

Documents of label 1 are preferred to documents of label 0. A document's
strength is a sum of steps of its dense features (a weight is added for
every cut point that a feature exceeds; cut points are quantiles of the
training rows), and the chance that document i is preferred to j is
``1 / (1 + exp(strength_j - strength_i))``: a logistic loss on differences
of the step vectors, without intercept. Every document of the larger class
meets ``ROUNDS`` documents of the smaller one, spread evenly; no pair of
everything.

The threshold is a quantile of the strengths of labelled rows that the
ranking has not seen: the one with the fewest errors (of several, the middle
one). A score is the chance of being preferred to a document that stands at
this quantile, shifted so that the quantile itself scores ``THRESHOLD``.

Training rows are a bounded sample (``max_train``) of labelled documents
outside the held-out fold. Features come from the text alone, the whole
text: shares of kinds of bytes, how words begin and end, repetition of
words, pairs of words and lines, function words, compressibility. Labels,
language, source and id are not among them.

Edge cases: null and empty texts have the features of no words and get a
score like any text; a null label is ignored, and of several labels of one
document the largest holds; without labels of both classes every score is
the share of label 1 (0 without labels); ties score alike, repeated rows
too; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.llm.common import held_out, slices, written
from tokenmill.llm.toxicity import training_rows

MAX_TRAIN = 20_000
ROUNDS = 2
CUTS = 8
PENALTY = 1e-3
THRESHOLD = 0.3

# Frequent function words (en, de, fr, es).
FUNCTION_WORDS = frozenset((
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie "
    "le la les de et un une est dans que pour qui sur pas au il par ne se plus ce avec des en du "
    "el los las y del se por con una su para como más pero sus o este").encode().split())

# kinds of bytes
SPACE, LOWER, UPPER, DIGIT, STOP, INNER, SYMBOL, OTHER, HIGH = range(9)
_KIND = np.full(256, OTHER, np.uint8)
_KIND[list(b" \t\n\v\f\r")] = SPACE
_KIND[ord("a"):ord("z") + 1] = LOWER
_KIND[ord("A"):ord("Z") + 1] = UPPER
_KIND[ord("0"):ord("9") + 1] = DIGIT
_KIND[list(b".!?")] = STOP
_KIND[list(b",;:'\"()-")] = INNER
_KIND[list(b"#$%&*@^~|<>{}[]\\/_=+`")] = SYMBOL
_KIND[128:] = HIGH

FEATURES = ("log_words", "word_length", "long_words", "lower", "upper", "digit", "stop", "inner", "symbol", "other",
            "high", "begin_upper", "end_stop", "end_inner", "end_symbol", "alone_symbol", "exclaim", "distinct_words",
            "distinct_pairs", "common_word", "distinct_lines", "line_words", "function_words", "compressed")


def features(text: str | None) -> list[float]:
    """Dense features of a text, in the order of ``FEATURES``."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.lower().split()
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    kind = _KIND[np.frombuffer(data, np.uint8)]
    share = np.bincount(kind, minlength=9) / max(1, len(data) - int((kind == SPACE).sum()))
    edge = np.diff(np.concatenate([[0], kind != SPACE, [0]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    length = end - begin + 1
    last = np.bincount(kind[end], minlength=9) / n
    lines = [x for x in data.split(b"\n") if x.strip()]
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    return [math.log1p(n), float(np.minimum(length, 40).mean()), float((length > 20).mean()),
            *share[[LOWER, UPPER, DIGIT, STOP, INNER, SYMBOL, OTHER, HIGH]].tolist(),
            float((kind[begin] == UPPER).mean()), *last[[STOP, INNER, SYMBOL]].tolist(),
            float(((length == 1) & (kind[begin] == SYMBOL)).mean()), data.count(b"!") / n, len(counts) / n,
            len(set(zip(words, words[1:]))) / max(1, n - 1), max(counts.values()) / n,
            len(set(lines)) / len(lines), math.log1p(n / len(lines)),
            sum(c for w, c in counts.items() if w in FUNCTION_WORDS) / n, len(zlib.compress(data, 1)) / len(data)]


def feature_table(df: DataFrame) -> DataFrame:
    """``df`` (label, fit, text) with ``features`` in place of the text."""
    def run(batches):
        for b in slices(batches):
            rows = [features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(rows, pa.list_(pa.float64()))],
                                             [*b.schema.names[:-1], "features"])

    cols = df.select("doc_id", "label", "fit", "text")
    return cols.mapInArrow(run, f"doc_id {cols.schema['doc_id'].dataType.simpleString()}, label int, fit boolean, "
                                "features array<double>")


@dataclass
class QualityModel:
    """Cut points and cumulated step weights of every feature, the quantile's
    strength; or a constant where there was nothing to rank."""
    cuts: list[np.ndarray]
    steps: list[np.ndarray]
    place: float = 0.0
    quantile: float = 0.0
    constant: float | None = None

    def strengths(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows))
        for f, (cut, step) in enumerate(zip(self.cuts, self.steps, strict=True)):
            out += step[np.searchsorted(cut, rows[:, f], "left")]
        return out

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(rows), self.constant)
        z = self.strengths(rows) - self.place + math.log(THRESHOLD / (1 - THRESHOLD))
        # at the quantile itself exactly the threshold, whatever the rounding
        return np.where(self.strengths(rows) == self.place, THRESHOLD, 1 / (1 + np.exp(-np.clip(z, -700, 700))))


def preference_pairs(table: DataFrame, cuts: list[list[float]]) -> DataFrame:
    """(vector, y): differences of step vectors, half of them (y = 0) turned round."""
    steps = F.array(*[F.when(F.col("features")[f] > x, 1.0).otherwise(0.0) for f, c in enumerate(cuts) for x in c])
    # at most max_train rows in all
    place = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    rows = table.select("label", steps.alias("v"), (F.row_number().over(place) - 1).alias("i"))
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    many, few = (1, 0) if sizes[1] >= sizes[0] else (0, 1)
    left = (rows.where(F.col("label") == many).withColumn("r", F.explode(F.array(*[F.lit(r) for r in range(ROUNDS)])))
            .withColumn("j", (F.col("i") + F.col("r") * (sizes[few] // ROUNDS)) % sizes[few]))
    right = rows.where(F.col("label") == few).select(F.col("i").alias("j"), F.col("v").alias("u"))
    y = (F.col("i") + F.col("r")) % 2
    sign = F.when(y == 1, 1.0).otherwise(-1.0) * (1.0 if many == 1 else -1.0)
    return left.join(right, "j").select(
        array_to_vector(F.zip_with("v", "u", lambda a, b: (a - b) * sign)).alias("vector"), y.cast("double").alias("y"))


def best_quantile(strength: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """(strength, quantile) that separates the labels with the fewest errors."""
    order = np.argsort(strength, kind="stable")
    s, y = strength[order], label[order]
    wrong = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([[0], np.cumsum(1 - y)])[-1] - np.concatenate([[0], np.cumsum(1 - y)])
    between = np.concatenate([[True], s[1:] > s[:-1], [True]])  # equal strengths stay together
    best = np.flatnonzero(between & (wrong == wrong[between].min()))
    at = int(best[len(best) // 2])
    low, high = s[max(at - 1, 0)], s[min(at, len(s) - 1)]
    place = low - 1.0 if at == 0 else high + 1.0 if at == len(s) else (low + high) / 2
    return float(place), at / len(s)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", target: str = "quality",
          max_train: int = MAX_TRAIN, modulus: int = 5, remainder: int = 0) -> QualityModel:
    rows = training_rows(docs, labels, id_col, text_col, target, max_train, modulus, remainder)
    table = written(feature_table(rows), "features")
    n, positive = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    both = table.where("fit").agg(F.min("label"), F.max("label")).first()
    if n == 0 or both[0] is None or both[0] == both[1]:
        return QualityModel([], [], constant=positive / n if n else 0.0)
    wide = table.where("fit").select(*[F.col("features")[f].alias(f"f{f}") for f in range(len(FEATURES))])
    marks = [(k + 0.5) / CUTS for k in range(CUTS)]
    cuts = [sorted(set(q)) for q in wide.approxQuantile(wide.columns, [0.02, *marks, 0.98], 0.002)]
    pairs = preference_pairs(table.where("fit"), cuts).coalesce(8).cache()
    fitted = LogisticRegression(featuresCol="vector", labelCol="y", fitIntercept=False, standardization=False,
                                regParam=PENALTY, maxIter=60).fit(pairs)
    pairs.unpersist()
    weights, steps = fitted.coefficients.toArray(), []
    for c in cuts:
        steps.append(np.concatenate([[0.0], np.cumsum(weights[:len(c)])]))
        weights = weights[len(c):]
    model = QualityModel([np.array(c) for c in cuts], steps)
    # a part of at most max_train rows that the ranking has not seen, if it has both labels
    seen = table.where("not fit").select("features", "label").collect()
    if len({r["label"] for r in seen}) < 2:
        seen = table.select("features", "label").collect()
    model.place, model.quantile = best_quantile(model.strengths(np.array([r["features"] for r in seen])),
                                                np.array([r["label"] for r in seen]))
    return model


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``, learned from ``labels``."""
    modulus, remainder = options.get("modulus", 5), options.get("remainder", 0)
    model = train(docs, labels, id_col, text_col, **options)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            if texts:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(np.array([features(t) for t in texts])))],
                                                 ["doc_id", "score"])

    scored = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
