"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic
regression.

The lexicon is learnt from labelled documents: words, and beginnings of words,
that toxic documents hold far more often.  Every document then gets a short
vector of rates (lexicon hits, hits near a second-person word, capitals,
punctuation, obfuscation), and trees and calibration work on those alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradecast.llm.common import fold_of, map_texts, saved
from tradecast.llm.labels import FOLDS, training_labels

TRAIN_ROWS = 60_000   # labelled documents that the model is fitted on, about
LEXICON = 256         # entries of each kind
CALIBRATION_FOLD = 4  # folds 1 to 3 fit lexicon and trees
TREES, DEPTH, STEP, LEAST_ROWS = 30, 3, 0.2, 10  # rows of a leaf: fewer with under 40 toxic ones
NEAR = 5              # words
MEMO = 300_000        # words a task remembers

# Words of the second person.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú usted ustedes vosotros ti tus".split())
# Signs that stand for letters.
LOOKALIKE = str.maketrans("013457@$!|+", "oieastasiit")

TOKEN = re.compile(r"\w+")
MIXED = re.compile(r"[^\W\d_]+(?:[0-9@$*!|+._-]+[^\W\d_]+)+|[0-9@$!|+]+[^\W\d_]+(?:[0-9@$*!|+]+[^\W\d_]*)*")
SHOUTED = re.compile(r"\b[^\W\d_a-z]{2,}\b")
REPEATED = re.compile(r"(\w)\1\1")
CAPITALS, STOPS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:\"'()[]{}-#&%*$<>/\\|~^_=+@"

FEATURES = ("lexicon rate", "lexicon weight", "heaviest entry", "log hits", "distinct entries", "log heavy hits", "heavy rate",
            "second-person rate", "hits near a second person", "closest second person", "capitals", "shouted words",
            "exclamation marks", "question marks", "other signs", "obfuscated words", "repeated letters",
            "hits behind lookalikes", "log words")
HEAVY = 3.0


def terms_of(word: str) -> list[str]:
    """The word, and its beginnings of four to six letters (marked by a *)."""
    return [word] + [word[:n] + "*" for n in (4, 5, 6) if len(word) > n]


def _term_counts(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = (Counter(), Counter())
    for p in parts:
        for text, label in zip(p["text"], p["label"], strict=True):
            if text:
                counts[label].update({t for w in set(TOKEN.findall(text.lower())) for t in terms_of(w)})
    for label, c in enumerate(counts):
        if c:
            yield pd.DataFrame({"term": list(c.keys()), "label": label, "n": list(c.values())})


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Log odds of the words and beginnings that mark toxic texts, from rows
    (``text``, ``label``); at most ``LEXICON`` of each kind."""
    rows = rows.select("text", "label")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return {}
    found = rows.mapInPandas(_term_counts, "term string, label int, n long").groupBy("term").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("b"))
    odds = F.log((F.col("a") + 0.5) / (n1 + 1)) - F.log((F.col("b") + 0.5) / (n0 + 1))
    error = F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    found = saved(found.withColumn("w", odds).where((F.col("a") >= 3) & (F.col("w") > 1.0) & (F.col("w") > 3.0 * error))
                  .withColumn("gain", F.col("a") * F.col("w")), "toxicity-terms")
    starts = F.col("term").endswith("*")
    top = [found.where(kind).orderBy(F.desc("gain"), "term").limit(LEXICON) for kind in (starts, ~starts)]
    return {r["term"]: r["w"] for r in top[0].unionByName(top[1]).collect()}


class _Features:
    """Dense features of texts in a task."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.memo = lexicon, {}

    def weight(self, word: str) -> float:
        return max((self.lexicon.get(t, 0.0) for t in terms_of(word)), default=0.0)

    def coded(self, word: str) -> float:
        """Weight, plus 100 for a second-person word and 1000 for repeated letters."""
        if len(self.memo) >= MEMO:
            self.memo.clear()
        code = self.weight(word) + 100 * (word in SECOND_PERSON) + 1000 * (REPEATED.search(word) is not None)
        self.memo[word] = code
        return code

    def of(self, text: str | None) -> list[float]:
        text = text or ""
        words = TOKEN.findall(text.lower())
        n = max(1, len(words))
        codes = list(map(self.memo.get, words))
        if None in codes:
            codes = [self.coded(w) if c is None else c for w, c in zip(words, codes, strict=True)]
        code = np.array(codes, float)
        repeated = code >= 1000
        code -= 1000 * repeated
        second = code >= 100
        w = code - 100 * second
        hit, heavy = w > 0, w >= HEAVY
        at, you = np.flatnonzero(hit), np.flatnonzero(second)
        if len(at) and len(you):
            right = np.searchsorted(you, at)
            gap = np.minimum(np.abs(at - you[np.minimum(right, len(you) - 1)]), np.abs(at - you[np.maximum(right - 1, 0)]))
        else:
            gap = np.full(len(at), 10**6)
        raw = text.encode("utf-8", "replace")
        size = max(1, len(raw))
        mixed = MIXED.findall(text)
        behind = sum(self.weight(m.lower().translate(LOOKALIKE).translate({42: None, 45: None, 46: None, 95: None})) >= HEAVY for m in mixed)
        return [
            hit.sum() / n, w.sum() / n, w.max(initial=0.0), math.log1p(hit.sum()), len({words[i] for i in at}), math.log1p(heavy.sum()),
            heavy.sum() / n, second.sum() / n, (gap <= NEAR).sum() / n, 1 / (1 + float(gap.min(initial=10**6))),
            (size - len(raw.translate(None, CAPITALS))) / size, len(SHOUTED.findall(text)) / n,
            raw.count(b"!") / size, raw.count(b"?") / size, (size - len(raw.translate(None, STOPS))) / size,
            len(mixed) / n, repeated.sum() / n, float(behind), math.log(n)]


def features(rows: DataFrame, lexicon: dict[str, float], keep_text: bool = False) -> DataFrame:
    """Adds ``features``; the text goes unless kept, the other columns stay."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)  # LEXICON entries of two kinds

    def start():
        f = _Features(shared.value)
        return lambda texts: [[f.of(t) for t in texts]]

    return map_texts(rows, {"features": T.ArrayType(T.DoubleType())}, start, keep_text)


def _raw(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows.withColumn("vector", array_to_vector("features"))).withColumn(
        "raw", vector_to_array("probability")[1]).drop("vector", "rawPrediction", "probability", "prediction")


def score(rows: DataFrame, labels: DataFrame, column: str = "toxic", keep_text: bool = False) -> DataFrame:
    """Adds ``score`` to the rows (``doc_id``, ``text`` and columns to keep),
    learnt from the rows with labels outside fold 0.

    A null text counts as empty and is scored like one.  If one of the classes
    has no labelled text, every score is the smoothed share of label 1.
    """
    known = training_labels(labels, column, TRAIN_ROWS, "toxicity-labels")
    texts = rows.select(F.col("doc_id").alias("_id"), "text")
    # about TRAIN_ROWS rows of two numbers
    labelled = texts.join(F.broadcast(known), texts["_id"] == known["doc_id"])
    lexicon = learn_lexicon(labelled.where(F.col("fold") != CALIBRATION_FOLD))
    table = saved(features(rows, lexicon, keep_text), "toxicity-features")
    train = table.select(F.col("doc_id").alias("_id"), "features").join(F.broadcast(known), F.col("_id") == known["doc_id"]).select(
        "features", "fold", F.col("label").cast("double").alias("label"))
    train = saved(train, "toxicity-training")
    have = {(r["label"], r["cal"]): r["n"] for r in train.groupBy(
        "label", (F.col("fold") == CALIBRATION_FOLD).alias("cal")).agg(F.count("*").alias("n")).collect()}
    pos, neg = (sum(n for (y, _), n in have.items() if y == k) for k in (1.0, 0.0))
    if not have.get((1.0, False)) or not have.get((0.0, False)):
        return table.drop("features").withColumn("score", F.lit((pos + 1) / (pos + neg + 2)))
    fit = train.where(F.col("fold") != CALIBRATION_FOLD).withColumn("vector", array_to_vector("features"))
    trees = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP,
                          minInstancesPerNode=max(1, min(LEAST_ROWS, have[1.0, False] // 4)), seed=7).fit(fit.select("vector", "label"))
    scored = _raw(trees, table).drop("features")
    if not have.get((1.0, True)) or not have.get((0.0, True)):
        return scored.withColumnRenamed("raw", "score")
    held = _raw(trees, train.where(F.col("fold") == CALIBRATION_FOLD)).select("raw", "label")
    steps = IsotonicRegression(featuresCol="raw", labelCol="label").fit(held)
    return steps.transform(scored).withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prediction")))).drop("raw", "prediction")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold_of(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "text")
    return score(rows, labels).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
