"""Quality: a compression classifier.

Two zstandard dictionaries are built, from good and from bad labelled text.
Every piece of a document is compressed with either; the difference of the
compressed sizes, over their sum, becomes a probability by logistic
calibration on labelled documents that neither dictionary has seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradecast.llm.common import fold_of, map_texts, saved
from tradecast.llm.labels import FOLDS, training_labels

TRAIN_ROWS = 60_000       # labelled documents that the model is fitted on, about
SAMPLE_BYTES = 8_000_000  # text per class that a dictionary is built from, about
CALIBRATION_FOLD = 4      # folds 1 to 3 build the dictionaries
PIECE = 4096              # bytes compressed at a time, so that a long text doesn't become its own dictionary
DICTIONARY = 112_640      # bytes
LEVEL = 3


def pieces(text: str) -> list[bytes]:
    raw = text.encode("utf-8", "replace")
    return [raw[i:i + PIECE] for i in range(0, len(raw), PIECE)]


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; of too few samples for that, their plain content."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY]


class _Compressor:
    def __init__(self, dictionaries: tuple[bytes, bytes]):
        self.by = []
        for raw in dictionaries:
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            self.by.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def difference(self, text: str | None) -> float:
        """(bad size - good size) / (bad size + good size), 0 for an empty text."""
        parts = pieces(text) if text else []
        bad, good = (sum(len(c.compress(p)) for p in parts) for c in self.by)
        return (bad - good) / max(1, bad + good)


def _sample(rows: DataFrame) -> tuple[list[bytes], list[bytes]]:
    """Pieces of the texts of label 0 and of label 1, about ``SAMPLE_BYTES`` of
    each, chosen by a hash."""
    size = {r["label"]: r["b"] or 0 for r in rows.groupBy("label").agg(F.sum(F.octet_length("text")).alias("b")).collect()}
    rate = {k: min(1.0, SAMPLE_BYTES / max(1, b)) for k, b in size.items()}

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            labels, found = [], []
            for text, label, h in zip(p["text"], p["label"], p["h"], strict=True):
                if text:
                    rng = np.random.default_rng(h)
                    kept = [x for x in pieces(text) if rng.random() < rate[label]]
                    labels += [label] * len(kept)
                    found += kept
            if found:
                yield pd.DataFrame({"label": labels, "h": 0, "piece": found})

    hashed = rows.select("text", "label", F.xxhash64(F.lit("quality"), "doc_id").bitwiseAND(F.lit((1 << 62) - 1)).alias("h"))
    got = hashed.mapInPandas(run, "label int, h long, piece binary").select("label", "piece").toArrow()
    out: tuple[list[bytes], list[bytes]] = ([], [])
    for label, piece in sorted(zip(got["label"].to_pylist(), got["piece"].to_pylist(), strict=True)):
        out[label].append(piece)
    return out


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a logistic regression, slightly drawn to 0."""
    scale = max(float(np.abs(x).mean()), 1e-6)
    a = np.c_[np.ones_like(x), x / scale]
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ b))
        ridge = np.array([0.0, 1e-3])
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge + 1e-9), a.T @ (y - p) - ridge * b)
        b += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1] / scale)


def score(rows: DataFrame, labels: DataFrame, column: str = "quality") -> DataFrame:
    """Adds ``score`` to the rows (``doc_id``, ``text`` and columns to keep; the
    text is dropped), learnt from the rows with labels outside fold 0.

    A null text counts as empty; an empty text gets the calibrated score of no
    difference.  If one of the classes has no labelled text, every score is the
    smoothed share of label 1.
    """
    known = training_labels(labels, column, TRAIN_ROWS, "quality-labels")
    texts = rows.select(F.col("doc_id").alias("_id"), "text")
    # about TRAIN_ROWS rows of two numbers
    labelled = texts.join(F.broadcast(known), F.col("_id") == known["doc_id"]).where(F.col("fold") != CALIBRATION_FOLD)
    bad, good = _sample(labelled.select("doc_id", "text", "label"))
    if not bad or not good:
        have = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
        share = (have.get(1, 0) + 1) / (have.get(1, 0) + have.get(0, 0) + 2)
        return rows.drop("text").withColumn("score", F.lit(share))
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((build_dictionary(bad), build_dictionary(good)))

    def start():
        c = _Compressor(shared.value)
        return lambda texts: [[c.difference(t) for t in texts]]

    measured = saved(map_texts(rows, {"difference": T.DoubleType()}, start, keep_text=False), "quality-measured")
    # a quarter of TRAIN_ROWS, two numbers each
    held = measured.select(F.col("doc_id").alias("_id"), "difference").join(
        F.broadcast(known.where(F.col("fold") == CALIBRATION_FOLD)), F.col("_id") == F.col("doc_id")).select("difference", "label").toPandas()
    if held["label"].nunique() < 2:  # too few labels: the sign decides, in steps of a percent
        intercept, slope = 0.0, 100.0
    else:
        held = held.sort_values(["difference", "label"])
        intercept, slope = _calibrate(held["difference"].to_numpy(float), held["label"].to_numpy(float))
    z = F.lit(intercept) + F.lit(slope) * F.col("difference")
    return measured.withColumn("score", 1 / (1 + F.exp(-z))).drop("difference")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold_of(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "text")
    return score(rows, labels).select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
