"""Language ID: word-first backoff.

A known word is scored by its log frequency in each language; an unseen word
by its character n-grams, the longest order with a known n-gram first.  The
language with the best mean over the words wins.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradecast.llm.common import fold_of, map_texts

TRAIN_ROWS = 20_000   # documents per language the model is fitted on, about
TOP_WORDS = 20_000    # known words per language
TOP_GRAMS = 5_000     # known n-grams per language and order
ORDERS = (4, 3, 2, 1)
PENALTY = 7.0         # -log10 frequency of what a language has not seen
EVIDENCE = 10         # words after which the score grows no more
MEMO = 200_000        # unseen words a task remembers

LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    words = LETTERS.findall(text.lower())
    if not all(map(str.isalpha, words)):
        words = [w for w in words if any(map(str.isalpha, w))]
    return words


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of a word between blanks."""
    if n == 1:
        return list(word)
    padded = f" {word} "
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


@dataclass
class Model:
    langs: list[str]
    prior: np.ndarray                 # documents per language
    words: dict[str, int]             # row of ``scores``
    grams: dict[str, int]
    scores: np.ndarray                # log10 frequency, entries x languages


def _count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, Counter] = {}
    for p in parts:
        for lang, text in zip(p["lang"], p["text"], strict=True):
            if text:
                counts.setdefault(lang, Counter()).update(words_of(text))
    for lang, c in counts.items():
        if c:
            yield pd.DataFrame({"lang": lang, "word": list(c.keys()), "n": list(c.values())})


def _grams(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[tuple[str, int], Counter] = {}
    for p in parts:
        for lang, word, n in zip(p["lang"], p["word"], p["n"], strict=True):
            for k in ORDERS:
                c = counts.setdefault((lang, k), Counter())
                for g in grams_of(word, k):
                    c[g] += n
    for (lang, k), c in counts.items():
        if c:
            yield pd.DataFrame({"lang": lang, "k": k, "gram": list(c.keys()), "n": list(c.values())})


def _frequent(counts: DataFrame, most: int) -> DataFrame:
    """For each (``lang``, ``k``), the entries whose count ``n`` is so high that
    no more than ``most`` have it.  The cut is read off a histogram of about a
    thousand steps, so no task ranks a language's entries."""
    step = F.when(F.col("n") < 500, F.col("n")).otherwise(F.floor(F.log(F.col("n").cast("double")) * 100)).cast("int")
    stepped = counts.withColumn("step", step)
    sizes: dict[tuple[str, int], list[tuple[int, int]]] = {}
    for r in stepped.groupBy("lang", "k", "step").agg(F.count("*").alias("m")).collect():
        sizes.setdefault((r["lang"], r["k"]), []).append((r["step"], r["m"]))
    keep = F.lit(False)
    for (lang, k), steps in sizes.items():
        left, low = most, None
        for at, m in sorted(steps, reverse=True):
            left -= m
            if left < 0:
                break
            low = at
        if low is not None:
            keep = keep | ((F.col("lang") == lang) & (F.col("k") == k) & (F.col("step") >= low))
    return stepped.where(keep)


def fit(rows: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Fits on rows (``doc_id``, ``text``, ``lang``) with neither null, on about
    ``train_rows`` documents of each language, chosen by a hash of the id."""
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    per = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(per)
    if not langs:
        return Model([], np.zeros(0), {}, {}, np.zeros((0, 0), np.float32))
    share = F.lit(1.0)
    for lang, n in per.items():
        if n > train_rows:
            share = F.when(F.col("lang") == lang, F.lit(train_rows / n)).otherwise(share)
    picked = rows.where((F.xxhash64(F.lit("langid"), "doc_id") / F.lit(2.0 ** 64) + 0.5) < share)
    words = (picked.select("lang", "text").mapInPandas(_count, "lang string, word string, n long")
             .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    words = words.persist()
    grams = (words.mapInPandas(_grams, "lang string, k int, gram string, n long")
             .groupBy("lang", "k", "gram").agg(F.sum("n").alias("n"))).persist()
    totals = {(r["lang"], 0): r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    totals |= {(r["lang"], r["k"]): r["n"] for r in grams.groupBy("lang", "k").agg(F.sum("n").alias("n")).collect()}
    top_words = _frequent(words.where("n > 1").withColumn("k", F.lit(0)), TOP_WORDS)
    top_grams = _frequent(grams, TOP_GRAMS)
    # at most TOP_WORDS + 4 * TOP_GRAMS entries per language
    # and as Arrow columns, not as rows, on the driver
    known = top_words.select("lang", "k", F.col("word").alias("s"), "n").unionByName(
        top_grams.select("lang", "k", F.col("gram").alias("s"), "n")).toArrow()
    words.unpersist()
    grams.unpersist()
    order, text = known["k"].to_numpy(), known["s"].to_pylist()
    column = np.searchsorted(langs, known["lang"].to_numpy(zero_copy_only=False).astype(str)) if len(text) else np.zeros(0, int)
    share = np.log10(known["n"].to_numpy() / np.array([totals[x] for x in zip(known["lang"].to_pylist(), order.tolist(), strict=True)], float))
    index: tuple[dict[str, int], dict[str, int]] = ({}, {})
    row = np.array([index[k > 0].setdefault(s, len(index[0]) + len(index[1])) for k, s in zip(order.tolist(), text, strict=True)], int)
    scores = np.full((len(index[0]) + len(index[1]), len(langs)), -PENALTY, np.float32)
    scores[row, column] = share
    return Model(langs, np.array([per[x] for x in langs], float), index[0], index[1], scores)


class _Scorer:
    """Scores texts in a task; remembers the unseen words it has met."""

    def __init__(self, model: Model):
        self.m, self.memo, self.more = model, {}, []

    def unseen(self, word: str) -> np.ndarray | None:
        for k in ORDERS:
            rows = [r for g in grams_of(word, k) if (r := self.m.grams.get(g)) is not None]
            if rows:
                return self.m.scores[rows].mean(0)
        return None

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text) if text else []
        if not words or not self.m.langs:
            return "und", 0.0
        rows = list(map(self.m.words.get, words))
        total, n = np.zeros(len(self.m.langs)), 0
        if None in rows:
            missing = [w for w, r in zip(words, rows, strict=True) if r is None]
            rows = [r for r in rows if r is not None]
            for w in missing:
                s = self.memo.get(w, w)
                if s is w:
                    if len(self.memo) >= MEMO:
                        self.memo.clear()
                    s = self.memo[w] = self.unseen(w)
                if s is not None:
                    total += s
                    n += 1
        if rows:
            total += self.m.scores[rows].sum(0, dtype=np.float64)
            n += len(rows)
        prior = np.log10(self.m.prior / self.m.prior.sum())
        evidence = (total / n * min(n, EVIDENCE) if n else 0) + prior * 1e-3
        p = 10.0 ** (evidence - evidence.max())
        best = int(evidence.argmax())
        return self.m.langs[best], float(p[best] / p.sum())


def predict(docs: DataFrame, model: Model, keep_text: bool = True) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to the rows of ``docs`` (``text``; other
    columns are kept, those two replaced; ``keep_text=False`` drops the text).

    A null text, or one without a letter, is ``und`` with score 0, and so is
    every text if there was nothing to learn from.  The score is the winner's
    share of the likelihood, with ten words' evidence at most.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: see ``fit``

    def start():
        scorer = _Scorer(shared.value)
        return lambda texts: list(zip(*map(scorer.predict, texts), strict=True))

    return map_texts(docs, {"lang_pred": T.StringType(), "score": T.DoubleType()}, start, keep_text)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``, learnt from
    the rows whose fold of three is not 1."""
    model = fit(docs.where(fold_of(F.col("doc_id"), 3) != 1))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), "text")
    return predict(rows, model, keep_text=False)
