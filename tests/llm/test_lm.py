"""What the language model learns from."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradecast.llm import attention, lm
from tradecast.llm.common import fold_of


def test_every_training_document_is_learnt_from(spark):
    one = spark.range(4).select(F.col("id").alias("doc_id"), F.lit("the cat sat on the mat and the dog " * 3).alias("text"))
    start = lm.pack(attention.new_parameters())
    for i in range(4):
        assert lm.pack(lm.fit(one.where(F.col("doc_id") == i))) != start


def test_without_a_network_the_score_is_the_base_score(spark):
    docs = spark.range(30).withColumnRenamed("id", "doc_id")
    held_out = fold_of(F.col("doc_id"), lm.FOLDS) == lm.HELD_OUT
    docs = docs.withColumn("text", F.when(held_out, F.lit("a text held out")))
    got = lm.score(docs).collect()
    assert len(got) == 30 and {r["held_out"] for r in got} == {True, False}
    for r in got:
        assert r["score"] == pytest.approx(r["base_score"], rel=1e-12) and r["base_score"] < 0


def test_faster_kernels_give_what_the_plain_formulas_give():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((40, 7, 32)).astype(np.float32)
    x[3] -= 500  # rows far below the others have a shift of their own
    x[5, 2, 4:] = -1e9
    e = np.exp(x.astype(float) - x.max(-1, keepdims=True))
    assert np.allclose(attention.softmax(x.copy()), e / e.sum(-1, keepdims=True), atol=1e-6)
    for texts in ([], [b""], [b"", b"The the cat THE", b"z" * 3000 + b" a bc " + b"y" * attention.SHORT + b" " + b"x" * (attention.SHORT + 1)]):
        t = attention.tokenize(texts)
        words = [w for text in texts for w in [*text.lower().split(), None]]
        assert len(t.at) == len(words) and t.length.sum() == len(words)
        assert len(set(zip(words, t.at.tolist()))) == len(set(words)) == len(set(t.at.tolist()))
        p = attention.new_parameters()
        plain = [p["subword"][t.ids[a:b]].astype(float).mean(0) for a, b in zip(t.first[:-1], t.first[1:])]
        assert np.allclose(attention.vectors(p, t.ids, t.first), plain, atol=1e-5)
