"""Held-out accuracy of what is learnt, and the language model against counts."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tradecast.llm import attention, bpe, nearest, quality, queries, toxicity
from tradecast.llm.common import table

SF = "/root/testdata/sf0.01"


def auc(score, label):
    order = score.rank()
    n = label.sum()
    return (order[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


@pytest.fixture(scope="module")
def truth(spark):
    return table(spark, SF, "documents").select("doc_id", "lang", "text").join(table(spark, SF, "labels"), "doc_id", "left").toPandas()


def test_language_held_out(spark, truth):
    out = queries.op9_language_id(spark, SF).toPandas().merge(truth, on="doc_id")
    held = out[out["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.98
    assert (out["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in out["doc_id"]]).all()


@pytest.mark.parametrize("name,column,least", [("op2_zstd_quality", "quality", 0.95), ("op7_toxicity_gbt", "toxic", 0.75)])
def test_labels_held_out(spark, truth, name, column, least):
    out = queries.queries()[name](spark, SF).toPandas()
    assert len(out) == len(truth)
    assert (out["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out["doc_id"]]).all()
    known = out.merge(truth.dropna(subset=[column]), on="doc_id")
    held = known[known["held_out"]]
    assert auc(held["score"], held[column]) > least
    if column == "toxic":  # clean documents are left alone
        assert known[known["toxic"] == 0]["predicted"].mean() < 0.02


def test_lm_base_is_exact_and_model_is_better(spark, truth):
    out = queries.op3_attention_lm(spark, SF).toPandas().set_index("doc_id")
    tokens = {k: (t or "").encode().lower().split() + [None] for k, t in zip(truth["doc_id"], truth["text"], strict=True)}
    counts = Counter()
    for k, t in tokens.items():
        if zlib.crc32(str(k).encode()) % 7 != 2:
            counts.update(t)
    n, v = sum(counts.values()), len(counts)
    for k, t in tokens.items():
        r = out.loc[k]
        assert r["n_tokens"] == len(t) and r["n_known"] == sum(counts[w] > 0 for w in t) and r["train_tokens"] == n
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
    held = out[out["held_out"]]
    assert held["score"].sum() > held["base_score"].sum()
    assert (held["score"] > held["base_score"]).mean() > 0.9


def test_attention_gradient():
    texts = [b"the cat sat on the mat and the dog", b"un chat et un chien", b"x " * 70]
    p = {k: v.astype(np.float64) for k, v in attention.new_parameters().items()}
    t = attention.tokenize(texts)
    w = attention.windows(t.length)
    rows = np.arange(len(w.step))
    _, g = attention.gradient(p, t, w, rows)
    for k in p:
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        ends = []
        for d in (1e-5, -1e-5):
            q = {a: b.copy() for a, b in p.items()}
            q[k][at] += d
            ends.append(attention.gradient(q, t, w, rows)[0])
        assert g[k][at] == pytest.approx((ends[0] - ends[1]) / 2e-5, rel=1e-3)


def test_attention_is_causal_and_scores_once():
    texts = [b" ".join(b"w%d" % (i * i % 37) for i in range(n)) for n in (0, 1, 31, 32, 33, 200)]
    t = attention.tokenize(texts)
    w = attention.windows(t.length)
    assert np.bincount(w.step[w.scored], minlength=len(t.at)).tolist() == [1] * len(t.at)
    p = attention.new_parameters()
    a = attention.lifts(p, np.full(attention.CLASSES, 1 / attention.CLASSES), t)
    changed = attention.tokenize([*texts[:-1], texts[-1][:-3] + b"zzz"])
    b = attention.lifts(p, np.full(attention.CLASSES, 1 / attention.CLASSES), changed)
    assert np.allclose(a[:-2], b[:-2]) and not np.isclose(a[-2], b[-2])


def test_lifted_counts_are_a_distribution():
    """Over the known tokens, the lift leaves the sum of the counts as it is."""
    t = attention.tokenize([b"a b c d e f g " * 9, b"h i j k a b " * 7])
    n = np.bincount(t.at)
    p = attention.new_parameters()
    q = attention.classes(p, attention.vectors(p, t.ids, t.first))
    mean = (n @ q) / n.sum()
    for context in np.eye(attention.CLASSES)[:5]:
        assert (n * (q / mean @ context)).sum() == pytest.approx(n.sum(), rel=1e-5)


def test_bpe_against_the_library(spark):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", None, "Hello  world's end 　x\x1c\x85 12٠² \U0001f600\U0001f600!!  \n\n a", "aaaaaaaaaa" * 50, "Ünïcödé straße", "<|endoftext|>",
             "onhe. The cat", "\t\tdef f(x):\n    return x  \n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = bpe.encode(df, ranks, public_tokenizers.PATTERN)
    back = coded.withColumn("bytes", bpe.decode(F.col("ids"), ranks)).collect()
    for r in back:
        assert r["ids"] == known.encode_ordinary(r["text"] or "")
        assert bytes(r["bytes"]).decode() == (r["text"] or "")


def test_bpe_folds_agree(spark):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    words = [" the", "onhe", " ouellean", "ciónarmente", "###", "x", "éê", " 1234567"]
    got = bpe.fold_words(spark.createDataFrame([(w,) for w in words], "word string"), ranks).collect()
    assert {r["word"]: r["ids"] for r in got} == {w: bpe.fold(w.encode(), ranks) for w in words}


def test_nearest_recall(spark):
    vectors = table(spark, SF, "embeddings")
    rows = vectors.toPandas()
    x = np.stack(rows["embedding"].to_numpy()).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    got = nearest.nearest(vectors).toPandas()
    hits = total = 0
    for i in np.flatnonzero(rows["vec_id"] % 50 == 0):
        s = x @ x[i]
        s[i] = -2
        best = set(rows["vec_id"].to_numpy()[np.argsort(-s)[:5]])
        mine = got[got["query_id"] == rows["vec_id"][i]].sort_values("rank")
        hits += len(best & set(mine["vec_id"]))
        total += 5
        assert mine["score"].is_monotonic_decreasing and mine["rank"].tolist() == [1, 2, 3, 4, 5]
    assert hits / total >= 0.9


def test_stop_ratio():
    rng = np.random.default_rng(1)
    d = rng.standard_normal((200_000, nearest.DIMS))
    assert ((d * d).sum(1) <= nearest.stop_ratio()).mean() == pytest.approx(nearest.CONFIDENCE, abs=0.003)


def test_compression_and_features():
    c = quality._Compressor((b"### $$$ &&& %%% " * 200, b"the cat sat on the mat with a hat " * 200))
    assert c.difference("the cat sat on the mat with a hat") > 0 > c.difference("### $$$ &&& %%% ###")
    assert c.difference(None) == c.difference("") == 0
    f = toxicity._Features({"idiot": 4.0, "lowei*": 5.0})
    names = toxicity.FEATURES
    got = dict(zip(names, f.of("You IDIOT!! loweichen 1d10t"), strict=True))
    assert got["distinct entries"] == 2 and got["heaviest entry"] == 5 and got["hits near a second person"] > 0
    assert got["hits behind lookalikes"] == 1 and got["exclamation marks"] > 0 and got["shouted words"] > 0
    assert len(f.of(None)) == len(names)
