"""LM scoring: a causal self-attention model over subword ids, on top of the
word counts of the whole corpus.

The probability of a token is (count * lift + 1) / (N + V + 1): the smoothed
share of the token in all training tokens, times how much likelier than on
average the attention model takes it to be after the tokens before it.  The
lift of a class is relative to its mean over all training tokens, so that the
probabilities of all tokens have the same sum with the lift as without.

* The network is fitted by parameter averaging: every training document is dealt
  to a round and to a group of bounded size, every group of a round goes on from
  the common parameters in numpy, and the mean of what they find is the next
  start.  So each document is learnt from once.
* Documents are dealt to chunks by a hash.  Every chunk sends its distinct
  tokens (as 64-bit hashes) with their counts to the task of their range, and
  gets the counts of the whole corpus back.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradecast.llm import attention as A
from tradecast.llm.common import fold_of, saved

ROUNDS = 3                # training documents are dealt to so many rounds
RATES = (0.01, 0.01, 0.003)
GROUP_BYTES = 2 << 20     # text of a group that fits the network, about
AVERAGED = 32             # models averaged in one task
CHUNK_BYTES = 8 << 20     # text of a chunk, about
RANGE_TOKENS = 1_000_000  # distinct tokens of chunks that meet in a range, about
BATCH_BYTES = 1 << 20     # text turned to tokens at a time
HELD_OUT, FOLDS = 2, 7

Parameters = dict[str, np.ndarray]


def pack(p: Parameters) -> bytes:
    return np.concatenate([p[k].ravel() for k in sorted(p)]).astype(np.float32).tobytes()


def unpack(raw: bytes) -> Parameters:
    flat, out, at = np.frombuffer(raw, np.float32), {}, 0
    like = A.new_parameters()
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).copy()
        at += like[k].size
    return out


def _raw(texts: pd.Series) -> list[bytes]:
    return [t.encode("utf-8", "replace") if t else b"" for t in texts]


def _batches(texts: list[bytes]) -> list[slice]:
    out, start, size = [], 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > BATCH_BYTES:
            out.append(slice(start, i))
            start, size = i, 0
        size += len(t) + 1
    return [*out, slice(start, len(texts))] if texts else out


def fit(rows: DataFrame) -> Parameters | None:
    """Network parameters from the training rows (``doc_id``, ``text``); None if
    none has a text."""
    spark = rows.sparkSession
    known = rows.where(F.col("text").isNotNull())
    size = known.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    if not size:
        return None
    groups = max(1, math.ceil(size / ROUNDS / GROUP_BYTES))
    picked = known.select("text", F.xxhash64(F.lit("lm"), "doc_id", "text").alias("h"))
    dealt = picked.withColumn("g", F.pmod(F.xxhash64("h"), F.lit(groups)).cast("int"))
    p = A.new_parameters()
    for turn, rate in zip(range(ROUNDS), RATES, strict=True):
        start = spark.sparkContext.broadcast(pack(p))  # a megabyte
        mine = dealt.where(F.pmod("h", F.lit(ROUNDS)) == turn)
        models = saved(mine.groupBy("g").applyInPandas(_further(start, turn, rate), "g int, w double, p binary"), "lm-models")
        left = groups
        while left > 1:
            models = saved(models.withColumn("g", F.floor(F.col("g") / AVERAGED).cast("int")).groupBy("g").applyInPandas(
                _mean, "g int, w double, p binary"), "lm-models")
            left = -(-left // AVERAGED)
        found = models.first()
        if found is not None:  # no document of a small table may fall to a round
            p = unpack(found["p"])
    return p


def _further(start, turn: int, rate: float):
    """A function that trains on from the common parameters on one group."""

    def run(x: pd.DataFrame) -> pd.DataFrame:
        texts = _raw(x.sort_values("h")["text"])
        g = int(x["g"].iloc[0])
        found, _ = A.train(unpack(start.value), texts, 1000 * turn + g, rate)
        return pd.DataFrame([(g, float(sum(map(len, texts)) + 1), pack(found))], columns=["g", "w", "p"])

    return run


def _mean(x: pd.DataFrame) -> pd.DataFrame:
    x = x.sort_values("w")
    w = x["w"].to_numpy()
    total = sum(np.frombuffer(p, np.float32).astype(np.float64) * v for p, v in zip(x["p"], w, strict=True)) / w.sum()
    return pd.DataFrame([(int(x["g"].iloc[0]), float(w.sum()), total.astype(np.float32).tobytes())], columns=["g", "w", "p"])


def _merged(tokens: list[A.Tokens], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of all batches, ascending, with the sums of their counts."""
    every = np.concatenate([t.hash for t in tokens])
    key, at = np.unique(every, return_inverse=True)
    return key, np.bincount(at, np.concatenate(counts), len(key)).astype(np.int64)


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for
    every row of ``docs`` (``doc_id``, ``text``).

    A null text counts as empty: its only token is the end.  Repeated rows
    count as often as they come.  Without a training text there is no network,
    and the score is the base score; with nothing to learn from both are 0.  An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    no_id = F.lit((1 << 63) - 1)  # pandas has no null integers
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), no_id).alias("doc_id"), "text", (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"))
    parameters = fit(rows.where(~F.col("held_out")))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / CHUNK_BYTES))
    bits = min(24, max(3, math.ceil(math.log2(max(1, size / 50 / RANGE_TOKENS)))))  # a chunk has a distinct token in some fifty bytes
    base = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.coalesce("text", F.lit(""))), F.lit(chunks)).cast("int")).repartition(chunks, "chunk")
    network = spark.sparkContext.broadcast(pack(parameters) if parameters else b"")

    def send(x: pd.DataFrame) -> pd.DataFrame:
        p = unpack(network.value) if network.value else None
        texts, learn = _raw(x["text"]), ~x["held_out"].to_numpy()
        tokens, counts, classes = [], [], np.zeros(A.CLASSES)
        for b in _batches(texts):
            t = A.tokenize(texts[b])
            n = np.bincount(t.at, np.repeat(learn[b], t.length), len(t.hash))
            if p:
                classes += n @ A.classes(p, A.vectors(p, t.ids, t.first)).astype(np.float64)
            tokens.append(t)
            counts.append(n)
        key, n = _merged(tokens, counts)
        ends = np.searchsorted(key, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).tolist() + [len(key)]
        chunk = int(x["chunk"].iloc[0])
        out = [(r, chunk, key[a:b].tobytes(), n[a:b].tobytes()) for r, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if b > a]
        return pd.DataFrame([*out, (-1, chunk, classes.tobytes(), b"")], columns=["range", "chunk", "key", "n"])

    def answer(x: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(k, np.uint64) for k in x["key"]]
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(at, np.concatenate([np.frombuffer(v, np.int64) for v in x["n"]]), len(distinct)).astype(np.int64)
        out, done = [], 0
        for i, (chunk, k) in enumerate(zip(x["chunk"], keys, strict=True)):
            first = i == 0
            out.append((int(chunk), int(x["range"].iloc[0]), n[at[done:done + len(k)]].tobytes(),
                        int(n.sum()) if first else 0, int((n > 0).sum()) if first else 0))
            done += len(k)
        return pd.DataFrame(out, columns=["to", "range", "n", "total", "distinct"])

    sent = saved(base.groupBy("chunk").applyInPandas(send, "range int, chunk int, key binary, n binary"), "lm-sent")
    counted = saved(sent.where("range >= 0").groupBy("range").applyInPandas(
        answer, "to int, range int, n binary, total long, distinct long"), "lm-counts")
    sums = counted.agg(F.sum("total").alias("n"), F.sum("distinct").alias("v")).first()
    total, distinct = sums["n"] or 0, sums["v"] or 0
    mean = _class_sums(sent) / max(1, total)
    space = math.log10(total + distinct + 1)

    def finish(x: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        if not len(x):
            return pd.DataFrame(columns=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])
        p = unpack(network.value) if network.value else None
        texts = _raw(x["text"])
        batches = _batches(texts)
        tokens = [A.tokenize(texts[b]) for b in batches]
        key, _ = _merged(tokens, [np.zeros(len(t.hash)) for t in tokens])
        n = np.concatenate([np.frombuffer(v, np.int64) for v in have.sort_values("range")["n"]])
        out = []
        for t in tokens:
            c = n[np.searchsorted(key, t.hash)][t.at].astype(float)
            lift = A.lifts(p, mean, t).astype(float) if p else np.ones(len(t.at))
            text = np.repeat(np.arange(len(t.length)), t.length)
            out.append(np.stack([t.length, np.bincount(text, c > 0, len(t.length)),
                                 np.bincount(text, np.log10(c + 1) - space, len(t.length)),
                                 np.bincount(text, np.log10(c * lift + 1) - space, len(t.length))], 1))
        every = np.concatenate(out)
        return pd.DataFrame({"doc_id": x["doc_id"], "held_out": x["held_out"], "n_tokens": every[:, 0].astype(np.int64),
                             "n_known": every[:, 1].astype(np.int64), "base_score": every[:, 2], "score": every[:, 3]})

    fields = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    scored = base.groupBy("chunk").cogroup(counted.groupBy("to")).applyInPandas(finish, fields)
    return scored.select(F.nullif("doc_id", no_id).alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def _class_sums(sent: DataFrame) -> np.ndarray:
    """Sums over all chunks of the class shares of their training tokens."""

    def add(parts):
        total = np.zeros(A.CLASSES)
        for x in parts:
            for k in x["key"]:
                total += np.frombuffer(k, np.float64)
        yield pd.DataFrame({"i": np.arange(A.CLASSES), "s": total})

    rows = sent.where("range = -1").select("key").mapInPandas(add, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    out = np.zeros(A.CLASSES)
    for r in rows:
        out[r["i"]] = r["s"]
    return out
