from __future__ import annotations

import hashlib
import re
from statistics import mean

from pyspark.sql import functions as F

from tradecast.llm import sketch

SF = "/root/testdata/sf0.001"


def shingles(text: str) -> set[tuple[str, ...]]:
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    if len(words) < sketch.SHINGLE:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + sketch.SHINGLE]) for i in range(len(words) - sketch.SHINGLE + 1)}


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def test_likeness_against_all_shingles(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # also cut to short texts, whose sketches hold few hashes
    short = docs.withColumns({"doc_id": F.col("doc_id") + 10**6, "text": F.substring_index("text", " ", 40)})
    both = docs.unionByName(short)
    texts = sorted(((r["doc_id"], r["text"] or "") for r in both.select("doc_id", "text").collect()), reverse=True)
    got = {r["doc_id"]: r for r in sketch.fingerprints(both).collect()}
    assert len(got) == len(texts)
    errors: dict[str, list[float]] = {"short": [], "long": []}
    contained = []
    for i, (k, text) in enumerate(texts):
        after, half = texts[(i + 1) % len(texts)][1], len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[k]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        mine, turned, other = shingles(text), shingles(edited), shingles(after)
        kind = "short" if len(mine) < 100 else "long"
        errors[kind] += [abs(r["near_edited"] - jaccard(mine, turned)), abs(r["near_next"] - jaccard(mine, other))]
        contained.append(abs(r["containment_next"] - (len(mine & other) / len(mine) if mine else 1.0)))
    near = {k: [e for e in v if e > 0] for k, v in errors.items()}
    assert len(near["short"]) > 100 and len(near["long"]) > 50
    assert mean(near["short"]) < 0.06 and mean(near["long"]) < 0.03, {k: (mean(v), max(v)) for k, v in near.items()}
    assert mean(contained) < 0.02


def test_sketches_merge(spark):
    words = [f"w{i}" for i in range(300)]
    a, b, whole = " ".join(words[:180]), " ".join(words[120:]), " ".join(words)
    df = spark.createDataFrame([(a, b, whole, a.upper(), "", "one two")], "a string, b string, whole string, upper string, empty string, short string")
    r = df.select(*[sketch.sketch(F.col(c)).alias(c) for c in df.columns]).select(
        "*", sketch.merge(F.col("a"), F.col("b")).alias("both"), sketch.merge(F.col("a"), F.col("empty")).alias("same"),
        sketch.containment(F.col("a"), F.col("whole")).alias("part"), sketch.likeness(F.col("empty"), F.col("empty")).alias("none"),
        sketch.likeness(F.col("a"), F.col("empty")).alias("apart")).first()
    assert r["both"] == r["whole"] and r["same"] == r["a"] == r["upper"]
    assert r["part"] == 1.0 and r["none"] == 1.0 and r["apart"] == 0.0
    assert r["empty"] == [] and len(r["short"]) == 1
    assert all(h < (1 << sketch.BITS) // sketch.FRACTION for h in r["whole"])
    # unequal texts: a short one wholly inside a long one
    one = spark.createDataFrame([(" ".join(words[40:90]), whole)], "a string, b string").select(
        sketch.containment(sketch.sketch(F.col("a")), sketch.sketch(F.col("b"))).alias("c")).first()
    assert one["c"] == 1.0


def test_rows_of_one_id_and_of_none(spark):
    rows = [(7, "a b c d e f"), (7, "g h i j k l"), (7, "a b c d e f"), (None, "m n o p q r"), (None, None), (1, "s t u v w x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def run(d):
        return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_chars"], r["fingerprint"], r["edited_sha256"], r["near_next"]) for r in sketch.fingerprints(d).collect())
    first = run(df)
    assert len(first) == len(rows) and first == run(df.repartition(5)) == run(spark.createDataFrame(rows[::-1], df.schema))
    # every edited text is one text with the end of it replaced by the start of another
    texts = [t or "" for _, t in rows]
    able = {hashlib.sha256((t[:len(t) - len(t) // 2] + u[:len(t) // 2]).encode()).hexdigest() for t in texts for u in texts}
    assert {r[4] for r in first} <= able
