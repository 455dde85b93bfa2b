"""Every operator on nulls, empty and long texts, ties, repeated rows, extra
columns with clashing names, and empty tables."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tradecast.llm import bpe, jaccard, langid, lm, mixing, nearest, quality, shard, sketch, toxicity

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "score double, size long, features string, digest string, n long, raw string, _pid int")
PROSE = {"en": "the cat and the dog of that house were here and there with all the rest",
         "de": "der hund und die katze sind nicht hier aber der mann ist dort mit dem kind",
         "fr": "le chat et le chien de la maison sont ici avec les enfants dans la rue"}


def _rows():
    rows = []
    for i in range(60):
        lang = list(PROSE)[i % 3]
        words = PROSE[lang].split()
        text = " ".join(words[(i * 7 + k * (1 + i % 5)) % len(words)] for k in range(20 + i)) + f" n{i}."
        if i % 10 == 0:
            text += " you stupid idiot"
        rows.append((i, text, lang, f"s{i % 4}"))
    long_text = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    rows += [(100, None, "en", "s0"), (101, "", "en", None), (102, " \t\n ", None, "s1"), (103, long_text, "en", "s2"),
             (104, "one two", "en", "s3"), (105, "ONE  two", "en", "s3"), (106, "x" * 50_000, None, "s1"), (107, "12 34 !!", "de", "s1"),
             (None, "a text without an id but with words enough for a shingle", "en", "s0"), (None, None, None, None)]
    rows += [rows[3], rows[3], (3, "another text under the id of three, which differs", "en", "s1")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, len(r[1]) if r[1] else None, 0.5, 7, "f", "d", 1, "r", 3) for r in _rows()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i % 3 != 0), int(i % 10 == 0)) for i in range(60)] + [(3, 1, 0), (None, 1, 1), (4, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
OPERATORS = {
    "shard": lambda d, x: shard.minimax_shards(d, 8),
    "quality": quality.classify,
    "lm": lambda d, x: lm.score(d),
    "sketch": lambda d, x: sketch.fingerprints(d),
    "mix": lambda d, x: mixing.mix_counts(d),
    "jaccard": lambda d, x: jaccard.join_components(d),
    "toxicity": toxicity.classify,
    "language": lambda d, x: langid.identify(d),
    "bpe": lambda d, x: bpe.digests(d, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_for_each(name, docs, labels):
    out = OPERATORS[name](docs, labels).collect()
    assert sorted(r["doc_id"] is None for r in out) == sorted(r[0] is None for r in _rows())
    assert sorted(r["doc_id"] for r in out if r["doc_id"] is not None) == sorted(r[0] for r in _rows() if r[0] is not None)
    for c in ("score", "near_edited", "near_next"):
        if c in out[0].asDict() and name != "lm":
            assert all(0 <= r[c] <= 1 for r in out)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(name, empty, no_labels):
    assert OPERATORS[name](empty, no_labels).count() == 0


@pytest.mark.parametrize("name", ["quality", "toxicity"])
def test_no_labels_gives_one_score(name, docs, no_labels):
    assert {r["score"] for r in OPERATORS[name](docs, no_labels).collect()} == {0.5}


def test_language_is_und_without_letters(docs):
    out = {r["doc_id"]: r for r in langid.identify(docs).collect() if r["doc_id"] is not None}
    assert all(out[i]["lang_pred"] == "und" and out[i]["score"] == 0 for i in (100, 101, 102, 107))
    right = [out[i]["lang_pred"] == list(PROSE)[i % 3] for i in range(60)]
    assert sum(right) >= 58


def test_mix_documents_follows_the_counts(docs):
    counted = mixing.mix_counts(docs)
    taken = {r["s"]: r["t"] for r in docs.select("doc_id", "source", "text").join(
        counted.groupBy("doc_id", "size").agg(F.max("taken").alias("t")), "doc_id").groupBy(F.lit(1).alias("s")).agg(F.sum("t").alias("t")).collect()}
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    rows = mixed.collect()
    words = sum(len(r["text"].split()) for r in rows)
    assert words == counted.agg(F.sum("taken")).first()[0]
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert taken


def test_jaccard_representatives(docs):
    out = jaccard.join_components(docs).collect()
    by = {}
    for r in out:
        by.setdefault((r["doc_id"], r["text_hash"]), r)
    assert {r["component_id"] for r in out if r["doc_id"] in (104, 105)} == {104}
    assert all(r["n_shingles"] == 0 and r["component_id"] == r["doc_id"] for r in out if r["doc_id"] in (100, 101, 102))
    assert [r["component_id"] for r in out if r["doc_id"] is None and r["n_shingles"]] == [None]


def test_nearest_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [3.0, 0.0]), (8, [3.0, 0.0]), (9, [1.0, 2.0, 3.0]), (100, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    out = nearest.nearest(df).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 12)) for r in out] == [
        (0, 1, 1, 1.0), (0, 2, 8, 1.0), (0, 3, 50, 1.0), (0, 4, 2, 0.0), (50, 1, 0, 1.0), (50, 2, 1, 1.0), (50, 3, 8, 1.0), (50, 4, 2, 0.0)]
    assert nearest.nearest(df.where("false")).count() == 0


def test_edited_text(docs):
    rows = sorted(((r[0], r[1] or "") for r in _rows() if r[0] is not None and r[0] >= 100), reverse=True)
    part = docs.where(F.col("doc_id") >= 100)
    out = {r["doc_id"]: r for r in sketch.fingerprints(part).collect()}
    for i, (k, text) in enumerate(rows):
        after, half = rows[(i + 1) % len(rows)][1], len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert out[k]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert out[k]["n_chars"] == len(text)
    assert out[104]["fingerprint"] == out[105]["fingerprint"]  # equal words


def test_nearest_of_an_id_with_several_vectors(spark):
    rows = [(50, [1.0, 0.0, 0.1]), (50, [0.0, 1.0, 0.1]), (50, [0.0, 1.0, 0.1]), (1, [1.0, 0.1, 0.0]), (2, [0.1, 1.0, 0.0]), (3, [0.0, 0.9, 0.2])]
    answers = set()
    for parts in (1, 2, 5):
        for turned in (rows, rows[::-1]):
            df = spark.createDataFrame(turned, "vec_id long, embedding array<double>").repartition(parts)
            answers.add(tuple((r["vec_id"], round(r["score"], 9)) for r in nearest.nearest(df).orderBy("rank").collect()))
    # it asks with [0, 1, 0.1]
    assert len(answers) == 1 and [i for i, _ in next(iter(answers))] == [3, 2, 1]
