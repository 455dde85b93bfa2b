"""Ranked lexical search against SQL and a direct version."""

from __future__ import annotations

import math
import re
from collections import Counter

import duckdb
import numpy as np

from tradecast.llm import search
from tradecast.llm.common import table


def brute(docs, items, top=50):
    low = str.maketrans(search.UPPER, search.LOWER)
    words = [re.findall(search.TERM, (t or "").translate(low)) for _, t in docs]
    n_docs, n_terms = sum(bool(w) for w in words), sum(map(len, words))
    df = Counter(t for w in words for t in set(w))
    out = []
    for item_id, text in dict.fromkeys(items):
        terms = set(re.findall(search.TERM, (text or "").translate(low)))
        scores = []
        for (doc_id, _), w in zip(docs, words, strict=True):
            tf = Counter(w)
            m = 100 - 50 + (50 * len(w) * n_docs) // n_terms if w else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m))
                    for t in terms if tf[t])
            if s > 0:
                scores.append((-s, doc_id is None, doc_id or 0))
        out += [(item_id, k, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def _got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


DOCS = [(1, "The cat, the DOG."), (2, None), (3, ""), (4, " .,! "), (5, "the cat, the dog"), (5, "the cat, the dog"), (6, "Éa éa 中文 cat9"),
        (None, "the cat the dog"), (None, None), (7, "x" * 60_000 + " cat"), (8, " ".join(f"w{i % 500}" for i in range(20_000))),
        (9, "bird"), (10, "bird bird"), (11, "a\x00b")]
ITEMS = [(1, "cat dog"), (1, "cat dog"), (1, "Éa"), (2, None), (3, "nowhere"), (None, "the the THE"), (4, " ".join(f"w{i}" for i in range(5_000))),
         (5, "中文"), (6, "A b")]


def _frames(spark):
    docs = spark.createDataFrame([(i, t, 5, 1, 2) for i, t in DOCS], "doc_id long, text string, n long, tf int, score long").repartition(4)
    items = spark.createDataFrame([(i, t, 1, 2) for i, t in ITEMS], "item_id long, text string, item long, rank int")
    return docs, items


def test_odd_rows_equal_brute_force(spark):
    docs, items = _frames(spark)
    assert _got(search.search(docs, items)) == brute(DOCS, ITEMS)


def test_several_groups_give_the_same(spark):
    docs, items = _frames(spark)
    assert _got(search.search(docs, items, top=2, group_entries=2_000)) == brute(DOCS, ITEMS, 2)


def test_ties_at_the_last_rank(spark):
    docs = [(i, "same words here") for i in range(300, 0, -1)]
    got = _got(search.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), spark.createDataFrame([(1, "words")], "item_id long, text string")))
    # every document holds the term: its weight is floor(1000 ln(602/601)) = 1
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == list(range(1, 51))


def test_empty_tables(spark):
    docs, items = _frames(spark)
    assert search.search(docs.limit(0), items).count() == 0
    assert search.search(docs, items.limit(0)).count() == 0


def test_documents_equal_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = sorted(con.sql(search.SQL).fetchall(), key=repr)
    assert _got(search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))) == want


def test_tiles_bound_their_sums():
    terms = [np.arange(5_000), np.array([1, 7])]
    tiles = search.make_tiles([3, 4], terms)
    assert [len(t.items) for t in tiles] == [1, 1]
    assert max(len(mine) for t in tiles for mine, _ in t.weighted(np.full(5_000, 50_000))) <= search.TILE_TERMS
    assert sum(len(mine) for mine, _ in tiles[0].weighted(np.ones(5_000, np.int64))) == 5_000
