from __future__ import annotations

import random

import numpy as np

from tradecast.llm import jaccard
from tradecast.llm.components import components
from tradecast.llm.shingles import shingle_sets


def sets_of(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """Component of every id, by all pairs."""
    up = {k: k for k, _ in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    sets = {k: sets_of(t) for k, t in rows}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), root(k)) for k in sets}


def near_copies(rng, n):
    vocabulary = [f"w{i}" for i in range(300)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 30, 120, 200]))] for _ in range(12)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            words = words + passage
        if rng.random() < 0.1:
            words = [w.upper() for w in words]
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(words)))
    return rows


def test_components_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_HASHES", 2_000)  # so that families are split into blocks
    rows = near_copies(random.Random(5), 400)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join_components(df).collect()}
    assert got == brute(rows)


def test_every_link_is_counted(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_HASHES", 2_000)
    rows = near_copies(random.Random(6), 300) + [(1000, ""), (1001, ""), (1002, None)]
    rows += [(2000 + i, rows[i][1]) for i in range(40)] + rows[:5]
    sets = [sets_of(t) for _, t in rows]
    want = {}
    for i, (k, _) in enumerate(rows):
        want.setdefault(k, set()).add(sum(
            i != j and bool(a := sets[i]) and bool(b := sets[j]) and 100 * len(a & b) >= 80 * len(a | b) for j in range(len(rows))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {}
    for r in jaccard.join_components(df).collect():
        got.setdefault(r["doc_id"], set()).add(r["n_links"])
    assert got == want
    assert max(max(v) for v in want.values()) > 10


def test_search_finds_every_component():
    rng = random.Random(9)
    for first in (0, 40):
        rows = near_copies(rng, 90)
        sets = [np.sort(s) for s in shingle_sets(t for _, t in rows)]
        sizes = np.array([len(s) for s in sets])
        links = jaccard.search(sizes, [s.view(np.int64) for s in sets], first)
        want, have = jaccard.Forest(90), jaccard.Forest(90)
        for a in range(90):
            for b in range(a):
                o = len(np.intersect1d(sets[a], sets[b]))
                if (not first or b < first <= a) and 100 * o >= 80 * (len(sets[a]) + len(sets[b]) - o):
                    want.join(a, b)
        for a, b in links:
            have.join(a, b)
        assert [want.root(i) for i in range(90)] == [have.root(i) for i in range(90)]


def test_shingles_tell_texts_apart():
    texts = [None, "", "a", "A", "b", "a b", "b a", "a b c d e", "A\tb\x0bc d  e", "a b c d e f", "ab c d e f"]
    got = [tuple(s) for s in shingle_sets(iter(texts))]
    want = [sets_of(t) for t in texts]
    assert [len(g) for g in got] == [len(w) for w in want]
    assert all((g == h) == (v == w) for g, v in zip(got, want, strict=True) for h, w in zip(got, want, strict=True))


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(60) if i != 30] + [(5, 5), (100, 90), (90, 95)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 31 for i in range(31, 61)}, 90: 90, 95: 90, 100: 90}
