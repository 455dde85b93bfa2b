from __future__ import annotations

import hashlib
import random

import pytest

from tradecast.llm.shard import minimax_cuts, minimax_shards


def least_capacity(sizes, shards):
    """The smallest largest part of a cut of ``sizes`` into ``shards`` runs."""
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, parts, filled = (low + high) // 2, 1, 0
        for s in sizes:
            if filled + s > mid:
                parts, filled = parts + 1, 0
            filled += s
        low, high = (mid + 1, high) if parts > shards else (low, mid)
    return low


@pytest.mark.parametrize("n,shards,big", [(3, 8, 1), (200, 8, 1), (20_000, 8, 1), (5_000, 5, 300_000)])
def test_cuts_are_optimal(spark, n, shards, big):
    rng = random.Random(n)
    groups = sorted((hashlib.md5(str(i).encode()).hexdigest(), rng.randint(1, 1000)) for i in range(n))
    groups[n // 3] = (groups[n // 3][0], big * 10)
    df = spark.createDataFrame([(d, s, 1) for d, s in groups], "digest string, bytes long, rows long")
    firsts, rows = minimax_cuts(df, shards)
    load = [0] * shards
    for d, s in groups:
        load[sum(d >= f for f in firsts)] += s
    assert max(load) == least_capacity([s for _, s in groups], shards)
    assert sum(rows) == n and len(firsts) == shards - 1


def test_slots_are_gapless_and_copies_stay_together(spark):
    df = spark.createDataFrame([(i, f"text {i % 40}" if i % 7 else None) for i in range(500)], "doc_id long, text string")
    out = minimax_shards(df, 8).toPandas()
    assert (out.groupby("text_crc32")["shard"].nunique() == 1).all()
    for _, g in out.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    assert out["size"].sum() == sum(len(f"text {i % 40}") + 1 if i % 7 else 1 for i in range(500))
    assert set(out["law"]) == {"bytes"} and out["grown_shard"].isna().all()
