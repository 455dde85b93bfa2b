from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tradecast.llm import mixing


def by_heap(votes, seats, most):
    """Sainte-Lague, one seat at a time."""
    got = [0] * len(votes)
    for _ in range(seats):
        able = [i for i in range(len(votes)) if got[i] < most[i]]
        if not able:
            break
        got[max(able, key=lambda i: (votes[i] / (2 * got[i] + 1), -i))] += 1
    return got


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 10_000), min_size=1, max_size=8), st.integers(0, 200))
def test_apportionment(votes, seats):
    votes = [float(v) for v in votes]
    assert mixing.sainte_lague(votes, seats, [10**6] * len(votes)) == by_heap(votes, seats, [10**6] * len(votes))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=9))
def test_targets(sizes):
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    goal = mixing.targets(sizes, weights)
    assert all(t <= 3 * s + 1e-6 for t, s in zip(goal, sizes, strict=True))
    assert sum(goal) <= sum(sizes) + 1e-6
    free = [i for i, (t, s) in enumerate(zip(goal, sizes, strict=True)) if t < 3 * s - 1e-6]
    assert len({round(goal[i] / weights[i], 6) for i in free}) <= 1
    if free:
        assert abs(sum(goal) - sum(sizes)) < 1e-6


def test_quotas_run_over_shards():
    sizes = {"b": 5_000, "a": 100_000, None: 40_000, "c": 70_000}
    _, per = mixing.quotas(sizes, shards=8, seed=1)
    assert [q.source for q in per] == ["a", "b", "c", None]
    assert all(sum(q.by_shard) == q.quota for q in per)
    assert all(q.quota <= 3 * q.blocks for q in per)


def test_mix_comes_near_its_targets(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.choice([0, 3, 30, 400]))), rng.choice(["a", "b", "c", "d", None])) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = mixing.mix_counts(df).toPandas().drop(columns="taken_by_shard")
    again = mixing.mix_counts(df.repartition(3)).toPandas().drop(columns="taken_by_shard")
    assert out.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))
    assert (out["taken"] <= 3 * out["size"]).all()
    for (size, target), g in out.groupby(["source_size", "target"]):
        assert g["size"].sum() == size
        assert abs(g["taken"].sum() - target) <= 0.01 * target + 20


def test_small_sources_reach_their_targets_in_a_large_corpus():
    sizes = {"a": 2_500_000_000, "b": 2_500_000_000, "c": 5_000, "d": 20_000, "e": 100_000, "f": 100, "g": 7, "h": 0}
    length, per = mixing.quotas(sizes)
    for q in per:
        assert sum(q.by_shard) == q.quota and min(q.by_shard) >= 0
        # whole rounds, and blocks of the last one, of which one may be short
        rounds, rest = divmod(q.quota, max(1, q.blocks))
        taken = rounds * q.size + rest * length
        assert abs(taken - q.target) < 2 * length, q
        if q.source in "cdefg":
            assert q.target == 3 * q.size and (rounds, rest) == (3, 0)
        assert q.mult * q.blocks + q.shift < 1 << 63


def test_small_source_is_taken_three_times(spark, monkeypatch):
    monkeypatch.setattr(mixing, "WEIGHTS", (1,))
    rows = [(i, "w " * 5000, "big") for i in range(100)] + [(1000, "x y z", "small"), (1001, "u v " * 50, "tiny"), (1002, "t " * 97, "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = {r["doc_id"]: (r["size"], r["taken"]) for r in mixing.mix_counts(df).collect()}
    assert [taken[i] for i in (1000, 1001, 1002)] == [(3, 9), (100, 300), (97, 291)]
    assert abs(sum(t for k, (_, t) in taken.items() if k < 1000) - (500_200 - 600)) < 128
    texts = [r["text"] for r in mixing.mix_documents(df).where("doc_id = 1000").collect()]
    assert texts == ["x y z"] * 3


def test_seats_fall_to_shards_by_their_quotas(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.choice([0, 3, 30, 400]))), rng.choice(["a", "b", "b", "b", "c", None])) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = mixing._sized(df)
    planned, length = mixing.plan_mix(sized)
    out = planned.collect()
    sizes = {}
    for r in out:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["_size"]
    _, per = mixing.quotas(sizes)
    for q in per:
        # seat by seat: the block of every seat, its shard, and the words that documents have in it
        ends = [sum(q.by_shard[:h + 1]) for h in range(len(q.by_shard))]
        block_at = {(q.mult * b + q.shift) % q.blocks: b for b in range(q.blocks)}
        mine = [r for r in out if r["source"] == q.source]
        want = {r["doc_id"]: [0] * len(ends) for r in mine}
        for k in range(q.quota):
            b = block_at[k % q.blocks]
            h = sum(e <= k for e in ends)
            for r in mine:
                words = min((b + 1) * length, r["_start"] + r["_size"]) - max(b * length, r["_start"])
                if words > 0:
                    want[r["doc_id"]][h] += words
        assert {r["doc_id"]: r["_by_shard"] for r in mine} == want
    assert all(sum(r["_by_shard"]) == r["_taken"] for r in out)
    # the rows of the mix: each in the shard of a seat of its own, their words those taken
    mixed = mixing.mix_documents(df.withColumn("part", df.doc_id), shard="part").collect()
    by_doc = {r["doc_id"]: r["_by_shard"] for r in out}
    assert all(by_doc[r["doc_id"]][r["part"]] > 0 for r in mixed)
    assert sum(len(r["text"].split()) for r in mixed) == sum(r["_taken"] for r in out)
