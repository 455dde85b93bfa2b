"""Sharding: minimax contiguous partition of ordered atomic groups.

Groups (rows with equal text) are atomic and ordered by a 128-bit digest.  The
smallest feasible shard capacity is found by binary search; each probe cuts
greedily.  The probes run on a trie of digest prefixes: the driver holds at
most a few thousand (prefix, size) blocks, and only those blocks that a cut
could fall into are split further, by an aggregation in Spark, until every
block that matters is a single group.  The answer is exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradecast.llm.common import ordered, saved, with_global_index

FIRST_DIGITS = 3   # hex digits of the first blocks: 4096 of them at most
MORE_DIGITS = 2    # a block is split into 256 at most
DIGEST_DIGITS = 32


@dataclass(frozen=True)
class Block:
    prefix: str
    size: int
    rows: int
    groups: int


def _blocks(groups: DataFrame, digits: int, parents: list[str] | None = None) -> list[Block]:
    if parents is not None:
        groups = groups.where(F.substring("digest", 1, len(parents[0])).isin(parents))
    rows = (groups.groupBy(F.substring("digest", 1, digits).alias("p"))
            .agg(F.sum("bytes").alias("b"), F.sum("rows").alias("r"), F.count("*").alias("g")).collect())
    return [Block(r["p"], r["b"], r["r"], r["g"]) for r in rows]


def _cuts(blocks: list[Block], shards: int, cap: int, split: bool) -> list[int] | None:
    """Greedy ends of the shards as sizes from the start; None if it needs more
    shards.  ``split``: a cut may fall anywhere inside a block of several groups
    (an optimistic bound); else only between blocks."""
    ends, at, filled = [], 0, 0
    for b in blocks:
        left = b.size
        while filled + left > cap:
            if split and b.groups > 1:
                left -= cap - filled
                at += cap - filled
            elif filled == 0:
                return None
            ends.append(at)
            filled = 0
            if len(ends) == shards:
                return None
        filled += left
        at += left
    return ends + [at] * (shards - len(ends))


def _least(blocks: list[Block], shards: int, split: bool, low: int, high: int) -> int:
    """Smallest capacity for which the greedy cut needs no more than ``shards``."""
    while low < high:
        mid = (low + high) // 2
        if _cuts(blocks, shards, mid, split) is None:
            low = mid + 1
        else:
            high = mid
    return low


def _reach(blocks: list[Block], shards: int, cap: int) -> list[int]:
    """Greedy ends between blocks, also where the capacity doesn't suffice."""
    ends, bounds, at = [], [0], 0
    for b in blocks:
        at += b.size
        bounds.append(at)
    i = 0
    for _ in range(shards):
        start = bounds[i]
        while i + 1 < len(bounds) and bounds[i + 1] - start <= cap:
            i += 1
        ends.append(bounds[i])
    return ends


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[list[str], list[int]]:
    """For ``groups`` (digest hex, bytes, rows), one row per atomic group: the
    first digest prefix of shards 1.. and the number of rows of every shard."""
    blocks = sorted(_blocks(groups, FIRST_DIGITS), key=lambda b: b.prefix)
    if not blocks:
        return ["g"] * (shards - 1), [0] * shards
    total = sum(b.size for b in blocks)
    while True:
        high = _least(blocks, shards, False, 1, total)
        low = _least(blocks, shards, True, 1, total)
        if low >= high:
            break
        first, last = _reach(blocks, shards, low), _cuts(blocks, shards, high, True)
        at, chosen = 0, []
        for b in blocks:
            if b.groups > 1 and any(at < y and at + b.size > x for x, y in zip(first, last, strict=True)):
                chosen.append(b.prefix)
            at += b.size
        if not chosen:
            break
        by_len: dict[int, list[str]] = {}
        for p in chosen:
            by_len.setdefault(len(p), []).append(p)
        finer = [b for n, ps in by_len.items() for b in _blocks(groups, min(n + MORE_DIGITS, DIGEST_DIGITS), ps)]
        gone = set(chosen)
        blocks = sorted([b for b in blocks if b.prefix not in gone] + finer, key=lambda b: b.prefix)
    ends = _cuts(blocks, shards, high, False)
    firsts, rows, at, k = [], [0] * shards, 0, 0
    for b in blocks:
        while k < shards - 1 and at >= ends[k]:
            firsts.append(b.prefix)
            k += 1
        rows[k] += b.rows
        at += b.size
    return firsts + ["g"] * (shards - 1 - len(firsts)), rows  # "g" sorts after every hex digest


def minimax_shards(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard per row of ``docs``
    (``doc_id``, ``text``; other columns are ignored).

    Size is the UTF-8 bytes of the text plus 1; a null text counts as empty.
    Rows of equal text share a shard (null and empty text are one group); the
    largest shard is as small as that allows.  Within a shard, slots follow
    (digest, doc_id); repeated rows take slots of their own.  An empty table
    gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = saved(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("digest")), "shard-rows")
    groups = saved(slim.groupBy("digest").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows")), "shard-groups")
    firsts, rows = minimax_cuts(groups, n_shards)
    shard = sum((F.when(F.col("digest") >= p, 1).otherwise(0) for p in firsts), F.lit(0)).cast("int")
    starts = [sum(rows[:k]) for k in range(n_shards)]
    at = with_global_index(ordered(slim, [F.col("digest"), F.col("doc_id")], "shard-order"), "_at")
    return at.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_at") - F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), F.col("shard") + 1)).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
