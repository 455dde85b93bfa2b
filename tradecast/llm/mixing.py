"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token
blocks.

The words of every source are laid end to end in a seeded order and cut into
blocks of BLOCK words, whatever the size of the corpus; the last block of a
source holds what is left.  Seats (blocks) go to sources by highest quotients
votes / (2 * seats + 1), the votes being the target in the source's own blocks
of size / blocks words; a source whose target is MAX_REPEAT times its size has
all its blocks so often.  Shards take successive runs of the sequence of seats,
which gives an integer quota for each shard and source.  A source's k-th seat is
the k-th block of a seeded permutation of its blocks, going round again when the
quota exceeds them.  Only sums per source reach the driver.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradecast.llm.common import BLANK, WORD, n_words, ordered, shielded, small_table

WEIGHTS = (5, 2, 1)   # repeating over the sources by code point, null last
MAX_REPEAT = 3
BLOCK = 64            # words of a block; a source is off its target by less than two
MULTIPLIERS = 1 << 24  # of a permutation, so that they times a block fit 63 bits
SHARDS = 8
SEED = 20


def targets(sizes: list[int], weights: list[float], cap: int = MAX_REPEAT) -> list[float]:
    """Shares of the total by weight; those above ``cap`` times their size stop
    there and the rest is shared anew, until none is above."""
    total, out = float(sum(sizes)), [0.0] * len(sizes)
    open_ = set(range(len(sizes)))
    while open_:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in open_)
        by = sum(weights[i] for i in open_)
        over = set()
        for i in sorted(open_):
            out[i] = left * weights[i] / by
            if out[i] > cap * sizes[i]:
                over.add(i)
        if not over:
            break
        for i in over:
            out[i] = float(cap * sizes[i])
        open_ -= over
    return out


def sainte_lague(votes: list[float], seats: int, most: list[int]) -> list[int]:
    """Seats by highest quotients votes / (2 * seats + 1), ``most`` for each;
    equal quotients go to the earlier entry."""
    total = sum(votes)
    if total <= 0 or seats <= 0:
        return [0] * len(votes)
    got = [min(m, math.floor(v * seats / total + 0.5)) for v, m in zip(votes, most, strict=True)]
    while sum(got) < seats:
        i = max((i for i in range(len(votes)) if got[i] < most[i]),
                key=lambda i: (votes[i] / (2 * got[i] + 1), -i), default=None)
        if i is None:
            break
        got[i] += 1
    while sum(got) > seats:
        i = min((i for i in range(len(votes)) if got[i]), key=lambda i: (votes[i] / (2 * got[i] - 1), -i))
        got[i] -= 1
    return got


@dataclass(frozen=True)
class SourceQuota:
    source: str | None
    size: int
    target: float
    blocks: int
    quota: int                 # seats over all shards
    by_shard: tuple[int, ...]  # quota of each shard
    mult: int                  # block b comes (mult * b + shift) mod blocks -th
    shift: int


def _permutation(seed: int, source: str | None, n: int) -> tuple[int, int]:
    if n <= 1:
        return 1, 0
    h = hashlib.sha256(f"{seed}|{source is None}|{source}".encode()).digest()
    mult = int.from_bytes(h[:8], "big") % min(n, MULTIPLIERS) or 1
    while math.gcd(mult, n) != 1:
        mult = mult % n + 1
    return mult, int.from_bytes(h[8:16], "big") % n


def quotas(sizes: dict[str | None, int], shards: int = SHARDS, seed: int = SEED) -> tuple[int, list[SourceQuota]]:
    """Block length and the quota of every source."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    size = [sizes[s] for s in names]
    goal = targets(size, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(names))])
    blocks = [-(-n // BLOCK) for n in size]
    most = [MAX_REPEAT * b for b in blocks]
    votes = [g * b / n if n else 0.0 for g, b, n in zip(goal, blocks, size, strict=True)]
    free = [i for i, g in enumerate(goal) if g < MAX_REPEAT * size[i]]
    quota = list(most)  # of the sources that are stopped
    seats = sainte_lague([votes[i] for i in free], round(sum(votes[i] for i in free)), [most[i] for i in free])
    for i, n in zip(free, seats, strict=True):
        quota[i] = n
    upto = [sainte_lague(votes, sum(quota) * (h + 1) // shards, quota) for h in range(shards)]
    out = []
    for i, s in enumerate(names):
        mult, shift = _permutation(seed, s, blocks[i])
        by_shard = tuple(max(0, upto[h][i] - (upto[h - 1][i] if h else 0)) for h in range(shards))
        out.append(SourceQuota(s, size[i], goal[i], blocks[i], upto[-1][i], by_shard, mult, shift))
    return BLOCK, out


def _placed(docs: DataFrame, seed: int) -> DataFrame:
    """``docs`` (with ``_size``) in the seeded order of each source, written,
    with ``_in_range``: words of the source before the row within its range."""
    keyed = docs.withColumn("_key", F.xxhash64(F.lit(seed), "doc_id", "_crc"))
    return ordered(keyed, [F.col("source").asc_nulls_last(), F.col("_key"), F.col("doc_id"), F.col("_crc")], "mix-order")


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"_size": n_words(F.col("text")), "_crc": F.crc32(F.col("text").cast("binary"))})


def plan_mix(sized: DataFrame, shards: int = SHARDS, seed: int = SEED) -> tuple[DataFrame, int]:
    """Adds to rows with ``doc_id``, ``source``, ``_size`` and ``_crc`` the
    fields of the source's quota, ``_start`` (words of the source before the
    row), ``_by_shard`` (words taken in each shard) and ``_taken`` (in all).
    Also returns the block length."""
    spark = sized.sparkSession
    placed = _placed(sized, seed)
    # one row per range and source in it
    sums = placed.groupBy("_pid", "source").agg(F.sum("_size").alias("n")).collect()
    total: dict[str | None, int] = {}
    before = []
    for r in sorted(sums, key=lambda r: r["_pid"]):
        before.append((r["_pid"], r["source"], total.get(r["source"], 0)))
        total[r["source"]] = total.get(r["source"], 0) + r["n"]
    length, per = quotas(total, shards, seed)
    offsets = small_table(spark, before, "_pid int, _src string, _before long")
    params = small_table(
        spark, [(q.source, q.size, q.target, q.blocks, q.quota, q.mult, q.shift, list(accumulate(q.by_shard))) for q in per],
        "_src string, _source_size long, _target double, _blocks long, _quota long, _mult long, _shift long, _upto array<long>")
    # broadcasts: a row per range and source, and a row per source
    out = _running(placed).alias("p").join(F.broadcast(offsets.alias("o")), F.expr("p._pid = o._pid AND p.source <=> o._src"))
    out = out.select("p.*", "o._before").join(F.broadcast(params), F.col("source").eqNullSafe(F.col("_src"))).drop("_src")
    out = out.withColumn("_start", F.col("_before") + F.col("_in_range"))
    nothing = F.transform("_upto", lambda _: F.lit(0).cast("long"))
    out = out.withColumn("_by_shard", F.when(F.col("_size") == 0, nothing).otherwise(_by_shard(length)))
    return out.withColumn("_taken", F.aggregate("_by_shard", F.lit(0).cast("long"), lambda a, n: a + n)), length


def _rounds() -> Column:
    """Whole rounds over a source's blocks."""
    return F.floor(F.col("_quota") / F.greatest(F.col("_blocks"), F.lit(1))).cast("long")


def _overlap(block: Column, length: int) -> Column:
    """Words of the row in a block of its source."""
    return F.least((block + 1) * length, F.col("_start") + F.col("_size")) - F.greatest(block * length, F.col("_start"))


def _blocks_of(length: int) -> Column:
    """The blocks that a row with words has a part in."""
    return F.sequence(F.floor(F.col("_start") / length).cast("long"),
                      F.floor((F.col("_start") + F.col("_size") - 1) / length).cast("long"))


def _place(block: Column) -> Column:
    """Where a block comes in the seeded permutation of its source; its seats are
    that one and every ``_blocks``-th after it, below the quota."""
    return (F.col("_mult") * block + F.col("_shift")) % F.col("_blocks")


def _by_shard(length: int) -> Column:
    """Words taken of the row in each shard, which has the seats from the quotas
    of the shards before it to its own."""
    def seats(block: Column, end: Column) -> Column:
        """Seats of a block below ``end``."""
        return F.greatest(F.floor((end - _place(block) + F.col("_blocks") - 1) / F.col("_blocks")), F.lit(0)).cast("long")

    def words(end: Column, h: Column) -> Column:
        begin = F.when(h == 0, F.lit(0).cast("long")).otherwise(F.get("_upto", h - 1))
        return F.when(begin == end, F.lit(0).cast("long")).otherwise(F.aggregate(
            _blocks_of(length), F.lit(0).cast("long"),
            lambda n, b: n + _overlap(b, length) * (seats(b, end) - seats(b, begin))))

    return F.transform("_upto", words)


def _chosen(block: Column) -> Column:
    """Whether the block has a seat in the round after the whole ones."""
    return _place(block) < F.col("_quota") % F.col("_blocks")


def _running(placed: DataFrame) -> DataFrame:
    """Adds ``_in_range``, the running sum of ``_size`` per range and source."""
    from pyspark.sql import Window
    w = Window.partitionBy("_pid", "source").orderBy("_idx").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("_in_range", F.coalesce(F.sum("_size").over(w), F.lit(0)))


def mix_counts(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, taken_by_shard (of ``shards``
    entries) for every row of ``docs``.

    A null text has size 0; a null source is a source of its own, the last;
    repeated rows are documents of their own; an empty table gives no rows.
    A row of n words gives at most 3 n.
    """
    slim = _sized(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")).drop("text")
    planned, _ = plan_mix(slim, shards, seed)
    return planned.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                          F.col("_target").alias("target"), F.col("_taken").alias("taken"), F.col("_by_shard").alias("taken_by_shard"))


def mix_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, shard: str | None = None) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row for each round in which
    a document has words taken.  Where a block boundary cuts a document, the
    row's text holds the words of the taken blocks (with the blanks before
    them) and ``n_chars``, if there, their length; else the text is unchanged.
    Documents without words are never taken.  With ``shard``, a column of that
    name holds the shard of the seat of the row's first taken block; a column of
    ``docs`` of that name goes."""
    docs, back = shielded(docs.drop(shard) if shard else docs, ("doc_id", "source", "text", "n_chars"))
    planned, length = plan_mix(_sized(docs), shards, seed)
    part = F.col("_taken") - _rounds() * F.col("_size")
    rounds = planned.withColumn("_part", part).withColumn(
        "_round", F.explode(F.sequence(F.lit(1), (_rounds() + 1).cast("int"))))
    rounds = rounds.withColumn("_last", F.col("_round") > _rounds())
    rounds = rounds.where((F.col("_size") > 0) & (~F.col("_last") | (F.col("_part") > 0)))
    pieces = F.regexp_extract_all("text", F.lit(f"({BLANK}*{WORD})"), F.lit(1))
    kept = F.array_join(F.filter(pieces, lambda _, i: _chosen(F.floor((F.col("_start") + i) / length).cast("long"))), "")
    cut = F.col("_last") & (F.col("_part") < F.col("_size"))
    rounds = rounds.withColumn("text", F.when(cut, kept).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rounds = rounds.withColumn("n_chars", F.when(cut, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    if not shard:
        return back(rounds)
    taken = F.filter(_blocks_of(length), lambda b: ~F.col("_last") | _chosen(b))
    seat = (F.col("_round") - 1) * F.col("_blocks") + _place(F.get(taken, F.lit(0)))
    rounds = rounds.withColumn("_seat", seat)
    of = F.size(F.filter("_upto", lambda end: end <= F.col("_seat")))
    return back(rounds, of.alias(shard))
