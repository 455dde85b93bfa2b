"""N-gram Jaccard join: T-occurrence search with DivideSkip.

1. Documents are dealt to chunks by a hash.  Every chunk sends its distinct
   shingle hashes, packed, to the task of their range, which answers with the
   ones that other texts have too, and with how many.
2. A text can only link to another if they have a shingle in common among its
   rarest (a fifth of its set, plus one): a text whose rarest are all its own
   links with nothing and is done.  The few that are left carry their shared
   shingles on; texts with equal sets go on as one.
3. Texts that have a rare shingle in common, directly or through others, are a
   family.  A family is searched in blocks of bounded size, pair by pair of
   blocks: for each text, the short inverted lists are merged and counted, the
   long ones are probed by binary search for the texts that can still reach the
   required overlap, or merged too where that reads less.  Every pair of texts
   that link is found, in one pair of blocks.
4. Links give components, and every text the number of rows that it links with.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradecast.llm.common import saved
from tradecast.llm.components import components
from tradecast.llm.shingles import shingle_sets

PERCENT = 80
CHUNK_BYTES = 16 << 20       # text of a chunk, about
RANGE_HASHES = 2_000_000     # hashes of a range, about
BLOCK_HASHES = 400_000       # shared shingles of a block of a family, about
SKIP_FACTOR = 0.0085         # DivideSkip: lists kept apart, against the logarithm of the longest
PROBE_COST = 4               # of a binary search, against an entry merged


def required(n: int, m: np.ndarray | int) -> np.ndarray | int:
    """Least overlap of sets of n and m with PERCENT * union <= 100 * overlap."""
    return -((-PERCENT * (n + m)) // (100 + PERCENT))


def least_overlap(n: int) -> int:
    """Least overlap of a set of n with any set that it links with."""
    return -((-PERCENT * n) // 100)


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = i = up[up[i]]
        return int(i)

    def roots(self, of: np.ndarray) -> np.ndarray:
        r = self.up[of]
        while (r != (r := self.up[r])).any():
            pass
        self.up[of] = r
        return r

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def matches(sizes: np.ndarray, sets: list[np.ndarray], first: int) -> Iterator[tuple[int, np.ndarray]]:
    """(x, the sets that x links with, all before x) of sets (hashes that others
    have too; ``sizes``: of the whole sets), every link once.  ``first`` > 0:
    only links between the first so many sets and the rest; 0: between any two."""
    n = len(sets)
    lengths = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), lengths)
    ids, token = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(token, kind="stable")  # lists in ascending order of their sets
    lists, ends = owner[order], np.concatenate(([0], np.cumsum(np.bincount(token, minlength=len(ids)))))
    starts = np.concatenate(([0], np.cumsum(lengths)))
    for x in range(max(first, 1), n):
        upto = first or x
        own = token[starts[x]:starts[x + 1]]
        heads = ends[own]
        tails = heads + np.array([np.searchsorted(lists[a:b], upto) for a, b in zip(heads, ends[own + 1], strict=True)], int)
        by = np.argsort(tails - heads, kind="stable")
        heads, tails = heads[by], tails[by]
        longest = int((tails - heads).max(initial=0))
        if not longest:
            continue
        size = int(sizes[x])
        need = least_overlap(size)
        apart = min(len(own), need - 1, int(need / (SKIP_FACTOR * math.log2(longest + 1) + 1)))
        k = len(own) - apart
        counts = _merged(lists, heads[:k], tails[:k], upto)
        found = np.flatnonzero(counts >= need - apart)
        other = sizes[found]
        found = found[(100 * other >= PERCENT * size) & (100 * size >= PERCENT * other)]
        if len(found):
            found = _probe(found, counts[found], required(size, sizes[found]), lists, heads[k:], tails[k:], upto)
        if len(found):
            yield x, found


def search(sizes: np.ndarray, sets: list[np.ndarray], first: int, copies: np.ndarray | None = None,
           linked: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join the components of sets, of all that ``matches`` finds.
    Adds to ``linked`` the ``copies`` of the sets that each one links with."""
    forest, links = Forest(len(sets)), []
    for x, found in matches(sizes, sets, first):
        if linked is not None:
            linked[x] += copies[found].sum()
            linked[found] += copies[x]
        for at in np.unique(forest.roots(found), return_index=True)[1].tolist():
            y = int(found[at])
            if forest.join(x, y):
                links.append((x, y))
    return links


def _merged(lists: np.ndarray, heads: np.ndarray, tails: np.ndarray, upto: int) -> np.ndarray:
    """How many of the lists hold each of the first ``upto`` sets."""
    return np.bincount(np.concatenate([lists[a:b] for a, b in zip(heads.tolist(), tails.tolist(), strict=True)] + [np.zeros(0, int)]), minlength=upto)


def _probe(found: np.ndarray, counts: np.ndarray, need: np.ndarray, lists: np.ndarray, heads: np.ndarray, tails: np.ndarray, upto: int) -> np.ndarray:
    """Those of ``found`` that reach ``need`` with the long lists."""
    left = np.concatenate((np.cumsum((tails - heads)[::-1])[::-1], [0]))  # entries of a list and of those after it
    for i, (a, b) in enumerate(zip(heads.tolist(), tails.tolist(), strict=True)):
        able = counts + (len(heads) - i) >= need
        if not able.all():
            found, counts, need = found[able], counts[able], need[able]
        if not len(found):
            break
        if PROBE_COST * len(found) * (len(heads) - i) > left[i]:
            counts = counts + _merged(lists, heads[i:], tails[i:], upto)[found]
            break
        long = lists[a:b]
        at = np.searchsorted(long, found)
        counts = counts + ((at < len(long)) & (long[np.minimum(at, len(long) - 1)] == found) if len(long) else 0)
    return found[counts >= need]


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _shared(base: DataFrame, bits: int) -> DataFrame:
    """(``to``, ``range``, ``low``, ``df``): for every chunk, the hashes (32 bits
    after the first ``bits``) that two or more of all distinct sets of a chunk
    have, and how many do.  Hashes cut to 32 + ``bits`` bits may meet by chance,
    which only makes more texts stay in."""

    def send(p: pd.DataFrame) -> pd.DataFrame:
        distinct = {_digest(s): s for s in shingle_sets(p["text"])}
        rows = []
        if distinct:
            cut = np.concatenate(list(distinct.values())) >> np.uint64(32 - bits)
            key, n = np.unique(cut, return_counts=True)
            ends = np.searchsorted(key, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32))
            chunk = int(p["chunk"].iloc[0])
            for r, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                if b > a:
                    more = np.flatnonzero(n[a:b] > 1)
                    rows.append((r, chunk, key[a:b].astype(np.uint32).tobytes(), more.astype(np.uint32).tobytes(),
                                 n[a:b][more].astype(np.uint32).tobytes()))
        return pd.DataFrame(rows, columns=["range", "chunk", "low", "at", "n"])

    def answer(p: pd.DataFrame) -> pd.DataFrame:
        low = [np.frombuffer(x, np.uint32) for x in p["low"]]
        n = [np.ones(len(x), np.uint32) for x in low]
        for have, at, more in zip(n, p["at"], p["n"], strict=True):
            have[np.frombuffer(at, np.uint32)] = np.frombuffer(more, np.uint32)
        every = np.concatenate(low)
        order = np.argsort(every, kind="stable")
        every, each = every[order], np.concatenate(n)[order]
        first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
        df = np.add.reduceat(each.astype(np.uint64), first)
        key, df = every[first[df > 1]], np.minimum(df[df > 1], 0xFFFFFFFF).astype(np.uint32)
        rows = []
        for chunk, mine in zip(p["chunk"], low, strict=True):
            at = np.searchsorted(key, mine)
            at = at[(at < len(key)) & (key[np.minimum(at, len(key) - 1)] == mine)] if len(key) else at[:0]
            if len(at):
                rows.append((int(chunk), int(p["range"].iloc[0]), key[at].tobytes(), df[at].tobytes()))
        return pd.DataFrame(rows, columns=["to", "range", "low", "df"])

    sent = base.groupBy("chunk").applyInPandas(send, "range int, chunk int, low binary, at binary, n binary")
    return sent.groupBy("range").applyInPandas(answer, "to int, range int, low binary, df binary")


def shingled(docs: DataFrame) -> DataFrame:
    """(``key``, ``text_hash``, ``n``, ``digest``, ``tokens``, ``prefix``) for
    every row; ``tokens`` (shingles that other texts have) and ``prefix`` (those
    among the rarest that can lead to a link) only on texts that may link, and
    on one of equal sets of a chunk."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("key"),
                       F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / CHUNK_BYTES))
    bits = min(24, max(3, math.ceil(math.log2(max(1, size / 6 / RANGE_HASHES)))))  # a word has about six bytes
    base = rows.withColumn("chunk", F.pmod(F.xxhash64("key", "text_hash"), F.lit(chunks)).cast("int")).repartition(chunks, "chunk")

    def finish(p: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        sets = shingle_sets(p["text"])
        have = have.sort_values("range")
        parts = [np.frombuffer(x, np.uint32).astype(np.uint64) | np.uint64(r << 32) for x, r in zip(have["low"], have["range"], strict=True)]
        known = np.concatenate([*parts, np.zeros(0, np.uint64)])
        freq = np.concatenate([*(np.frombuffer(x, np.uint32) for x in have["df"]), np.zeros(0, np.uint32)])
        out, seen = [], set()
        for key, text_hash, s in zip(p["key"], p["text_hash"], sets, strict=True):
            digest, tokens, prefix = _digest(s), None, None
            if len(s) and len(known) and digest not in seen:
                cut = s >> np.uint64(32 - bits)
                at = np.minimum(np.searchsorted(known, cut), len(known) - 1)
                mine = known[at] == cut
                rare = len(s) - least_overlap(len(s)) + 1 - int(len(s) - mine.sum())
                if rare > 0:
                    seen.add(digest)
                    shared, df = s[mine], freq[at[mine]]
                    tokens = shared.view(np.int64)
                    prefix = tokens[np.lexsort((shared, df))[:rare]]
            out.append((key, text_hash, len(s), digest, tokens, prefix))
        return pd.DataFrame(out, columns=["key", "text_hash", "n", "digest", "tokens", "prefix"])

    fields = "key long, text_hash long, n long, digest binary, tokens array<long>, prefix array<long>"
    return base.groupBy("chunk").cogroup(_shared(base, bits).groupBy("to")).applyInPandas(finish, fields)


def _links(sets: DataFrame) -> DataFrame:
    """Edges (``a``, ``b``) between digests that join what is linked, and, where
    ``b`` is null, ``linked``: rows that ``a`` links with in a pair of blocks."""
    posts = sets.select("digest", F.explode("prefix").alias("token"))
    head = posts.groupBy("token").agg(F.min("digest").alias("a"))
    edges = posts.join(head, "token").select("a", F.col("digest").alias("b"))
    family = saved(components(edges, "jaccard-families"), "jaccard-family")
    inside = sets.select("digest", "n", "tokens", "copies").join(family, sets["digest"] == family["node"]).drop("node")
    # heavy families are split into blocks; a pair of blocks is a task's group
    heavy = inside.groupBy(F.col("root").alias("_root")).agg(
        F.ceil(F.sum(F.size("tokens")) / BLOCK_HASHES).cast("int").alias("_blocks")).where("_blocks > 1")
    # broadcast: no more rows than blocks of shared shingles
    blocked = inside.join(F.broadcast(heavy), inside["root"] == heavy["_root"], "left").withColumn("blocks", F.coalesce("_blocks", F.lit(1)))
    blocked = blocked.withColumn("block", F.pmod(F.xxhash64("digest"), "blocks").cast("int"))
    dealt = blocked.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "root", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"), "block", "digest", "n", "tokens", "copies")

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["block", "digest"])
        first = 0 if p["lo"].iloc[0] == p["hi"].iloc[0] else int((p["block"] == p["lo"]).sum())
        digest = p["digest"].tolist()
        if len(p) < 2 or (first in (0, len(p)) and p["lo"].iloc[0] != p["hi"].iloc[0]):
            return pd.DataFrame(columns=["a", "b", "linked"])
        linked = np.zeros(len(p), np.int64)
        links = search(p["n"].to_numpy(), [np.asarray(t, np.int64) for t in p["tokens"]], first, p["copies"].to_numpy(), linked)
        rows = [(digest[i], digest[j], 0) for i, j in links] + [(digest[i], None, int(linked[i])) for i in np.flatnonzero(linked)]
        return pd.DataFrame(rows, columns=["a", "b", "linked"])

    # the search is long for its bytes: partitions aren't coalesced by size
    tasks = 2 * int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(tasks, "root", "lo", "hi").groupBy("root", "lo", "hi").applyInPandas(run, "a binary, b binary, linked long")


def join_components(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, n_links, component_id, representative for
    every row of ``docs`` (``doc_id``, ``text``).

    ``n_links`` counts the other rows that the row's text links with, those of
    equal texts included.  Texts without words, and null texts, have no
    shingles, link with nothing and are components of their own.  Repeated rows
    are documents of one component.  A component's id is its smallest doc_id
    (null if all are null); its representative is the row of smallest (doc_id,
    hash of the text), null ids last.  An empty table gives no rows.
    """
    rows = saved(shingled(docs), "jaccard-rows")
    member = F.struct("key", "text_hash")
    least = saved(rows.where("n > 0").groupBy("digest").agg(F.min(member).alias("least"), F.count("*").alias("copies")), "jaccard-least")
    sets = rows.where("tokens IS NOT NULL").groupBy("digest").agg(
        F.first("n").alias("n"), F.first("tokens").alias("tokens"), F.first("prefix").alias("prefix"))
    sets = saved(sets.join(least.select("digest", "copies"), "digest"), "jaccard-sets")
    found = saved(_links(sets), "jaccard-found")
    linked = components(found.where("b IS NOT NULL").select("a", "b"), "jaccard-links")
    others = found.where("b IS NULL").groupBy(F.col("a").alias("_set")).agg(F.sum("linked").alias("linked"))
    least = least.join(others, least["digest"] == others["_set"], "left").withColumn("n_links", F.col("copies") - 1 + F.coalesce("linked", F.lit(0)))
    least = least.join(linked, least["digest"] == linked["node"], "left").withColumn("root", F.coalesce("root", "digest")).drop("node")
    heads = least.groupBy(F.col("root").alias("_root")).agg(F.min("least").alias("head"))
    by_set = least.join(heads, least["root"] == heads["_root"]).select(F.col("digest").alias("_digest"), "head", "n_links")
    out = rows.select("key", "text_hash", "n", "digest").join(by_set, (F.col("digest") == F.col("_digest")) & (F.col("n") > 0), "left")
    head = F.coalesce("head", member)
    known = F.lit((1 << 63) - 1)
    return out.select(
        F.nullif("key", known).alias("doc_id"), "text_hash", F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.nullif(head["key"], known).alias("component_id"), (head == member).alias("representative"))
