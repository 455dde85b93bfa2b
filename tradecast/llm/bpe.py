"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary.

A text is split by the vocabulary's pattern; the bytes of every distinct word
are folded: again and again the adjacent pair of lowest rank merges, the
leftmost first.  The fold runs as Spark higher-order functions over the bytes
of the frequent distinct words, with the ranks as a literal map; tasks look
their words up in the result, and fold the words that it lacks by the same
rule, each distinct word once.  Decoding concatenates the pieces of the ids.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradecast.llm.common import map_texts, saved
from tradecast.llm.sketch import let

TABLE_WORDS = 1 << 17  # distinct words folded in advance
LONGEST = 24           # bytes of such a word
SLOTS = 1 << 14        # maps that the ranks are dealt to, by crc32
MEMO = 100_000         # further words a task remembers
SHORT = 64             # bytes of a word whose pairs are scanned for the lowest rank
NEVER = 1 << 62        # rank of a pair that does not merge


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def rank_map(ranks: dict[bytes, int]) -> Column:
    """The ranks as a literal: an array of maps from hex digits to rank, dealt by
    crc32 so that a look-up scans a few entries only."""
    slots: list[dict[str, int]] = [{} for _ in range(SLOTS)]
    for piece, rank in ranks.items():
        key = piece.hex().upper()
        slots[zlib.crc32(key.encode()) % SLOTS][key] = rank
    return F.from_json(F.lit(json.dumps(slots)), "array<map<string,int>>")


def fold_words(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(``word``, ``ids``) of distinct words, by higher-order functions."""
    slots = rank_map(ranks)

    def rank(piece: Column) -> Column:
        return F.try_element_at(F.get(slots, F.crc32(piece.cast("binary")) % SLOTS), piece)

    def step(parts: Column, _: Column) -> Column:
        pairs = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda x, i: rank(F.concat(x, parts[i + 1])))

        def merged(r: Column) -> Column:
            best = F.array_min(r)
            at = F.array_position(r, best).cast("int")
            return F.when(best.isNull(), parts).otherwise(F.concat(
                F.slice(parts, F.lit(1), at - 1), F.array(F.concat(parts[at - 1], parts[at])),
                F.slice(parts, at + 2, F.size(parts))))

        return F.when(F.size(parts) < 2, parts).otherwise(let(pairs, merged))

    hexed = F.hex(F.col("word").cast("binary"))
    n = F.octet_length("word")
    single = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(hexed, i * 2 - 1, F.lit(2)))
    parts = F.aggregate(F.sequence(F.lit(1), n), single, step)
    return words.where(n > 0).select("word", F.transform(parts, rank).alias("ids"))


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same fold of one word."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    if n > SHORT:
        return _fold_long(word, ranks)
    part, get = [word[i:i + 1] for i in range(n)], ranks.get
    rank = [get(word[i:i + 2], NEVER) for i in range(n - 1)]
    while rank and (r := min(rank)) != NEVER:
        i = rank.index(r)
        part[i] += part.pop(i + 1)
        del rank[i]
        if i:
            rank[i - 1] = get(part[i - 1] + part[i], NEVER)
        if i < len(rank):
            rank[i] = get(part[i] + part[i + 1], NEVER)
    return [ranks[p] for p in part]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """With a heap of the pairs, whose time hardly exceeds the word's length."""
    n = len(word)
    part: list[bytes | None] = [word[i:i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, part[i] + part[i + 1]) for i in range(n - 1) if (r := ranks.get(part[i] + part[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, both = heapq.heappop(heap)
        j = after[i]
        if part[i] is None or j >= n or part[i] + part[j] != both:
            continue
        part[i], part[j] = both, None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get(both + part[k])) is not None:
                heapq.heappush(heap, (r, i, both + part[k]))
        h = before[i]
        if h >= 0 and (r := ranks.get(part[h] + both)) is not None:
            heapq.heappush(heap, (r, h, part[h] + both))
    return [ranks[p] for p in part if p is not None]


def frequent_words(docs: DataFrame, pattern: str) -> DataFrame:
    """The ``TABLE_WORDS`` most frequent words, counted over all documents.  They
    only save work: any words would give the same ids, as tasks fold the words
    that they lack.

    The least count that fits is read off the numbers of words of each count, so
    that no task sorts them all; only words of that count are put in order."""
    words = docs.select(F.explode(F.regexp_extract_all("text", F.lit(f"({pattern})"), F.lit(0))).alias("word"))
    counts = saved(words.where((F.octet_length("word") <= LONGEST) & (F.octet_length("word") > 1)).groupBy("word").agg(F.count("*").alias("n")), "bpe-counts")
    sizes = counts.groupBy("n").agg(F.count("*").alias("of")).orderBy(F.desc("n")).limit(TABLE_WORDS + 1).collect()
    least, room = 0, TABLE_WORDS
    for r in sizes:
        if r["of"] > room:
            least = r["n"]
            break
        room -= r["of"]
    more = counts.where(F.col("n") > least).select("word")
    return more.unionByName(counts.where(F.col("n") == least).select("word").orderBy("word").limit(room)) if least and room else more


class _Words(dict):
    """Ids of words: of those given, and of the last that were asked for besides."""

    def __init__(self, words: Iterable[str], ids: Iterable[list[int]], ranks: dict[bytes, int]):
        same = {i: i for i in ranks.values()}.__getitem__  # one object for each id
        super().__init__(zip(words, (tuple(map(same, x)) for x in ids), strict=True))
        self.ranks, self.most = ranks, len(self) + MEMO

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= self.most:
            for _ in range(MEMO):  # the newest; those given were first
                self.popitem()
        ids = self[word] = tuple(fold(word.encode(), self.ranks))
        return ids


class _Encoder:
    """Encodes texts in a task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, words: Iterable[str], ids: Iterable[list[int]]):
        self.of = _Words(words, ids, ranks).__getitem__
        self.split = regex.compile(pattern).findall

    def ids(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(self.of, self.split(text)))) if text else []


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep_text: bool = True) -> DataFrame:
    """Adds ``ids`` (array of int) to the rows of ``docs`` (``doc_id``, ``text``;
    other columns are kept).  Null and empty texts get an empty array."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a limit leaves its rows in one task
    words = saved(frequent_words(docs, pattern).repartition(tasks), "bpe-frequent")
    # a plan without a shuffle: adaptive execution would print the literal map with every new plan
    table = saved(fold_words(words, ranks), "bpe-words")
    # TABLE_WORDS at most, as Arrow columns: the driver makes no rows of them
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern, table.toArrow()))

    def start():
        known, split, words = shared.value
        e = _Encoder(known, split, words["word"].to_pylist(), (x.as_py() for x in words["ids"]))
        return lambda texts: [[e.ids(t) for t in texts]]

    return map_texts(docs, {"ids": T.ArrayType(T.IntegerType())}, start, keep_text)


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes of an array of ids: their pieces, one after another."""
    pieces = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex()
    literal = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(literal, i)), ""))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row of ``docs``."""
    ranks = load_ranks(path)
    coded = encode(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ranks, pattern, keep_text=False)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids"), ranks), 256).alias("decoded_sha256"))
