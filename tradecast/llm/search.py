"""Ranked lexical search of query items over all documents, by blocked dense
matrix products.

Items are dealt to tiles, each with the compact vocabulary of its items.  A task
holds the impacts of a tile's terms in some documents as a dense float64 matrix
and multiplies the items' weights with it; all numbers are integers and a
partial sum stays below 2^53, so the products are exact.  Of each product only
the best documents of an item stay, ties decided by id.

One pass over the texts counts the terms that the items hold; weights need the
corpus counts, so the counted rows wait in the shared folder.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradecast.llm.common import saved

TOP = 50
GROUP_ENTRIES = 100_000  # distinct terms of items, summed over items, that are shared with the tasks at a time, about
TILE_ITEMS = 64
TILE_TERMS = 2048
TILE_DOCS = 1024
MERGED = 256             # parts in which the tasks' best are merged first

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same over the bytes of UTF-8 in which A-Z are lower-cased.
TERM_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SCALE = 1_000_000_000    # numerator of an impact
STEEP = 1000             # its denominator is STEEP * tf + FLAT * m
FLAT = 20
LENGTH_SHARE = 50        # per cent of m that follows the document's length
LARGEST_IMPACT = SCALE // STEEP
EXACT = 1 << 53
NO_ID = (1 << 63) - 1    # a null id, which comes after all others


def items_with_terms(items: DataFrame) -> DataFrame:
    """``item`` (a number of its own), ``item_id``, ``terms`` (distinct) of the
    distinct rows (item_id, text) that have a term."""
    lower = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    rows = rows.select("item_id", F.array_distinct(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("terms"))
    return saved(rows.where(F.size("terms") > 0).withColumn("item", F.monotonically_increasing_id()), "search-items")


class Tile:
    """Some items with the terms that they hold, in blocks of ``TILE_TERMS``."""

    def __init__(self, items: list[int], terms: list[np.ndarray]):
        self.items = np.array(items)
        row = np.repeat(np.arange(len(items)), [len(t) for t in terms])
        every = np.concatenate(terms)
        distinct, column = np.unique(every, return_inverse=True)
        self.blocks = []
        for at in range(0, len(distinct), TILE_TERMS):
            mine = (column >= at) & (column < at + TILE_TERMS)
            self.blocks.append((distinct[at:at + TILE_TERMS], row[mine], column[mine] - at))

    def weighted(self, weight: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each block as its terms and the items' weights of them, dense."""
        out = []
        for terms, row, column in self.blocks:
            w = np.zeros((len(self.items), len(terms)))
            w[row, column] = weight[terms[column]]
            if w.sum(1).max(initial=0) * LARGEST_IMPACT >= EXACT:
                raise OverflowError("a block's sums must stay below 2^53")
            out.append((terms, w))
        return out


def make_tiles(items: list[int], terms: list[np.ndarray]) -> list[Tile]:
    """Items of like terms need not meet; they come in order, as many as fit."""
    out, start, held = [], 0, 0
    for i, t in enumerate(terms):
        if i > start and (i - start >= TILE_ITEMS or held + len(t) > TILE_TERMS):
            out.append(Tile(items[start:i], terms[start:i]))
            start, held = i, 0
        held += len(t)
    return [*out, Tile(items[start:], terms[start:])] if items else out


COUNTED = "doc_id long, n long, terms array<int>, tf array<int>"
_LIST = pa.list_(pa.int32())


def count_terms(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``doc_id``, number of terms ``n``, and the ``terms`` (numbers) of the
    vocabulary in the document with their ``tf``; documents without a term go."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # GROUP_ENTRIES terms, about

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(shared.value)}
        size = max(1, len(number))
        for whole in batches:
            for at in range(0, whole.num_rows, TILE_DOCS):
                b = whole.slice(at, TILE_DOCS)
                n, known = [], []
                for text in b.column("text").to_pylist():
                    words = TERM_BYTES.findall(text.lower()) if text else []
                    n.append(len(words))
                    known.append([i for i in map(number.get, words) if i is not None])
                doc = np.repeat(np.arange(len(n)), [len(k) for k in known])
                key, tf = np.unique(doc * size + np.array([i for k in known for i in k], np.int64), return_counts=True)
                ends = np.searchsorted(key, np.arange(len(n) + 1) * size).astype(np.int32)
                out = pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array((key % size).astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(tf.astype(np.int32)))], names=["doc_id", "n", "terms", "tf"])
                yield out.filter(pa.array(np.array(n) > 0))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(run, COUNTED)


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


class Best:
    """The best documents of some items so far: highest score, then smallest id."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.score = np.zeros((n_items, top), np.int64)  # 0: none
        self.doc = np.full((n_items, top), NO_ID, np.int64)

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        """Scores of all items in further documents.  All that reach an item's
        least kept score compete, so that no tie is cut off."""
        least = np.maximum(self.score[:, -1:], 1)
        reach = score >= least
        for i in np.flatnonzero(reach.any(1)):
            at = np.flatnonzero(reach[i])
            s, d = np.concatenate([self.score[i], score[i, at]]), np.concatenate([self.doc[i], doc[at]])
            if len(at) > self.top:
                cut = np.partition(s, len(s) - self.top)[len(s) - self.top]
                s, d = s[s >= cut], d[s >= cut]
            order = np.lexsort((d, -s))[:self.top]
            self.score[i], self.doc[i] = s[order], d[order]


def rank_tiles(counted: DataFrame, tiles: list[Tile], weight: np.ndarray, n_docs: int, n_terms: int, top: int = TOP) -> DataFrame:
    """``item``, ``doc_id``, ``score``: the best documents of each task."""
    shared = counted.sparkSession.sparkContext.broadcast((tiles, weight))  # bounded as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, weight = shared.value
        dense = [t.weighted(weight) for t in given]
        best = [Best(len(t.items), top) for t in given]
        column = np.full(len(weight), -1)
        for whole in batches:
            for at in range(0, whole.num_rows, TILE_DOCS):
                b = whole.slice(at, TILE_DOCS)
                ids = b.column("doc_id").fill_null(NO_ID).to_numpy()
                m = 100 - LENGTH_SHARE + (LENGTH_SHARE * b.column("n").to_numpy() * n_docs) // n_terms
                terms, tf = b.column("terms").flatten().to_numpy(), b.column("tf").flatten().to_numpy().astype(np.int64)
                doc = np.repeat(np.arange(b.num_rows), b.column("terms").value_lengths().to_numpy())
                impact = (SCALE * tf) // (STEEP * tf + FLAT * m[doc])
                for blocks, tile, kept in zip(dense, given, best, strict=True):
                    score = np.zeros((len(tile.items), b.num_rows), np.int64)
                    for mine, w in blocks:
                        column[mine] = np.arange(len(mine))
                        row = column[terms]
                        column[mine] = -1
                        have = row >= 0
                        part = np.zeros((len(mine), b.num_rows))
                        part[row[have], doc[have]] = impact[have]
                        score += (w @ part).astype(np.int64)
                    kept.add(score, ids)
        for tile, kept in zip(given, best, strict=True):
            i, k = np.nonzero(kept.score)
            yield pa.RecordBatch.from_arrays([pa.array(tile.items[i]), pa.array(kept.doc[i, k]), pa.array(kept.score[i, k])], names=["item", "doc_id", "score"])

    return counted.mapInArrow(run, "item long, doc_id long, score long")


def ranked(found: DataFrame, top: int) -> DataFrame:
    """The best of all tasks: first within parts of the tasks, then among those."""
    def best(keys: list) -> DataFrame:
        return F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("doc_id")))

    parts = found.withColumn("part", F.spark_partition_id() % MERGED).withColumn("rank", best(["item", "part"]))
    return parts.where(F.col("rank") <= top).withColumn("rank", best(["item"])).where(F.col("rank") <= top).drop("part")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, group_entries: int = GROUP_ENTRIES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of highest score above
    0 for each item of ``items`` (``item_id``, ``text``), equal scores by ascending
    id, a null id last; other columns are not read.

    Null texts and texts without a term are in no result and count for nothing,
    on either side.  Repeated rows of ``docs`` are documents of their own.
    Repeated items are one; rows of one item_id with different texts are ranked
    each for itself, under that id.  Empty tables give no rows.

    Items come in groups of some ``group_entries`` distinct terms; each group is
    a pass over the documents, in which its vocabulary is shared with the tasks.
    One item's terms are never split between groups.
    """
    have = items_with_terms(items)
    entries = have.agg(F.sum(F.size("terms"))).first()[0] or 0
    groups = max(1, math.ceil(entries / group_entries))
    found = None
    for g in range(groups):
        mine = have.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == g).select("item", "terms").orderBy("item").toArrow()
        told = [[t.encode() for t in row] for row in mine["terms"].to_pylist()]
        vocabulary = sorted({t for row in told for t in row})
        number = {t: i for i, t in enumerate(vocabulary)}
        tiles = make_tiles(mine["item"].to_pylist(), [np.array([number[t] for t in row]) for row in told])
        counted = saved(count_terms(docs, vocabulary), "search-counts")
        totals = counted.agg(F.count("*"), F.sum("n")).first()
        if not totals[0] or not tiles:
            continue
        df = np.zeros(len(vocabulary), np.int64)
        held = counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).toArrow()
        df[held["t"].to_numpy()] = held["df"].to_numpy()
        best = rank_tiles(counted, tiles, weights(totals[0], df), totals[0], totals[1], top)
        best = saved(best, "search-best")
        found = best if found is None else found.unionByName(best)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = ranked(found, top).join(have.select("item", "item_id"), "item")
    return out.select("item_id", "rank", F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score")


#: ``search`` over documents and benchmark.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents WHERE "text" IS NOT NULL),
i AS (
  SELECT row_number() OVER () AS item, item_id,
         list_distinct(regexp_extract_all(translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM (SELECT DISTINCT item_id, "text" FROM benchmark WHERE "text" IS NOT NULL)),
it AS (SELECT item, unnest(t) AS term FROM i),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0),
p AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM it) GROUP BY r, term),
w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), c),
m AS (SELECT r, doc_id, 100 - 50 + ((50 * len(t)::BIGINT * n_docs) // n_terms) AS m FROM d, c WHERE len(t) > 0),
s AS (
  SELECT it.item, p.r, sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * m.m)))::BIGINT AS score
  FROM it JOIN p USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY it.item, p.r),
k AS (
  SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM s JOIN m USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k JOIN i USING (item) WHERE rank <= 50
"""
