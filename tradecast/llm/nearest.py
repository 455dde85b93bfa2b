"""Approximate nearest neighbours: stable projections indexed by kd-trees.

Vectors of length one are projected to ``DIMS`` dimensions with a Gaussian
matrix (2-stable): a squared projected distance over the squared distance
follows a chi-square law.  A query takes its neighbours in order of projected
distance and computes the true distance of each; it stops when the chi-square
distribution says that a vector nearer than the k-th found would, with
probability ``CONFIDENCE``, have come up already.

The rows are dealt to cells of a kd-tree fitted on a bounded sample of
projections; large cells are split by a hash of the id, whatever they hold.
Every block of rows has a kd-tree of its own.  A first round searches a block
of the query's own cell, and the k-th distance found there tells which other
cells the test can't rule out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradecast.llm.common import saved

DIMS = 8               # even, for the closed form below
CONFIDENCE = 0.97
SAMPLE_ROWS = 20_000   # projections that the cells are fitted on, about
BLOCK_ROWS = 4_096     # of a block, about
MOST_CELLS = 4_096
LEAF_ROWS = 64
STEP_LEAVES = 4
SEED = 8
LEAST = 1e-12          # squared distances below are rounding


def chi_square_cdf(x: float, dims: int) -> float:
    """For an even number of dimensions."""
    term, total = 1.0, 1.0
    for i in range(1, dims // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def stop_ratio(dims: int = DIMS, confidence: float = CONFIDENCE) -> float:
    """Squared projected over squared true distance at which the test holds."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, dims) < confidence else (low, mid)
    return high


def projection(width: int, dims: int = DIMS) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((width, dims))


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1))[:, None]


class Cells:
    """The upper levels of a kd-tree over projections; cell numbers as in a heap."""

    def __init__(self, points: np.ndarray, levels: int):
        self.levels, self.dims = levels, points.shape[1]
        self.axis = np.zeros(1 << levels, int)
        self.at = np.zeros(1 << levels)
        groups = {1: points}
        for node in range(1, 1 << levels):
            p = groups.pop(node)
            axis = int(np.ptp(p, axis=0).argmax()) if len(p) else 0
            at = float(np.median(p[:, axis])) if len(p) else 0.0
            self.axis[node], self.at[node] = axis, at
            right = p[:, axis] > at
            groups[2 * node], groups[2 * node + 1] = p[~right], p[right]

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), int)
        for _ in range(self.levels):
            node = 2 * node + (points[np.arange(len(points)), self.axis[node]] > self.at[node])
        return node - (1 << self.levels)

    def boxes(self) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper corner of every cell."""
        low, high = {1: np.full(self.dims, -np.inf)}, {1: np.full(self.dims, np.inf)}
        for node in range(1, 1 << self.levels):
            a, b, axis = low.pop(node), high.pop(node), self.axis[node]
            low[2 * node], high[2 * node + 1] = a, b
            high[2 * node], low[2 * node + 1] = b.copy(), a.copy()
            high[2 * node][axis] = low[2 * node + 1][axis] = self.at[node]
        order = range(1 << self.levels, 2 << self.levels)
        return np.array([low[i] for i in order]), np.array([high[i] for i in order])


def _gap(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of a point from boxes."""
    d = np.maximum(np.maximum(low - point, point - high), 0.0)
    return (d * d).sum(1)


class Block:
    """A kd-tree over the projections of one block of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, dims: np.ndarray):
        self.unit = _unit(vectors)
        points = self.unit @ dims
        parts, todo = [], [np.arange(len(ids))]
        while todo:
            rows = todo.pop()
            spread = np.ptp(points[rows], axis=0)
            if len(rows) <= LEAF_ROWS or spread.max() == 0:
                parts += [rows[i:i + LEAF_ROWS] for i in range(0, len(rows), LEAF_ROWS)]
                continue
            p = points[rows, spread.argmax()]
            half = np.argpartition(p, len(p) // 2)
            todo += [rows[half[:len(p) // 2]], rows[half[len(p) // 2:]]]
        self.low = np.array([points[r].min(0) for r in parts])
        self.high = np.array([points[r].max(0) for r in parts])
        order = np.concatenate(parts)
        self.ends = np.cumsum([0] + [len(r) for r in parts])
        self.ids, self.vectors, self.unit = ids[order], vectors[order], self.unit[order]

    def search(self, own: int, query: np.ndarray, point: np.ndarray, k: int, bound: float, ratio: float) -> list[tuple[int, float]]:
        """The k nearest found, (id, cosine); ``bound``: squared distance of the
        k-th found elsewhere."""
        unit = query / math.sqrt((query * query).sum())
        gaps = _gap(point, self.low, self.high)
        order = np.argsort(gaps, kind="stable")
        found_at, found = np.zeros(0, int), np.zeros(0)
        for i in range(0, len(order), STEP_LEAVES):
            if gaps[order[i]] > ratio * max(bound, LEAST):
                break
            rows = np.concatenate([np.arange(self.ends[j], self.ends[j + 1]) for j in order[i:i + STEP_LEAVES]])
            rows = rows[self.ids[rows] != own]
            found_at = np.concatenate([found_at, rows])
            found = np.concatenate([found, self.unit[rows] @ unit])
            if len(found) >= k:
                kth = np.partition(found, len(found) - k)[len(found) - k]
                bound = min(bound, 2 - 2 * kth)
                keep = found >= kth - 1e-9
                found_at, found = found_at[keep], found[keep]
        if not len(found_at):
            return []
        x = self.vectors[found_at]  # row by row, so that equal vectors get equal scores
        exact = (x * query).sum(1) / (np.sqrt((x * x).sum(1)) * math.sqrt((query * query).sum()))
        best = np.lexsort((self.ids[found_at], -exact))[:k]
        return [(int(self.ids[found_at[i]]), float(exact[i])) for i in best]


def _valid(vectors: DataFrame) -> DataFrame:
    """(``vec_id``, ``v`` array of double) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(fine & F.exists("v", lambda x: x != 0))


def nearest(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of largest cosine found for
    each row whose id is divisible by ``every``.

    Vectors that are null, zero, or hold null or non-finite components take no
    part, nor do rows without an id, nor vectors of another length than most.
    Repeated rows count once.  An id with several vectors asks with the least of
    them (component by component), and each of them is a candidate.  Fewer candidates than ``k`` are all returned;
    an empty table gives no rows.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    valid = _valid(vectors).dropDuplicates(["vec_id", "v"])
    widths = valid.groupBy(F.size("v").alias("w")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("w")).first()
    if widths is None:
        return empty
    width, n = widths["w"], widths["n"]
    valid = valid.where(F.size("v") == width)
    dims = projection(width)
    ratio = stop_ratio()
    share = min(1.0, SAMPLE_ROWS / n)
    sample = valid.where((F.xxhash64(F.lit("knn"), "vec_id") / F.lit(2.0 ** 64) + 0.5) < share).select("v").collect()  # SAMPLE_ROWS, about
    points = (_unit(np.array([r["v"] for r in sample])) @ dims) if sample else np.zeros((0, DIMS))
    levels = max(0, min(math.ceil(math.log2(max(1, n / BLOCK_ROWS))), int(math.log2(MOST_CELLS))))
    shared = spark.sparkContext.broadcast((dims, Cells(points, levels)))

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g, cells = shared.value
        for p in parts:
            if len(p):
                yield p.assign(cell=cells.cell(_unit(np.stack(p["v"].to_numpy())) @ g))

    placed = saved(valid.mapInPandas(place, "vec_id long, v array<double>, cell int"), "knn-cells")
    sizes = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # MOST_CELLS at most
    salts = spark.createDataFrame([(c, max(1, -(-m // BLOCK_ROWS))) for c, m in sizes.items()], "cell int, salts int")
    rows = placed.join(F.broadcast(salts), "cell").withColumn("salt", F.pmod(F.xxhash64("vec_id"), "salts").cast("int"))
    blocks = rows.select("cell", "salt", "vec_id", "v")
    queries = placed.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("v", "cell")).alias("least")).select("vec_id", "least.*")
    result = "query_id long, vec_id long, score double"

    def search(_: tuple, block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, float]] = []
        if len(block) and len(asked):
            g, _cells = shared.value
            tree = Block(block["vec_id"].to_numpy(), np.stack(block["v"].to_numpy()), g)
            for own, v, bound in zip(asked["query_id"], asked["qv"], asked["bound"], strict=True):
                q = np.asarray(v)
                at = (q / math.sqrt((q * q).sum())) @ g
                out += [(own, i, s) for i, s in tree.search(own, q, at, k, bound, ratio)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    def ask(to: DataFrame) -> DataFrame:
        return blocks.groupBy("cell", "salt").cogroup(to.groupBy("to_cell", "to_salt")).applyInPandas(search, result)

    # round 1: one block of the query's own cell
    first = queries.join(F.broadcast(salts), "cell").select(
        F.col("cell").alias("to_cell"), F.pmod(F.xxhash64("vec_id"), "salts").cast("int").alias("to_salt"), F.col("vec_id").alias("query_id"), F.col("v").alias("qv"),
        F.lit(4.0).alias("bound"))
    found = saved(ask(first), "knn-first")
    kth = found.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
    # round 2: the other blocks that the test doesn't rule out
    counts = np.array([-(-sizes.get(c, 0) // BLOCK_ROWS) for c in range(1 << levels)])
    per_cell = spark.sparkContext.broadcast(counts)

    def route(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g, cells = shared.value
        low, high = cells.boxes()
        salted = per_cell.value
        for p in parts:
            out = []
            for own, v, home, salt, bound in zip(p["query_id"], p["qv"], p["to_cell"], p["to_salt"], p["bound"], strict=True):
                q = np.asarray(v)
                at = (q / math.sqrt((q * q).sum())) @ g
                for c in np.flatnonzero(_gap(at, low, high) <= ratio * max(bound, LEAST)):
                    out += [(int(c), s, own, v, bound) for s in range(salted[c]) if (c, s) != (home, salt)]
            yield pd.DataFrame(out, columns=["to_cell", "to_salt", "query_id", "qv", "bound"])

    bounded = first.drop("bound").join(kth, "query_id", "left").withColumn("bound", F.coalesce(2 - 2 * F.col("kth"), F.lit(4.0)))
    routed = bounded.select("query_id", "qv", "to_cell", "to_salt", "bound").mapInPandas(
        route, "to_cell int, to_salt int, query_id long, qv array<double>, bound double")
    every_found = found.unionByName(ask(routed))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return every_found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
