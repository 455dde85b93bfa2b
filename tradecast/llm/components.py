"""Connected components of a graph held as a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradecast.llm.common import saved


def components(edges: DataFrame, name: str) -> DataFrame:
    """(``node``, ``root``) of every node of ``edges`` (``a``, ``b``), root being
    the smallest node of its component.

    Large-star and small-star rounds in turn: every node hands its neighbours
    the smallest it knows, until each points at the root.  A round is written
    to the shared folder; no round holds a node's neighbours in one place.
    """
    edges = saved(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("u")).agg(F.least(F.col("u"), F.min("b")).alias("m"))
        large = both.join(low, both["a"] == low["u"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(low, large["a"] == low["u"]).where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = saved(small.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), name)
        after = _state(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
