"""Boosted forecasts learn from every row of their periods, at every size."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tradecast import registry
from tradecast.operators import boosting as B
from tradecast.plans import forecast as M
from tradecast.plans import models
from tradecast.plans.params import DEFAULT, PER_PRODUCT


@pytest.mark.parametrize("p", [replace(DEFAULT, series_col="product_name"), PER_PRODUCT], ids=["F2", "F3-F7"])
def test_a_fit_takes_every_row(spark, sf_dir, p):
    """Series with more than 100,000 training rows."""
    c = registry.cleaned(spark, sf_dir)
    every = M.supervised(c, p).groupBy(M.split_label(F.col("target_date"), p).alias("split")).agg(F.count("*").alias("n"), F.sum("y_target").alias("y"))
    want = {r["split"]: (r["n"], r["y"]) for r in every.collect()}
    got = [tuple(d.agg(F.count("*"), F.sum("label")).first()) for d in models.fit_sets(c, p, lambda _, df: df)]
    assert got[:2] == [want["train"], want["val"]] and got[0][0] > 100_000
    assert got[2] == tuple(map(sum, zip(want["train"], want["val"], want["mid"], strict=True)))


def test_leaf_percentiles_are_exact_and_hold_no_map(spark):
    """all rows of a leaf, so no aggregate may keep the values of one."""
    rng = random.Random(3)
    rows = [(g, rng.choice([0.0, 0.0, 1.0, rng.uniform(-9, 9)])) for g in range(3) for _ in range(200 + g)] + [(3, 2.5)]
    df = spark.createDataFrame(rows, "g int, x double")
    for alpha in (0.0, 0.5, 0.68, 1.0):
        want = {r["g"]: r["v"] for r in df.groupBy("g").agg(F.percentile("x", F.lit(alpha)).alias("v")).collect()}
        out = B.percentiles(df.groupBy("g", "x").agg(F.count("*").alias("n")), ["g"], "x", alpha)
        assert "ObjectHashAggregate" not in out._jdf.queryExecution().executedPlan().toString()
        assert {r["g"]: r["v"] for r in out.collect()} == pytest.approx(want)
    assert B.percentiles(df.where("false").groupBy("x").agg(F.count("*").alias("n")), [], "x", 0.5).collect() == []
