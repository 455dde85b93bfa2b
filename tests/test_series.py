"""The supervised set off prefix sums: the same rows by either way, and a plan
without a sort, a window or a shuffle of the panel."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradecast.plans import forecast as M
from tradecast.plans.params import DEFAULT, PER_PRODUCT
from tradecast.plans.timeseries import t3_dense_panel
from tradecast.registry import cleaned


@pytest.mark.parametrize("query", [M.m2_direct_features, M.m2_feature_sums, M.m4_time_split, M.m9_metrics_global])
def test_per_product_plans_stream(spark, sf_dir, query):
    """rows of origins and horizons need no sort and no window."""
    plan = query(cleaned(spark, sf_dir), PER_PRODUCT)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [" not in plan and "sort_array" not in plan and "Join" not in plan


def test_level_is_the_mean_of_the_training_targets(spark, sf_dir):
    """The level of a series comes with its row, as the mean over the written rows would."""
    rows = M.supervised(cleaned(spark, sf_dir), DEFAULT, level=True)
    train = rows.where(F.col("target_date") <= F.lit(DEFAULT.train_end).cast("date"))
    want = {r[0]: r[1] for r in train.groupBy("series_id").agg(F.avg("y_target")).collect()}
    got = {r[0]: r[1] for r in rows.select("series_id", "series_level").distinct().collect()}
    assert got and all(abs(got[k] - want.get(k, 0.0)) < 1e-9 for k in got)


def test_both_ways_give_the_same_rows(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    a, b = M.direct_features(t3_dense_panel(c)), M.m2_direct_features(c)
    assert a.columns == b.columns and a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def test_spread_of_large_and_constant_demand(spark):
    days = [dt.date(2020, 1, 5) + dt.timedelta(days=7 * i) for i in range(80)]
    rows = [(d, s, v) for i, d in enumerate(days) for s, v in (("flat", 9_999_999), ("step", 9_000_000 + i % 2))]
    f = M.direct_features(spark.createDataFrame(rows, "week_end date, series_id string, demand long"))
    got = {r[0]: r[1] for r in f.groupBy("series_id").agg(F.max("std_8")).collect()}
    assert got["flat"] == 0.0 and got["step"] == pytest.approx((8 * 0.25 / 7) ** 0.5, abs=1e-6)
