"""The rows of the per-product set are made by tasks of bounded size."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tradecast import registry
from tradecast.plans import forecast as M
from tradecast.plans.params import PER_PRODUCT


def test_tasks_of_the_feature_rows_grow_with_the_rows(spark, sf_dir, monkeypatch):
    """the files of the series are small, their rows are not."""
    monkeypatch.setattr(M, "TASK_ROWS", 20_000)
    c = registry.cleaned(spark, sf_dir)
    out = M.m2_direct_features(c, PER_PRODUCT)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    n = sum(sizes)
    assert out.rdd.getNumPartitions() == math.ceil(n / 20_000) > 30
    assert max(sizes) < n / 10
    whole = M.supervised(c, PER_PRODUCT)
    assert whole.count() == n and whole.exceptAll(out).count() == 0


def test_tasks_are_few_for_few_rows(spark, sf_dir):
    c, cores = registry.cleaned(spark, sf_dir), spark.sparkContext.defaultParallelism
    assert M.tasks_for(c, 0, 10, 100) == 1 == M.tasks_for(c, 10, 10, 100)
    assert M.tasks_for(c, 10 * cores + 1, 10, 1000) == cores
    assert M.tasks_for(c, 1000 * cores + 1, 10, 1000) == cores + 1
