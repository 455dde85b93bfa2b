"""Boosting: the quantile loss against numpy, patience against the curve."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from tradecast.operators import boosting as B
from tradecast.plans import models

ALPHA = 0.68


def _rows(n: int, seed: int):
    rng = np.random.default_rng(seed)
    x = rng.uniform(0, 10, (n, 2))
    y = 5 * (x[:, 0] > 5) + x[:, 1] + rng.exponential(2.0, n)
    return x, y


def _frame(spark, x, y):
    return spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y, strict=True)], ["features", "label"]).repartition(2)


def _pinball(y, f):
    return float(np.mean(np.maximum(ALPHA * (y - f), (ALPHA - 1) * (y - f))))


@pytest.fixture(scope="module")
def fitted(spark):
    t = B.TreeParams(rounds=12, patience=50, rate=0.3, depth=3)
    x, y = _rows(500, 1)
    xv, yv = _rows(500, 2)
    return t, x, y, xv, yv, B.fit_quantile(_frame(spark, x, y), ALPHA, t, _frame(spark, xv, yv))


def test_quantile_boosting_equals_numpy(spark, fitted):
    t, x, y, xv, yv, model = fitted
    f, fv = np.full(500, np.quantile(y, ALPHA)), np.full(500, np.quantile(y, ALPHA))
    curve = []
    for tree, leaves in model.trees:
        sign = np.where(y > f, ALPHA, ALPHA - 1)
        leaf = np.array([tree.predictLeaf(Vectors.dense(a)) for a in x])
        value = {k: t.rate * np.quantile((y - f)[leaf == k], ALPHA) for k in set(leaf)}
        assert leaves == pytest.approx(value)
        learnt = np.array([tree.predict(Vectors.dense(a)) for a in x])
        for k in value:  # the tree is one of the signs of the residuals
            assert learnt[leaf == k] == pytest.approx(sign[leaf == k].mean())
        f = f + np.array([value[k] for k in leaf])
        fv = fv + np.array([value[tree.predictLeaf(Vectors.dense(a))] for a in xv])
        curve.append(_pinball(yv, fv))
    assert model.curve[:len(curve)] == pytest.approx(curve[:len(model.curve)])
    got = [r["f"] for r in model.predict(_frame(spark, x, y).coalesce(1), "f").select("f", "label").sort("label").collect()]
    assert got == pytest.approx(f[np.argsort(y)])


def test_quantile_boosting_covers_and_beats_a_shifted_mean(fitted):
    t, x, y, xv, yv, model = fitted
    fv = np.array([model.base + sum(v.get(tree.predictLeaf(Vectors.dense(a)), 0.0) for tree, v in model.trees) for a in xv])
    assert abs(np.mean(yv <= fv) - ALPHA) < 0.06  # 500 rows: three standard errors
    assert _pinball(yv, fv) < _pinball(yv, np.full(500, np.quantile(y, ALPHA))) * 0.8


@pytest.mark.parametrize("curve,patience,want", [
    ([3, 2, 1, 2, 2], 2, (3, True)), ([3, 2, 1, 2, 0.5, 4], 2, (5, False)), ([1.0] * 60, 50, (1, True)), ([], 5, (0, False)),
    ([5, 4, 3, 2, 1], 1, (5, False)), ([float("nan"), 1.0], 5, (2, False))])
def test_best_round(curve, patience, want):
    assert B.best_round(curve, patience) == want


def test_mean_trees_are_the_minimum_of_the_curve_under_patience(spark):
    x, y = _rows(400, 3)
    xv, yv = _rows(400, 4)
    t = B.TreeParams(rounds=40, patience=10, rate=0.3, depth=3)
    n, curve = B.mean_rounds(_frame(spark, x, y), _frame(spark, xv, yv), t)
    assert n == B.best_round(curve, 10)[0] > 1
    assert curve[n - 1] == min(curve[:n + 10])


def test_defaults_are_those_of_the_full_fit():
    assert (B.TreeParams().rounds, B.TreeParams().patience, B.TreeParams().rate) == (300, 50, 0.05)
    assert models.TREES.rounds < 300
