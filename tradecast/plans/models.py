"""Boosted-tree forecasts with MLlib (M7, M8) and the full evaluation tables.

* M7: boosted trees with the squared loss on the direct multi-horizon set; the
  number of trees is that of least absolute error on the validation split with
  patience, then a refit with that number on every row before
  the test period; predictions clipped at 0.
* M8: the same with the pinball loss at 0.68 (``operators.boosting``).

The rows of series that are an attribute of products are written once, and both
fits and all forecasts read them; those of products, a hundred times the size of
their sources, are made from the written series: those of the fits once, those
of the test period by the pass that reads them.  Fits take every row of their
periods, at every size of the input; forecasts and metrics cover all rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import replace

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradecast.operators import boosting
from tradecast.operators.clean import Cleaned
from tradecast.plans import forecast as M
from tradecast.plans.params import DEFAULT, Params

TASK_ROWS = 25_000        # rows of a task of a fit, about: few tasks, as a fit has several jobs a tree ...
LARGE_TASK_ROWS = 200_000  # ... and where all cores are busy
# A tree costs some eight Spark jobs, whatever its rows.  The registered tables
# learn four times as fast as ``boosting.TreeParams()`` (300 rounds of 0.05 with
# a patience of 50) and have a sixth of its patience; pass other ``trees`` for more.
TREES = boosting.TreeParams(rounds=24, patience=8, rate=0.2)
QUANTILE = 0.68
# What a row is known by; every other column of the supervised set is a feature.
KEYS = ["series_id", "origin_date", "target_date", "y_target"]


def _tag(p: Params) -> str:
    return hashlib.sha1(repr(p).encode()).hexdigest()[:12]


def _dataset(c: Cleaned, p: Params, **only) -> DataFrame:
    """The supervised set with ``split``, ``label`` and ``series_level``.

    A series is told by its mean demand over the training split: one number per
    series, computed where the series lies, however many there are.  Per product
    the set is not written: the rows that a pass needs are made for it, and
    ``only`` (``first_target``, ``tasks``) says to ``supervised`` which and where."""
    def rows(**only) -> DataFrame:
        return M.supervised(c, p, level=True, **only).select(
            "*", M.split_label(F.col("target_date"), p).alias("split"), F.col("y_target").cast("double").alias("label"))
    return rows(**only) if p.series_col == "product_id" else c.cached(f"supervised_{_tag(p)}", rows)


def _vectors(df: DataFrame) -> DataFrame:
    features = [x for x in df.columns if x not in (*KEYS, "split", "label")]
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep").transform(df)


def fit_sets(c: Cleaned, p: Params, name) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, val, retrain) as ``features``, ``label``: every row of each period.
    ``name`` writes a table.  Per product the rows of all three are written once,
    made from the series, which are dealt to the tasks in their place."""
    split, known = F.col("split"), F.col("target_date") <= F.lit(p.mid_end).cast("date")
    mine = {"train": split == "train", "val": split == "val", "retrain": known}
    of = {"train": ("train",), "val": ("val",), "retrain": ("train", "val", "mid")}
    weeks = M.target_weeks(c, p)
    tasks = {part: M.tasks_for(c, sum(n for _, s, n in weeks if s in names), TASK_ROWS, LARGE_TASK_ROWS) for part, names in of.items()}
    if p.series_col == "product_id":
        every = _vectors(name("known", _dataset(c, p, tasks=tasks["retrain"]).where(known)))
        parts = [every.where(rows).select("features", "label") for rows in mine.values()]
    else:
        every = _vectors(_dataset(c, p))
        parts = [name(part, every.where(rows).select("features", "label").repartition(tasks[part])) for part, rows in mine.items()]
    return parts[0], parts[1], parts[2]


def _fitted(c: Cleaned, p: Params, name: str, forecast) -> DataFrame:
    """Forecasts of one model for the test rows, written once per session."""
    def build() -> DataFrame:
        train, val, retrain = fit_sets(c, p, lambda part, df: c.cached(f"fit_{part}_{_tag(p)}", lambda: df))
        out = forecast(train, val, retrain, _vectors(_dataset(c, p, first_target=p.test_start).where(F.col("split") == "test")))
        return out.select("series_id", "origin_date", "horizon", "target_date", "y_target", "window_peak1", "y_lag_52", "growth",
                          F.greatest(F.col("raw"), F.lit(0.0)).alias("pred"), "n_trees")
    return c.cached(f"{name}_{_tag(p)}", build)


def mean_forecasts(c: Cleaned, p: Params = DEFAULT, trees: boosting.TreeParams = TREES) -> DataFrame:
    """Test rows with the boosted mean ``pred`` and its number of trees."""
    def forecast(train: DataFrame, val: DataFrame, retrain: DataFrame, test: DataFrame) -> DataFrame:
        n, _ = boosting.mean_rounds(train, val, trees)
        model = boosting.fit_mean(retrain, trees, n)
        return model.setPredictionCol("raw").transform(test).withColumn("n_trees", F.lit(n))
    return _fitted(c, p, "mean_forecasts", forecast)


def quantile_forecasts(c: Cleaned, p: Params = DEFAULT, trees: boosting.TreeParams = TREES) -> DataFrame:
    """Test rows with the boosted 0.68 quantile ``pred`` and its number of trees."""
    def forecast(train: DataFrame, val: DataFrame, retrain: DataFrame, test: DataFrame) -> DataFrame:
        n = len(boosting.fit_quantile(train, QUANTILE, trees, val).trees)
        model = boosting.fit_quantile(retrain, QUANTILE, replace(trees, rounds=n))
        return model.predict(test, "raw").withColumn("n_trees", F.lit(n))
    return _fitted(c, p, "quantile_forecasts", forecast)


_FORECAST = ["series_id", "origin_date", "horizon", "target_date", "y_target", "window_peak1", "pred", "n_trees"]


def m7_gbt_mean(c: Cleaned, p: Params = DEFAULT) -> DataFrame:
    return mean_forecasts(c, p).select(*_FORECAST)


def m8_quantile(c: Cleaned, p: Params = DEFAULT) -> DataFrame:
    return quantile_forecasts(c, p).select(*_FORECAST)


def all_predictions(c: Cleaned, p: Params = DEFAULT) -> DataFrame:
    """The four models' predictions in long form, from the written forecasts."""
    rows = ["series_id", "origin_date", "horizon", "target_date", "y_target", "window_peak1"]
    mean = mean_forecasts(c, p).select(*rows, F.expr(
        f"stack(3, '{M.MODEL_NAIVE}', greatest(y_lag_52, 0D), '{M.MODEL_GROWTH}', greatest(y_lag_52 * growth, 0D), '{M.MODEL_GBT}', pred) AS (model, pred)"))
    return mean.unionByName(quantile_forecasts(c, p).select(*rows, F.lit(M.MODEL_QUANTILE).alias("model"), "pred"))


def m9_metrics_all(c: Cleaned, p: Params = DEFAULT) -> DataFrame:
    return M.metrics(all_predictions(c, p), p)


def m10_metrics_h12_all(c: Cleaned, p: Params = DEFAULT) -> DataFrame:
    pl = all_predictions(c, p).where(F.col("horizon") == p.horizons)
    return M.with_savings(M.metrics(pl, p))


def m12_capacity_gbt(c: Cleaned, p: Params = DEFAULT) -> DataFrame:
    """Capacity check on the boosted-tree mean forecast (h = 12), as the reference does."""
    curve = M.h12_curve(all_predictions(c, p), p,
                        (M.MODEL_NAIVE, M.MODEL_GROWTH, M.MODEL_GBT, M.MODEL_QUANTILE))
    cap = M.capacity(c, p)
    k = cap.select(F.struct("capacity_base", "capacity_max")).scalar()
    base, top = k.getField("capacity_base"), k.getField("capacity_max")
    pred = F.col(f"`{M.MODEL_GBT}`")
    return curve.select("target_date", "actual", pred.alias("pred_gbt"), base.alias("capacity_base"),
                        top.alias("capacity_max"), (pred > base).cast("int").alias("over_base"),
                        (pred > top).cast("int").alias("over_max"))
