"""Boosted regression trees: patience on a validation curve, and a quantile loss.

MLlib's boosting knows the squared and the absolute loss and stops at the first
round without a gain.  Here the number of trees of the mean model is read off
the whole validation curve, and the quantile model is boosted round by round:
an MLlib tree is fitted to the signs of the residuals, and each of its leaves
is set to the quantile of the residuals that fall into it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradecast.session import scratch_dir

WRITTEN_EVERY = 20  # rounds after which the running prediction is written, which cuts its lineage


@dataclass(frozen=True)
class TreeParams:
    rounds: int = 300
    patience: int = 50
    rate: float = 0.05
    depth: int = 5
    min_rows: int = 20
    bins: int = 32
    seed: int = 42


def best_round(curve: list[float], patience: int) -> tuple[int, bool]:
    """The round (from 1) of least error before ``patience`` rounds in a row
    brought no new least, and whether that many did."""
    best, at = float("inf"), 0
    for i, e in enumerate(curve, start=1):
        if e < best:
            best, at = e, i
        elif i - at >= patience:
            return at, True
    return at, False


def _gbt(t: TreeParams, rounds: int) -> GBTRegressor:
    return GBTRegressor(featuresCol="features", labelCol="label", maxIter=rounds, stepSize=t.rate, maxDepth=t.depth,
                        maxBins=t.bins, minInstancesPerNode=t.min_rows, seed=t.seed)


def fit_mean(train: DataFrame, t: TreeParams, rounds: int) -> GBTRegressionModel:
    """Squared loss, a fixed number of trees (``features``, ``label``)."""
    return _gbt(t, rounds).fit(train)


def mean_rounds(train: DataFrame, val: DataFrame, t: TreeParams = TreeParams()) -> tuple[int, list[float]]:
    """Number of trees of least mean absolute error on ``val`` under patience, and
    the curve.  A fit with more trees begins with those of a shorter one, so the
    fit doubles until the patience has run out."""
    rounds = min(t.rounds, t.patience + t.patience // 4 + 1)
    while True:
        curve = fit_mean(train, t, rounds).evaluateEachIteration(val, "absolute")
        at, stopped = best_round(curve, t.patience)
        if stopped or rounds == t.rounds:
            return max(1, at), curve
        rounds = t.rounds if 3 * rounds > t.rounds else 2 * rounds


def pinball(y: Column, pred: Column, alpha: float) -> Column:
    return F.greatest(F.lit(alpha) * (y - pred), F.lit(alpha - 1.0) * (y - pred))


@dataclass
class QuantileModel:
    """``base`` plus, for each tree, the value of the leaf that a row falls into."""

    alpha: float
    base: float
    trees: list[tuple[DecisionTreeRegressionModel, dict[float, float]]] = field(default_factory=list)
    curve: list[float] = field(default_factory=list)

    def predict(self, df: DataFrame, name: str) -> DataFrame:
        """Adds the prediction of all trees as column ``name``."""
        kept, steps = df.columns, []
        for i, (tree, leaves) in enumerate(self.trees):
            df = tree.setLeafCol(f"_leaf_{i}").setPredictionCol("").transform(df)
            steps.append(leaf_value(F.col(f"_leaf_{i}"), leaves))
        total = F.aggregate(F.array(*steps), F.lit(self.base), lambda s, x: s + x) if steps else F.lit(self.base)
        return df.select(*[c for c in kept if c != name], total.alias(name))


def leaf_value(leaf: Column, leaves: dict[float, float]) -> Column:
    """The value of a leaf; 0 for one in which no training row fell."""
    table = F.create_map(*[F.lit(x) for pair in leaves.items() for x in pair])
    return F.coalesce(F.try_element_at(table, leaf), F.lit(0.0))


def percentiles(counts: DataFrame, by: list[str], value: str, alpha: float) -> DataFrame:
    """(``by``, ``v``): the exact percentile of each group of ``counts`` (``by``,
    ``value``, ``n``), rows of distinct values, between the two nearest ranks as
    ``percentile`` has it.  No value is held in a map: the ranks are sums over the
    sorted values, which may spill."""
    group = Window.partitionBy(*by)
    ranked = counts.select(*by, F.col(value).alias("_x"), F.sum("n").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"),
                           (F.lit(alpha) * (F.sum("n").over(group) - 1)).alias("_at"))
    lo, hi = F.floor("_at"), F.ceil("_at")
    ends = ranked.groupBy(*by, "_at").agg(F.min(F.when(F.col("_upto") > lo, F.col("_x"))).alias("_a"), F.min(F.when(F.col("_upto") > hi, F.col("_x"))).alias("_b"))
    a, b, at = F.col("_a").cast("double"), F.col("_b").cast("double"), F.col("_at")
    return ends.select(*by, F.when((lo == hi) | (a == b), a).otherwise((hi - at) * a + (at - lo) * b).alias("v"))


def fit_quantile(train: DataFrame, alpha: float, t: TreeParams = TreeParams(), val: DataFrame | None = None) -> QuantileModel:
    """Boosting on the pinball loss (``features``, ``label``).  With ``val`` it
    stops under patience and keeps the trees up to the least loss there; without,
    it makes ``t.rounds`` trees.

    Leaf values are exact percentiles of the rows of a leaf, however many: equal
    residuals are counted where they lie, and only their counts are shuffled.  At
    most 2^depth values reach the driver in a round.
    """
    both = train.select("features", "label", F.lit(False).alias("is_val"))
    if val is not None:
        both = both.unionByName(val.select("features", "label", F.lit(True).alias("is_val")))
    base = percentiles(train.groupBy("label").agg(F.count("*").alias("n")), [], "label", alpha).first()
    model = QuantileModel(alpha, float(base["v"] if base else 0.0))
    learner = DecisionTreeRegressor(featuresCol="features", labelCol="sign", maxDepth=t.depth, maxBins=t.bins,
                                    minInstancesPerNode=t.min_rows, seed=t.seed, leafCol="leaf", predictionCol="")
    residual = F.col("label") - F.col("f")
    sign = F.when(residual > 0, alpha).otherwise(alpha - 1.0)
    state = both.select("*", F.lit(model.base).alias("f"), F.lit(alpha).alias("sign")).withColumn("sign", sign).persist()
    before = None
    for r in range(t.rounds):
        if r and val is not None:  # the loss before this tree
            of_val = state.where("is_val").agg(F.sum(pinball(F.col("label"), F.col("f"), alpha)).alias("e"), F.count("*").alias("n")).first()
            model.curve.append((of_val["e"] or 0.0) / max(1, of_val["n"]))
            if best_round(model.curve, t.patience)[1]:
                break
        tree = learner.fit(state.where(~F.col("is_val")))
        if before is not None:  # the fit has read ``state`` by now
            before.unpersist()
        placed = tree.transform(state)
        seen = placed.where(~F.col("is_val")).groupBy("leaf", residual.alias("residual")).agg(F.count("*").alias("n"))
        leaves = {float(x["leaf"]): t.rate * float(x["v"]) for x in percentiles(seen, ["leaf"], "residual", alpha).collect()}
        model.trees.append((tree, leaves))
        moved = placed.select("features", "label", "is_val", (F.col("f") + leaf_value(F.col("leaf"), leaves)).alias("f")).withColumn("sign", sign)
        if (r + 1) % WRITTEN_EVERY == 0:
            path = scratch_dir(train.sparkSession, "boosting")
            moved.write.parquet(path)
            moved = train.sparkSession.read.schema(moved.schema).parquet(path)
        before, state = state, moved.persist()
    for df in (before, state):
        if df is not None:
            df.unpersist()
    if val is not None:
        model.trees = model.trees[:max(1, best_round(model.curve, t.patience)[0])]
    return model
