"""Per-series statistics as expressions (E2 ADF, E4b PACF).

Sums over the rows of a series are ordinary aggregates; the small systems that
remain, of the size of the lags, are folds over arrays.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradecast.functions.numeric import round_half_up

# MacKinnon (2010) response-surface coefficients for the ADF
# critical values, one variable, constant-only regression: 1 %, 5 %, 10 %,
# crit = b0 + b1/T + b2/T^2 + b3/T^3.
ADF_CRIT_C = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}


# MacKinnon (1994) response surface of the p-value, one variable,
# constant-only regression: p = Phi(c0 + c1 t + c2 t^2 + c3 t^3), with the first
# set up to the dividing statistic, the second above it, and 0 or 1 outside.
ADF_P_DIVIDE, ADF_P_LEAST, ADF_P_MOST = -1.61, -18.83, 2.74
ADF_P_LOW = (2.1659, 1.4412, 0.038269)
ADF_P_HIGH = (1.7339, 0.93202, -0.12745, -0.010368)

NORMAL_TERMS = 150  # of the power series below, enough for |x| <= 8


def normal_cdf(x: F.Column) -> F.Column:
    """The normal distribution function: 1/2 + phi(x) (x + x^3/3 + x^5/15 + ...),
    folded over its terms; beyond 8 standard deviations it is 0 or 1."""
    step = F.aggregate(
        F.sequence(F.lit(1), F.lit(NORMAL_TERMS)), F.struct(x.alias("term"), x.alias("sum")),
        lambda s, k: F.struct((s["term"] * x * x / (2 * k + 1)).alias("term"), (s["sum"] + s["term"] * x * x / (2 * k + 1)).alias("sum")),
        lambda s: s["sum"])
    inside = F.lit(0.5) + F.exp(-x * x / 2) / F.lit(math.sqrt(2 * math.pi)) * step
    return F.when(x < -8, 0.0).when(x > 8, 1.0).when(x.isNotNull(), inside)


def adf_p_value(stat: F.Column) -> F.Column:
    def surface(coefs: tuple) -> F.Column:
        out = F.lit(0.0)
        for c in reversed(coefs):
            out = out * stat + F.lit(c)
        return out
    z = F.when(stat <= ADF_P_DIVIDE, surface(ADF_P_LOW)).otherwise(surface(ADF_P_HIGH))
    return F.when(stat < ADF_P_LEAST, 0.0).when(stat > ADF_P_MOST, 1.0).otherwise(normal_cdf(z))


def moments(rows: DataFrame, series: str, vector: str) -> DataFrame:
    """Sums of the products of all pairs of components of ``vector``, by series:
    ``m``, the lower triangle row by row.  Pre-aggregated by pair, so a series
    meets in one place only as its few sums."""
    pairs = F.flatten(F.transform(vector, lambda a, i: F.transform(F.slice(vector, F.lit(1), i + 1), lambda b, j: F.struct(i.alias("_i"), j.alias("_j"), (a * b).alias("_p")))))
    sums = rows.select(series, F.inline(pairs)).groupBy(series, "_i", "_j").agg(F.sum("_p").alias("_s"))
    lower = F.sort_array(F.collect_list(F.struct("_i", "_j", "_s")))
    return sums.groupBy(series).agg(F.transform(lower, lambda e: e["_s"]).alias("m"), (F.max("_i") + 1).alias("size"))


def cholesky(m: F.Column, size: F.Column) -> F.Column:
    """Rows of the lower Cholesky factor of a moment matrix, as a fold over rows
    and, in each, over columns."""
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)

    def row(done: F.Column, i: F.Column) -> F.Column:
        def entry(mine: F.Column, j: F.Column) -> F.Column:
            here = F.get(m, F.floor(i * (i + 1) / 2).cast("int") + j)
            above = F.get(done, j)
            off = (here - dot(mine, F.slice(above, F.lit(1), j))) / F.get(above, j)
            return F.concat(mine, F.array(F.when(j < i, off).otherwise(F.sqrt(F.greatest(here - dot(mine, mine), F.lit(0.0))))))
        return F.aggregate(F.sequence(F.lit(0), i), F.array().cast("array<double>"), entry)

    return F.aggregate(F.sequence(F.lit(0), size - 1), F.array().cast("array<array<double>>"), lambda done, i: F.concat(done, F.array(row(done, i))))


def adf(df: DataFrame, series: str, order: str, value: str) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant, one row per series: the
    number of lags is that of least AIC on a common sample, the statistic that of
    the regression on the full sample with so many lags.

    Both regressions come out of cross-moments of the level and the lagged
    differences, summed by one ``groupBy`` each: in the Cholesky factor of the
    moments, the last row holds the residual sums of all nested regressions.
    A series that is constant or too short (maximal lag below 0) has no statistic.
    """
    y = F.col(value).cast("double")
    all_rows = Window.partitionBy(series)
    w = Window.partitionBy(series).orderBy(order)
    longest = df.groupBy(series).count().agg(F.max("count")).first()[0] or 0  # weeks of the calendar, at most
    widest = max(1, math.ceil(12.0 * (longest / 100.0) ** 0.25))
    base = df.select(F.col(series).cast("string").alias(series), F.col(order), y.alias("_y"))
    # the statistic does not depend on location and scale; the moments are the better for it
    level = base.select(series, order, F.count("*").over(all_rows).alias("n"),
                        ((F.col("_y") - F.avg("_y").over(all_rows)) / F.nullif(F.stddev_samp("_y").over(all_rows), F.lit(0.0))).alias("_z"))
    most = F.least(F.ceil(F.lit(12.0) * F.pow(F.col("n") / F.lit(100.0), F.lit(0.25))), F.floor(F.col("n") / 2) - 2).cast("int")
    before = F.lag("_z", 1).over(w)
    step = level.select(series, order, "n", most.alias("most"), before.alias("_before"), (F.col("_z") - before).alias("_d"), (F.row_number().over(w) - 1).alias("_at"))
    rows = step.select("*", F.array(*[F.lag("_d", j).over(w) for j in range(1, widest + 1)]).alias("_lags"))
    rows = rows.where((F.col("most") >= 0) & F.col("_d").isNotNull())

    def lags(k: F.Column) -> F.Column:
        return F.slice("_lags", F.lit(1), k)

    nested = rows.where(F.col("_at") > F.col("most")).withColumn(
        "_v", F.concat(F.array(F.lit(1.0), F.col("_before")), lags(F.col("most")), F.array("_d")))
    common = moments(nested, series, "_v").withColumn("l", F.element_at(cholesky(F.col("m"), F.col("size")), -1))
    common = common.select(series, (F.col("size") - 3).alias("most"), F.element_at("m", -1).alias("tt"), F.element_at("m", 1).alias("nobs"), "l")
    ssr = F.transform(F.sequence(F.lit(0), F.col("most")), lambda k: F.aggregate(F.slice("l", F.lit(1), k + 2), F.col("tt"), lambda s, v: s - v * v))
    aic = F.transform(ssr, lambda s, k: F.col("nobs") * (F.lit(math.log(2 * math.pi) + 1) + F.log(s / F.col("nobs"))) + 2 * (k + 2))
    chosen = common.select(series, aic.alias("aic")).select(series, (F.array_position("aic", F.array_min("aic")) - 1).cast("int").alias("used_lag"))

    full = rows.join(chosen, series).where(F.col("_at") > F.col("used_lag")).withColumn(
        "_v", F.concat(F.array(F.lit(1.0)), lags(F.col("used_lag")), F.array("_before", "_d")))
    last = moments(full, series, "_v").withColumn("l", F.element_at(cholesky(F.col("m"), F.col("size")), -1))
    k, nobs = F.col("size") - 3, F.element_at("m", 1)
    found = last.select(series, nobs.cast("int").alias("n_obs"), k.cast("int").alias("used_lag"),
                        (F.element_at("l", -2) / F.sqrt(F.pow(F.element_at("l", -1), F.lit(2.0)) / (nobs - k - 2))).alias("_stat"))
    t = F.col("n_obs")

    def crit(name: str) -> F.Column:
        b = ADF_CRIT_C[name]
        return F.lit(b[0]) + F.lit(b[1]) / t + F.lit(b[2]) / (t * t) + F.lit(b[3]) / (t * t * t)

    out = base.select(series).distinct().join(found, series, "left")
    return out.select(series, F.coalesce("n_obs", F.lit(0)).alias("n_obs"), "used_lag", round_half_up(F.col("_stat"), 6).alias("adf_stat"),
                      round_half_up(adf_p_value(F.col("_stat")), 6).alias("p_value"),
                      *[round_half_up(crit(f"{c}%"), 6).alias(f"crit_{c}pct") for c in (1, 5, 10)],
                      (F.col("_stat") < crit("5%")).cast("int").alias("stationary_5pct"))


def durbin_levinson(acf: np.ndarray) -> np.ndarray:
    """PACF from autocorrelations r_0..r_K (r_0 = 1): Yule–Walker via Durbin–Levinson."""
    r = np.asarray(acf, dtype=float)
    K = len(r) - 1
    pacf = np.zeros(K + 1)
    pacf[0] = 1.0
    phi = np.zeros(K + 1)
    for k in range(1, K + 1):
        num = r[k] - np.dot(phi[1:k], r[k - 1:0:-1])
        den = 1.0 - np.dot(phi[1:k], r[1:k])
        a = num / den
        new = phi.copy()
        new[1:k] = phi[1:k] - a * phi[k - 1:0:-1]
        new[k] = a
        phi = new
        pacf[k] = a
    return pacf


def pacf(acf_df: DataFrame, series: str = "series_id") -> DataFrame:
    """Partial autocorrelations from the ACF rows (series, lag, acf): the
    Durbin-Levinson recursion as a fold over each series' array of lags."""
    per = acf_df.groupBy(F.col(series).cast("string").alias("series_id")).agg(
        F.sort_array(F.collect_list(F.struct("lag", "acf"))).alias("_r"))
    r = F.col("_r.acf")
    none = F.array().cast("array<double>")

    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)

    def step(state, k):
        phi, head = state["phi"], F.slice(r, F.lit(1), k - 1)
        a = (F.element_at(r, k) - dot(phi, F.reverse(head))) / (F.lit(1.0) - dot(phi, head))
        # the one-element array holds ``a``, so that it is computed once
        return F.transform(F.array(a), lambda v: F.struct(
            F.concat(F.zip_with(phi, F.reverse(phi), lambda x, y: x - v * y), F.array(v)).alias("phi"),
            F.concat(state["out"], F.array(v)).alias("out")))[0]

    folded = F.aggregate(F.sequence(F.lit(1), F.size("_r")), F.struct(none.alias("phi"), none.alias("out")), step, lambda s: s["out"])
    return (per.select("series_id", F.posexplode(folded).alias("_k", "_p"))
            .select("series_id", (F.col("_k") + 1).cast("int").alias("lag"), round_half_up(F.col("_p"), 6).alias("pacf")))
