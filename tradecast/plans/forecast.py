"""Direct multi-horizon forecasting: leak-free features, splits, baselines,
boosted trees, and the asymmetric-cost evaluation (M1–M13).

Plan shape
----------
* The demand of the dense weekly panel (T3) comes as one row per series with the
  prefix sums over its weeks, so every trailing mean or sum is the difference of
  two entries: rows of origins and horizons are made where the series lies, by
  generated code, without a shuffle, a sort or a window over the panel.
* Features read entries up to T only; the by-date lag-52 is looked up by the
  position of the week 364 days before.
* Horizons are exploded last (×12): no self-joins, no cross joins, and nothing
  after the origin can reach the features.
* Metrics are one ``groupBy`` over the unpivoted predictions.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradecast.functions import dates as D
from tradecast.functions.numeric import int_div, ratio_half_up_units, round_half_up
from tradecast.operators.clean import Cleaned
from tradecast.plans.params import DEFAULT, Params
from tradecast.plans.timeseries import prefix_sums, series_sums, weekly_series


def m1_festival_calendar(c: Cleaned) -> DataFrame:
    years = c.sales.select(F.year("sale_date").alias("year")).distinct()
    y = F.col("year")
    return years.select("year", D.valentines_day(y).alias("valentines_day"),
                        D.mothers_day(y).alias("mothers_day"),
                        D.iso_week(D.valentines_day(y)).alias("valentines_iso_week"),
                        D.iso_week(D.mothers_day(y)).alias("mothers_iso_week"))


@dataclass(frozen=True)
class Weeks:
    """What the positions of a series stand for."""

    n: F.Column                                  # weeks of the series
    date: Callable[[F.Column], F.Column]         # the week of a position
    year_before: Callable[[F.Column], F.Column]  # position of the week 364 days before it; null if not observed
    calendar: Callable[[F.Column], F.Column]     # its calendar features, a struct


def calendar_weeks(c: Cleaned, p: Params = DEFAULT) -> tuple[list, Weeks]:
    """The panel's weeks, the same for all series: their dates and, as a literal,
    their calendar features, which are computed once for each week."""
    table = m3_target_calendar(c, p).where("target_date IS NOT NULL")
    rows = table.orderBy("target_date").collect()  # one for each week of the calendar
    dates = [r["target_date"] for r in rows]
    at = {d: i for i, d in enumerate(dates)}
    said = [{**r.asDict(), "target_date": str(r["target_date"]), "_before": at.get(r["target_date"] - timedelta(days=364))} for r in rows]
    fields = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in table.schema.fields)
    known = F.from_json(F.lit(json.dumps(said)), f"array<struct<{fields},_before:int>>")
    return dates, Weeks(F.lit(len(dates)), lambda i: F.get(known, i)["target_date"], lambda i: F.get(known, i)["_before"],
                        lambda i: F.get(known, i))


def panel_series(panel: DataFrame, p: Params = DEFAULT) -> tuple[DataFrame, Weeks]:
    """Any panel (week_end, series_id, demand) as prefix sums, a row for each
    series, which has weeks of its own."""
    w = Window.partitionBy("series_id").orderBy("week_end")
    rows = panel.withColumn("_at", F.row_number().over(w) - 1)
    weeks = rows.groupBy("series_id").agg(F.sort_array(F.collect_list("week_end")).alias("_weeks"))
    sums = prefix_sums(rows, F.size(F.col("_seen")))
    series = sums.withColumnRenamed("series_id", "_id").join(weeks, F.col("_id").eqNullSafe(F.col("series_id"))).drop("_id")

    def date(i: F.Column) -> F.Column:
        return F.get("_weeks", i)

    def year_before(i: F.Column) -> F.Column:
        return F.nullif(F.array_position("_weeks", F.date_sub(date(i), 364)).cast("int"), F.lit(0)) - 1

    return series, Weeks(F.size("_weeks"), date, year_before, lambda i: F.struct(*target_calendar(date(i), p)))


def origins(series: DataFrame, weeks: Weeks, p: Params = DEFAULT, first: int = 0) -> DataFrame:
    """A row for each origin T of a series, at positions ``idx`` from
    ``first_origin`` (or ``first``) to ``n - horizons - 1``."""
    last = weeks.n - (p.horizons + 1)
    lo = max(p.first_origin, first)
    at = F.when(last >= lo, F.sequence(F.lit(lo), last)).otherwise(F.array().cast("array<int>"))
    return series.select("*", F.explode(at).alias("idx"))


def origin_features(rows: DataFrame, kept: list[str]) -> DataFrame:
    """The columns ``kept`` of rows (``idx`` and the prefix sums of a series),
    with the features of the weeks <= T of the series.

    Lags and trailing frames are positional, as in the notebook: each sum is the
    difference of two prefix sums, so that rows need no sort and no window."""
    idx = F.col("idx")

    def total(back: int, width: int) -> F.Column:
        """Demand of ``width`` weeks at most, the last ``back`` before the origin."""
        return F.get("_sums", idx + (1 - back)) - F.get("_sums", F.greatest(idx + (1 - back - width), F.lit(0)))

    def lag(k: int) -> F.Column:
        return F.get("_sums", idx + (1 - k)) - F.get("_sums", idx - k)

    def seen(width: int) -> F.Column:
        return F.least(F.lit(width), idx + 1)

    rows = rows.select("*", total(0, 8).alias("_recent8"), (F.get("_squares", idx + 1) - F.get("_squares", F.greatest(idx - 7, F.lit(0)))).alias("_q8"))
    recent8, n = F.col("_recent8"), seen(8)
    # whole numbers, exact in doubles
    spread = F.greatest(n * F.col("_q8") - recent8.cast("double") * recent8.cast("double"), F.lit(0.0))
    return rows.select(
        *kept, lag(0).alias("y_T"), *[lag(k).alias(f"y_T_{k}") for k in (1, 2, 3)],
        (total(0, 4) / seen(4)).alias("ma_4"), (total(0, 12) / seen(12)).alias("ma_12"),
        round_half_up(F.when(idx > 0, F.sqrt(spread / (n * (n - 1)))), 6).alias("std_8"), recent8,
        F.when(idx >= 59, total(52, 8)).otherwise(recent8).alias("_ly8"))


def target_calendar(target: F.Column, p: Params = DEFAULT) -> list[F.Column]:
    wk = D.iso_week(target)
    ang = F.lit(2 * math.pi) * wk / F.lit(52.0)
    d1 = D.days_between(target, D.valentines_day(F.year(target))) / F.lit(7.0)
    d2 = D.days_between(target, D.mothers_day(F.year(target))) / F.lit(7.0)
    return [wk.alias("target_iso_week"),
            round_half_up(F.sin(ang), 12).alias("sin_week"),
            round_half_up(F.cos(ang), 12).alias("cos_week"),
            d1.alias("dist_peak1_weeks"), d2.alias("dist_peak2_weeks"),
            F.when(d1.between(p.window_lo, p.window_hi), 1).otherwise(0).alias("window_peak1"),
            F.when(d2.between(p.window_lo, p.window_hi), 1).otherwise(0).alias("window_peak2")]


#: Rows of the supervised set that a task makes at most, about, and where cores are idle.
TASK_ROWS, SMALL_TASK_ROWS = 4_000_000, 250_000


def tasks_for(c: Cleaned, rows: int, small: int, large: int) -> int:
    """Tasks of about ``large`` rows, but of ``small`` ones while cores are idle."""
    cores = c.roles.spark.sparkContext.defaultParallelism
    return max(1, min(math.ceil(rows / small), cores), math.ceil(rows / large))


def m2_direct_features(c: Cleaned, p: Params = DEFAULT, materialize: bool | None = None) -> DataFrame:
    """The supervised set of the series ``p.series_col``.  For series that are an
    attribute of products it is materialised once per session (baselines,
    splits, metrics and the boosted trees all read it); per product it is a
    hundred times the size of its sources and streams straight to its consumer."""
    build = lambda: supervised(c, p)
    if not (p.series_col != "product_id" if materialize is None else materialize):
        rows = sum(n for _, _, n in target_weeks(c, p))
        return supervised(c, p, tasks=tasks_for(c, rows, SMALL_TASK_ROWS, TASK_ROWS))
    tag = hashlib.sha1(repr(p).encode()).hexdigest()[:12]
    return c.cached(f"direct_features_{tag}", build)


def supervised(c: Cleaned, p: Params, level: bool = False, first_target: str = "", shares: list[float] | None = None, tasks: int = 0) -> DataFrame:
    """The supervised set from the panel's series.  ``level`` adds
    ``series_level``, the mean target of a series' training rows (0 without
    any); ``first_target`` leaves out origins all of whose targets are earlier.
    ``shares``, by target week, makes only rows whose ``row_hash`` is below; the
    others get no features.  ``tasks`` deals the series to so many tasks, which
    make their rows: those are a hundred times larger, and a split of the files
    of the series, which are small, would hold hundreds of millions."""
    dates, weeks = calendar_weeks(c, p)
    series = series_sums(c, p.series_col)
    if tasks:
        series = series.repartition(tasks, "series_id")
    if level:
        origins = range(p.first_origin, len(dates) - p.horizons)
        # how often a week is the target of a training row
        often = [sum(i - h in origins for h in range(1, p.horizons + 1)) * (str(d) <= p.train_end) for i, d in enumerate(dates)]
        times = F.from_json(F.lit(json.dumps(often)), "array<bigint>")
        total = F.aggregate(F.sequence(F.lit(0), F.lit(len(dates) - 1)), F.lit(0).cast("long"), lambda a, i: a + F.get(times, i) * (
            F.get("_sums", i + 1) - F.get("_sums", i))) if sum(often) else F.lit(0)
        series = series.withColumn("series_level", total / F.lit(float(max(1, sum(often)))))
    first = sum(str(d) < first_target for d in dates) - p.horizons
    return _with_horizons(series, weeks, p, first, ["series_level"] if level else [], shares)


def target_weeks(c: Cleaned, p: Params) -> list[tuple]:
    """(week, its split, rows of the supervised set with that target).  The panel is
    dense: every series has each pair of origin and target, so no row need be
    made to count them."""
    dates, _ = calendar_weeks(c, p)
    n = series_sums(c, p.series_col).count()
    said = c.roles.spark.createDataFrame([(d,) for d in dates], "d date").select("d", split_label(F.col("d"), p)).collect()
    split = {r[0]: r[1] for r in said}
    starts = range(p.first_origin, len(dates) - p.horizons)
    return [(d, split[d], n * sum(i - h in starts for h in range(1, p.horizons + 1))) for i, d in enumerate(dates)]


def row_hash() -> F.Column:
    """0 to 1, by the key of a row of the supervised set."""
    return F.xxhash64("series_id", "origin_date", "horizon") / F.lit(2.0 ** 64) + F.lit(0.5)


def m2_feature_sums(c: Cleaned, p: Params = DEFAULT) -> DataFrame:
    """Counts and exact sums over ALL rows of the supervised set, by split and
    horizon: what checks a set of millions of rows without listing them."""
    f = m2_direct_features(c, p)
    whole = ["y_target", "y_T", "y_T_1", "y_T_2", "y_T_3", "target_iso_week", "window_peak1", "window_peak2"]
    parts = ["y_lag_52", "ma_4", "ma_12", "std_8", "growth", "dist_peak1_weeks", "dist_peak2_weeks"]
    sums = {f"sum_{x}": F.sum(x).cast("long") for x in whole}
    sums |= {f"milli_{x}": F.sum(F.floor(F.col(x) * 1000 + 0.5).cast("long")) for x in parts}
    # by origin first, a few thousand rows.  The panel is dense: every series has each
    # origin once, so that the rows of an origin are the series
    by_origin = f.groupBy("origin_date", "target_date", "horizon").agg(F.count("*").alias("n"), *[x.alias(k) for k, x in sums.items()])
    return by_origin.groupBy(split_label(F.col("target_date"), p).alias("split"), "horizon").agg(
        F.sum("n").alias("n_rows"), F.max("n").alias("n_series"), *[F.sum(k).alias(k) for k in sums])


def direct_features(dense_panel: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """(series, origin T, horizon h) rows from a dense panel (week_end, series_id, demand)."""
    return _with_horizons(*panel_series(dense_panel, p), p)


def _with_horizons(series: DataFrame, weeks: Weeks, p: Params, first: int = 0, more: list[str] = [], shares: list[float] | None = None) -> DataFrame:
    """Origins ``first_origin … n_weeks − horizons − 1`` by horizon; the horizons
    are exploded last, after every feature is fixed at T.  With ``shares`` the
    features of the rows picked are made one by one."""
    growth = (F.col("_recent8") + F.lit(1.0)) / (F.col("_ly8") + F.lit(1.0))
    origin = ["origin_date", "y_T", "y_T_1", "y_T_2", "y_T_3", "ma_4", "ma_12", "std_8", "growth", *more]
    if shares is None:
        rows = origin_features(origins(series, weeks, p, first), [*series.columns, "idx"])
        rows = rows.withColumns({"origin_date": weeks.date(F.col("idx")), "growth": growth})
        # the features as what is repeated: generated code makes them once, not for each horizon
        rows = rows.select(*[x for x in series.columns if x not in more], "idx", F.posexplode(F.array_repeat(F.struct(*origin), p.horizons)).alias("_h", "_o"))
        rows = rows.withColumn("horizon", F.col("_h") + 1)
    else:
        # keys first, by little code that reads no sums; the rows picked are few and meet their series again
        share, ids = F.from_json(F.lit(json.dumps(shares)), "array<double>"), series.select("series_id")
        keys = origins(ids, weeks, p, first).select("*", F.explode(F.sequence(F.lit(1), F.lit(p.horizons))).alias("horizon"))
        keys = keys.withColumn("origin_date", weeks.date(F.col("idx"))).where(row_hash() < F.get(share, F.col("idx") + F.col("horizon")))
        keys = F.broadcast(keys.withColumnRenamed("series_id", "_id"))
        rows = series.join(keys, F.col("series_id").eqNullSafe(F.col("_id"))).drop("_id")
        rows = origin_features(rows, [*series.columns, "idx", "horizon", "origin_date"]).withColumn("growth", growth)
        rows = rows.select(*[x for x in series.columns if x not in more], "idx", "horizon", F.struct(*origin).alias("_o"))
    at = F.col("idx") + F.col("horizon")

    def demand(i: F.Column) -> F.Column:
        return F.get("_sums", i + 1) - F.get("_sums", i)

    calendar = ["target_iso_week", "sin_week", "cos_week", "dist_peak1_weeks", "dist_peak2_weeks", "window_peak1", "window_peak2"]
    return rows.select(
        "series_id", "_o.origin_date", "horizon", weeks.date(at).alias("target_date"),
        demand(at).alias("y_target"),
        F.coalesce(demand(weeks.year_before(at)).cast("double"), F.col("_o.ma_12")).alias("y_lag_52"),
        *[f"_o.{x}" for x in origin[1:9]],
        *[weeks.calendar(at)[x].alias(x) for x in calendar], *[f"_o.{x}" for x in more])


def m3_target_calendar(c: Cleaned, p: Params = DEFAULT) -> DataFrame:
    """Calendar features of every observed week (the weeks of the panel)."""
    weeks = weekly_series(c, p.series_col).select("week_end").distinct()
    return weeks.select(F.col("week_end").alias("target_date"), *target_calendar(F.col("week_end"), p))


def split_label(target: F.Column, p: Params = DEFAULT) -> F.Column:
    lit = lambda s: F.lit(s).cast("date")
    return (F.when(target <= lit(p.train_end), F.lit("train"))
            .when(target.between(lit(p.val_start), lit(p.val_end)), F.lit("val"))
            .when(target.between(lit(p.mid_start), lit(p.mid_end)), F.lit("mid"))
            .when(target >= lit(p.test_start), F.lit("test")))


def m4_time_split(c: Cleaned, p: Params = DEFAULT) -> DataFrame:
    split = split_label(F.col("target_date"), p)
    known = F.coalesce(F.col("target_date") <= F.lit(p.mid_end).cast("date"), F.lit(False))
    counts = m2_direct_features(c, p).groupBy(split.alias("split"), known.alias("known")).agg(F.count("*").alias("n"))
    # a few rows from here on: those before the test period count once more
    labels = F.when(F.col("known"), F.array("split", F.lit("retrain"))).otherwise(F.array("split"))
    return counts.select(F.explode(labels).alias("split"), "n").groupBy("split").agg(F.sum("n").alias("n_rows"))


def _test_rows(c: Cleaned, p: Params) -> DataFrame:
    """Rows of the test period.  Where the whole set is not written, only the
    origins that have a target there are made."""
    test_start = F.lit(p.test_start).cast("date")
    if p.series_col != "product_id":
        return m2_direct_features(c, p).where(F.col("target_date") >= test_start)
    return supervised(c, p, first_target=p.test_start).where(F.col("target_date") >= test_start)


def m5_seasonal_naive(c: Cleaned, p: Params = DEFAULT) -> DataFrame:
    t = _test_rows(c, p)
    return t.select("series_id", "origin_date", "horizon", "target_date", "y_target", "window_peak1",
                    F.greatest(F.col("y_lag_52"), F.lit(0.0)).alias("pred"))


def m6_naive_growth(c: Cleaned, p: Params = DEFAULT) -> DataFrame:
    t = _test_rows(c, p)
    return t.select("series_id", "origin_date", "horizon", "target_date", "y_target", "window_peak1",
                    F.greatest(F.col("y_lag_52") * F.col("growth"), F.lit(0.0)).alias("pred"))


# Model labels in the evaluation tables.
MODEL_NAIVE = "M0 seasonal naive (t-52)"
MODEL_GROWTH = "M0b naive x growth"
MODEL_GBT = "M3 boosted trees mean"
MODEL_QUANTILE = "M3 boosted trees q0.68"


def baseline_predictions(c: Cleaned, p: Params = DEFAULT) -> DataFrame:
    """Test rows in long form (model, y, pred) for both baselines, clipped at 0."""
    t = _test_rows(c, p)
    return t.select("series_id", "origin_date", "horizon", "target_date", "y_target", "window_peak1",
                    F.expr(f"stack(2, '{MODEL_NAIVE}', greatest(y_lag_52, 0D), "
                           f"'{MODEL_GROWTH}', greatest(y_lag_52 * growth, 0D)) AS (model, pred)"))


HALF = 1 << 32


def _millionths(x: F.Column) -> F.Column:
    """``x`` in millionths, half away from zero: a whole number as a double."""
    size = F.abs(x) * 1e6
    # from 2^52 on a double is whole, and may be beyond the long that floor gives
    return F.signum(x) * F.when(size < 2.0 ** 52, F.floor(size + 0.5).cast("double")).otherwise(size)


def metrics(pred_long: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """WAPE %, MAE, RMSE, bias %, asymmetric cost per model (rounded 2/1/1/2/2)."""
    y, yh = F.col("y_target").cast("double"), F.col("pred")
    cu = F.when(F.col("window_peak1") == 1, F.lit(p.cost_under_peak)).otherwise(F.lit(p.cost_under_normal))
    cost = F.greatest(y - yh, F.lit(0.0)) * cu + F.greatest(yh - y, F.lit(0.0)) * F.lit(p.cost_over)

    # Exact sums of millionths, the same in any order of the rows: whole numbers in
    # two halves, as a decimal for each row would cost more than all else.
    of = {"_abs": F.abs(y - yh), "_y": y, "_yh": yh, "_sq": (y - yh) * (y - yh), "_cost": cost}
    high = {k: F.floor(_millionths(x) / HALF) for k, x in of.items()}
    halves = [F.sum(h).alias(f"{k}_high") for k, h in high.items()] + [
        F.sum((_millionths(x) - high[k].cast("double") * HALF).cast("long")).alias(f"{k}_low") for k, x in of.items()]
    a = pred_long.groupBy("model").agg(F.count("*").alias("_n"), *halves).select("model", "_n", *[
        ((F.col(f"{k}_high").cast("decimal(20,0)") * F.lit(HALF).cast("decimal(10,0)") + F.col(f"{k}_low").cast("decimal(20,0)"))
         / F.lit(1_000_000).cast("decimal(7,0)")).cast("double").alias(k) for k in of])
    return a.select(
        "model",
        round_half_up(F.col("_abs") / F.col("_y") * F.lit(100.0), 2).alias("wape_pct"),
        round_half_up(F.col("_abs") / F.col("_n"), 1).alias("mae"),
        round_half_up(F.sqrt(F.col("_sq") / F.col("_n")), 1).alias("rmse"),
        round_half_up((F.col("_yh") - F.col("_y")) / F.col("_y") * F.lit(100.0), 2).alias("bias_pct"),
        round_half_up(F.col("_cost"), 2).alias("cost")).orderBy("cost")


def m9_metrics_global(c: Cleaned, p: Params = DEFAULT) -> DataFrame:
    return metrics(baseline_predictions(c, p), p)


def with_savings(m: DataFrame, reference_model: str = MODEL_NAIVE) -> DataFrame:
    """Saving of each model against the reference model's cost (a window over
    the few model rows, no join)."""
    base = F.max(F.when(F.col("model") == reference_model, F.col("cost"))).over(Window.partitionBy())
    return m.select(*m.columns, base.alias("_base_cost")).select(
        *m.columns,
        round_half_up(F.col("_base_cost") - F.col("cost"), 2).alias("saving_vs_naive"),
        round_half_up((F.col("_base_cost") - F.col("cost")) / F.col("_base_cost") * F.lit(100.0), 1)
        .alias("saving_pct"))


def m10_metrics_h12(c: Cleaned, p: Params = DEFAULT) -> DataFrame:
    pl = baseline_predictions(c, p).where(F.col("horizon") == p.horizons)
    return with_savings(metrics(pl, p))


def h12_curve(pred_long: DataFrame, p: Params = DEFAULT,
              models: tuple = (MODEL_NAIVE, MODEL_GROWTH)) -> DataFrame:
    """Per target week (test, h = 12): actual and each model's summed prediction
    in one aggregation."""
    h = pred_long.where(F.col("horizon") == p.horizons)

    def of(model: str, x: str) -> F.Column:
        return F.sum(F.when(F.col("model") == model, F.col(x)))

    return h.groupBy("target_date").agg(of(MODEL_NAIVE, "y_target").alias("actual"), F.max("window_peak1").alias("window_peak1"),
                                        *[of(m, "pred").alias(m) for m in models])


def m11_h12_curve(c: Cleaned, p: Params = DEFAULT) -> DataFrame:
    cur = h12_curve(baseline_predictions(c, p), p)
    return cur.select("target_date", "actual",
                      round_half_up(F.col(f"`{MODEL_NAIVE}`"), 6).alias("pred_naive"),
                      round_half_up(F.col(f"`{MODEL_GROWTH}`"), 6).alias("pred_growth"))


def capacity(c: Cleaned, p: Params = DEFAULT) -> DataFrame:
    """One row: base = round(Σarea·yield·days·cut), max = round(base·peak·post-harvest)."""
    area_centi = c.site.agg(F.sum(F.col("area") * 100).cast("long").alias("a"))
    base_num = F.col("a") * F.lit(p.daily_yield_per_area * p.days_per_week * int(round(p.cut_factor * 100)))
    base = ratio_half_up_units(base_num, F.lit(10_000), 0)
    peak = int(round(p.peak_multiplier * p.post_harvest_factor * 100))
    return area_centi.select((F.col("a") / F.lit(100.0)).alias("total_area"), base.alias("capacity_base")) \
        .select("total_area", "capacity_base",
                int_div(F.col("capacity_base") * F.lit(2 * peak) + F.lit(100), F.lit(200)).alias("capacity_max"))


def m12_capacity(c: Cleaned, p: Params = DEFAULT) -> DataFrame:
    cur = m11_h12_curve(c, p)
    cap = capacity(c, p)
    k = cap.select(F.struct("capacity_base", "capacity_max", "total_area")).scalar()
    base, top, area = (k.getField(x) for x in ("capacity_base", "capacity_max", "total_area"))
    return cur.select("target_date", "actual", "pred_naive", area.alias("total_area"),
                      base.alias("capacity_base"), top.alias("capacity_max"),
                      (F.col("pred_naive") > base).cast("int").alias("over_base"),
                      (F.col("pred_naive") > top).cast("int").alias("over_max"))


def m13_newsvendor(c: Cleaned, p: Params = DEFAULT) -> DataFrame:
    """Critical fractile α* = Cu / (Cu + Co) for each test target week (h = 12)."""
    cur = _test_rows(c, p).where(F.col("horizon") == p.horizons).groupBy("target_date").agg(F.max("window_peak1").alias("window_peak1"))
    cu = F.when(F.col("window_peak1") == 1, F.lit(p.cost_under_peak)).otherwise(F.lit(p.cost_under_normal))
    return cur.select("target_date", "window_peak1", cu.alias("cost_under"), F.lit(p.cost_over).alias("cost_over"),
                      (cu / (cu + F.lit(p.cost_over))).alias("alpha"))
