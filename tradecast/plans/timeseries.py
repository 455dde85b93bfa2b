"""Dense daily/weekly series and exploratory statistics.

Everything starts from the day × product feature mart (G5) and is aggregated
before any window runs, so windows see one row per week per series: their
partitions are bounded by the length of the calendar, not by data volume.
Global (all-products) series use an unpartitioned window over those few
hundred weekly rows.  Floating results that depend on summation order are
rounded (``round_half_up``) so any engine reproduces them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradecast.functions import dates as D
from tradecast.functions.numeric import round_half_up
from tradecast.operators import series as S
from tradecast.operators.clean import Cleaned
from tradecast.plans.marts import g5_exact
from tradecast.plans.params import DEFAULT, Params

MAX_ACF_LAG = 55
PERIOD = 52


def _mean_price(milli_sum: str, n: str) -> F.Column:
    return (F.col(milli_sum) / F.lit(1000.0)) / F.col(n)


def t1_daily_global(c: Cleaned) -> DataFrame:
    g = (g5_exact(c).groupBy(F.col("sale_date").alias("date"))
         .agg(F.sum("demand").alias("demand"), F.sum("_rev").alias("_rev"),
              F.sum("_price_milli").alias("_pm"), F.count("_price_milli").alias("_pn"),
              F.max("flag_peak1").alias("flag_peak1"), F.max("flag_peak2").alias("flag_peak2")))
    return g.select("date", "demand", F.col("_rev").cast("double").alias("revenue"),
                    _mean_price("_pm", "_pn").alias("mean_price"), "flag_peak1", "flag_peak2")


def t1_daily_dense(c: Cleaned) -> DataFrame:
    """Every calendar day between the first and last sale; all columns 0-filled."""
    daily = t1_daily_global(c)
    b = daily.select(F.struct(F.min("date").alias("lo"), F.max("date").alias("hi"))).scalar()
    lo, hi = b.getField("lo"), b.getField("hi")
    days = daily.sparkSession.range(1).select(F.explode(F.sequence(lo, hi)).alias("date"))
    j = days.join(daily, "date", "left")
    return j.select("date",
                    F.coalesce("demand", F.lit(0).cast("long")).alias("demand"),
                    F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
                    F.coalesce("mean_price", F.lit(0.0)).alias("mean_price"),
                    F.coalesce("flag_peak1", F.lit(0)).alias("flag_peak1"),
                    F.coalesce("flag_peak2", F.lit(0)).alias("flag_peak2"))


def t2_weekly_global(c: Cleaned) -> DataFrame:
    """Sunday-ending weeks of the dense daily series; the price is the mean of
    the daily prices, zero days included.  Materialised once per session: the
    exploratory statistics (E1–E4) all start from it."""
    return c.cached("weekly_global", lambda: _t2_weekly_global(c))


def _t2_weekly_global(c: Cleaned) -> DataFrame:
    d = t1_daily_dense(c)
    return (d.groupBy(D.week_end_sunday("date").alias("week_end"))
            .agg(F.sum("demand").alias("demand"),
                 F.sum(F.col("revenue").cast("decimal(18,2)")).cast("double").alias("revenue"),
                 round_half_up(F.avg("mean_price"), 9).alias("mean_price")))


def t2_weekly_product(c: Cleaned) -> DataFrame:
    g = (g5_exact(c).groupBy(D.week_end_sunday("sale_date").alias("week_end"), "product_id",
                             "product_name", "product_kind")
         .agg(F.sum("demand").alias("demand"), F.sum("_rev").alias("_rev"),
              F.sum("_price_milli").alias("_pm"), F.count("_price_milli").alias("_pn")))
    return g.select("week_end", "product_id", "product_name", "product_kind", "demand",
                    F.col("_rev").cast("double").alias("revenue"), _mean_price("_pm", "_pn").alias("mean_price"))


def weekly_series(c: Cleaned, series_col: str = "product_color") -> DataFrame:
    """Weekly demand per forecasting series (a product attribute, or the
    product); written once per session and series column."""
    return c.cached(f"weekly_{series_col}", lambda: _weekly_series(c, series_col))


def _weekly_series(c: Cleaned, series_col: str) -> DataFrame:
    g = (g5_exact(c).groupBy(D.week_end_sunday("sale_date").alias("week_end"),
                             F.col(series_col).cast("string").alias("series_id"))
         .agg(F.sum("demand").alias("demand"), F.sum("_rev").alias("_rev"),
              F.sum("_price_milli").alias("_pm"), F.count("_price_milli").alias("_pn")))
    return g.select("week_end", "series_id", "demand", F.col("_rev").cast("double").alias("revenue"),
                    _mean_price("_pm", "_pn").alias("mean_price"))


def t3_dense_panel(c: Cleaned, series_col: str = "product_color") -> DataFrame:
    """Observed weeks × series: demand 0-filled, revenue and price left NULL.

    No join with the facts and no cross join: the weekly rows of each series are
    gathered into an array in week order (bounded by the number of calendar
    weeks, not by data volume), the gaps between neighbours are filled, and the
    array is exploded with its positions, so the work is linear in the weeks.
    Weeks that no series has fall to a semi-join on a calendar-bounded table.
    The ``groupBy`` leaves the panel hash-partitioned by series, which is what
    the series windows downstream need, so they add no shuffle.
    """
    wk = weekly_series(c, series_col)
    b = wk.select(F.struct(F.min("week_end").alias("lo"), F.max("week_end").alias("hi"))).scalar()
    lo, hi = b.getField("lo"), b.getField("hi")
    observed = wk.select("week_end").distinct()
    slot = F.floor(F.datediff("week_end", lo) / 7).cast("int")
    n = F.floor(F.datediff(hi, lo) / 7).cast("int") + 1
    values = F.struct("demand", "revenue", "mean_price")
    per_series = (wk.select("series_id", F.struct(slot.alias("at"), values.alias("v")).alias("e"))
                  .groupBy("series_id").agg(F.sort_array(F.collect_list("e")).alias("_seen"))
                  .withColumn("_n", n))
    blank = F.struct(F.lit(0).cast("long").alias("demand"), F.lit(None).cast("double").alias("revenue"),
                     F.lit(None).cast("double").alias("mean_price"))
    after = F.transform("_seen", lambda e, i: F.concat(F.array(e["v"]), F.array_repeat(
        blank, F.coalesce(F.get(F.col("_seen"), i + 1)["at"], F.col("_n")) - e["at"] - 1)))
    filled = F.concat(F.array_repeat(blank, F.col("_seen")[0]["at"]), F.flatten(after))
    grid = per_series.select("series_id", F.posexplode(filled).alias("_at", "_v"))
    grid = grid.select(F.date_add(lo, F.col("_at") * 7).alias("week_end"), "series_id", "_v.*")
    return grid.join(F.broadcast(observed), "week_end", "left_semi")


#: Weekly rows that a task brings together into series, about.
SERIES_ROWS = 200_000


def prefix_sums(rows: DataFrame, n: F.Column) -> DataFrame:
    """(series_id, ``_sums``, ``_squares``) of rows (series_id, ``_at``, demand):
    entry i is the sum of the demand, or of its square, of the first i of ``n``
    weeks, those without a row being 0.  The sum of any run of weeks is the
    difference of two entries."""
    w = Window.partitionBy("series_id").orderBy("_at")
    y = F.coalesce(F.col("demand"), F.lit(0))
    upto = rows.select("series_id", "_at", F.struct(F.sum(y).over(w).alias("s"), F.sum(y.cast("double") * y.cast("double")).over(w).alias("q")).alias("_upto"))
    seen = upto.groupBy("series_id").agg(F.sort_array(F.collect_list(F.struct("_at", "_upto"))).alias("_seen"))
    fields = {f.name: f.dataType for f in upto.schema["_upto"].dataType.fields}

    def entries(x: str) -> F.Column:
        none = F.array_repeat(F.lit(0).cast(fields[x]), F.col("_seen")[0]["_at"] + 1)
        return F.concat(none, F.flatten(F.transform("_seen", lambda e, i: F.array_repeat(
            e["_upto"][x], F.coalesce(F.get(F.col("_seen"), i + 1)["_at"], n) - e["_at"]))))

    return seen.select("series_id", entries("s").alias("_sums"), entries("q").alias("_squares"))


def observed_weeks(c: Cleaned, series_col: str) -> list:
    """The weeks of the panel, ascending: one for each week of the calendar."""
    return [r[0] for r in weekly_series(c, series_col).select("week_end").where("week_end IS NOT NULL").distinct().orderBy("week_end").collect()]


def series_sums(c: Cleaned, series_col: str) -> DataFrame:
    """The demand of the dense panel (T3), a row for each series, as prefix sums
    over its weeks.  Written once per session, in files of bounded size."""
    return c.cached(f"series_{series_col}", lambda: _series_sums(c, series_col))


def _series_sums(c: Cleaned, series_col: str) -> DataFrame:
    wk, weeks = weekly_series(c, series_col), observed_weeks(c, series_col)
    spark = wk.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-wk.count() // SERIES_ROWS))
    at = spark.createDataFrame(list(zip(weeks, range(len(weeks)), strict=True)), "week_end date, _at int")
    rows = wk.join(F.broadcast(at), "week_end").select("series_id", "_at", "demand").repartition(tasks, "series_id")
    return prefix_sums(rows, F.lit(len(weeks)))


def e1_rolling8(c: Cleaned) -> DataFrame:
    w = Window.orderBy("week_end").rowsBetween(-7, 0)
    wk = t2_weekly_global(c)
    return wk.select("week_end", "demand",
                     F.when(F.count("demand").over(w) == 8, F.avg("demand").over(w)).alias("rolling_mean_8"))


def e3_decompose(c: Cleaned) -> DataFrame:
    """Additive decomposition, period 52: centred 2×52 moving average, phase
    means of the detrended series re-centred to sum zero, residual."""
    wk = t2_weekly_global(c).select("week_end", F.col("demand").cast("double").alias("y"))
    o = Window.orderBy("week_end")
    half = PERIOD // 2
    core = Window.orderBy("week_end").rowsBetween(-(half - 1), half - 1)
    x = wk.select(
        "week_end", "y", (F.row_number().over(o) - 1).alias("idx"),
        F.lag("y", half).over(o).alias("_l"), F.lead("y", half).over(o).alias("_r"),
        F.sum("y").over(core).alias("_core"))
    trend = F.when(F.col("_l").isNotNull() & F.col("_r").isNotNull(),
                   (F.col("_core") + F.lit(0.5) * (F.col("_l") + F.col("_r"))) / F.lit(float(PERIOD)))
    x = x.select("week_end", "y", (F.col("idx") % PERIOD).alias("phase"), trend.alias("trend"))
    phases = (x.groupBy("phase").agg(F.avg(F.col("y") - F.col("trend")).alias("_pm")))
    phases = phases.select("phase", (F.col("_pm") - F.avg("_pm").over(Window.partitionBy())).alias("seasonal"))
    j = x.join(F.broadcast(phases), "phase")  # at most 52 rows
    return j.select("week_end", F.col("y").alias("observed"),
                    round_half_up(F.col("trend"), 6).alias("trend"),
                    round_half_up(F.col("seasonal"), 6).alias("seasonal"),
                    round_half_up(F.col("y") - F.col("trend") - F.col("seasonal"), 6).alias("resid"))


def acf(weekly: DataFrame, series: str = "series_id", value: str = "demand", order: str = "week_end",
        nlags: int = MAX_ACF_LAG) -> DataFrame:
    """Autocorrelations 1..nlags (biased, denominator n) per series: one window
    stage computing all lags, one aggregation, then ``stack`` to long form.
    The per-series means (one row per series) are joined back by key."""
    means = weekly.groupBy(series).agg(F.avg(value).alias("_mean"))
    w = Window.partitionBy(series).orderBy(order)
    d = F.col(value) - F.col("_mean")
    x = weekly.join(means, series).select(
        series, d.alias("_d"), *[(d * F.lag(d, k).over(w)).alias(f"_p{k}") for k in range(1, nlags + 1)])
    agg = x.groupBy(series).agg(F.sum(F.col("_d") * F.col("_d")).alias("_den"),
                                *[F.sum(f"_p{k}").alias(f"_s{k}") for k in range(1, nlags + 1)])
    pairs = ", ".join(f"{k}, _s{k}" for k in range(1, nlags + 1))
    long = agg.selectExpr(series, "_den", f"stack({nlags}, {pairs}) AS (lag, _num)")
    return long.select(series, F.col("lag").cast("int"),
                       round_half_up(F.coalesce(F.col("_num"), F.lit(0.0)) / F.col("_den"), 9).alias("acf"))


def e4_acf(c: Cleaned) -> DataFrame:
    return acf(t2_weekly_global(c).withColumn("series_id", F.lit("all")))


def e4_pacf(c: Cleaned) -> DataFrame:
    return S.pacf(e4_acf(c))


def e2_adf(c: Cleaned, series_col: str | None = None) -> DataFrame:
    if series_col is None:
        wk = t2_weekly_global(c).withColumn("series_id", F.lit("all"))
    else:
        wk = t3_dense_panel(c, series_col)
    return S.adf(wk, "series_id", "week_end", "demand")


def e5_product_share_top(c: Cleaned, p: Params = DEFAULT) -> DataFrame:
    g = (g5_exact(c).groupBy("product_name", "product_kind")
         .agg(F.sum("demand").alias("total_units"), F.sum("_rev").alias("_rev"),
              F.sum("_price_milli").alias("_pm"), F.count("_price_milli").alias("_pn"),
              F.coalesce(F.sum(F.when(F.col("flag_peak1") == 1, F.col("demand"))), F.lit(0).cast("long"))
              .alias("peak_units")))
    return (g.select("product_name", "product_kind", "total_units",
                     F.col("_rev").cast("double").alias("total_revenue"),
                     _mean_price("_pm", "_pn").alias("mean_price"), "peak_units",
                     (F.col("peak_units") * 100 / F.col("total_units")).alias("peak_pct"))
            .orderBy(F.desc("total_units"), "product_name", "product_kind").limit(p.top_products))
