"""Semantic-layer measures (B1–B10) re-aimed as DataFrame operators.

The calendar is derived from the sales it serves (first day of the first sale
month … last day of the last sale month), so it is bounded by the date range,
not by the data volume: exploding it in one task and broadcasting it are safe.
Measures run on the monthly mart (G1), whose values stay exact decimals until
the final cast.

Time intelligence follows the BI engine's date-set semantics: a context's dates
are shifted (``add_months``), intersected with the calendar, and the mart rows
on the surviving dates are summed.  A context with no surviving rows is blank
(NULL), and a partial first year compares like with like only at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradecast.functions import dates as D
from tradecast.operators.clean import Cleaned
from tradecast.plans.marts import g1_exact, g4_weekly_season


def calendar_bounds(c: Cleaned) -> DataFrame:
    """One row: (start, end) of the calendar, from the months of the mart."""
    return g1_exact(c).agg(F.min("month").alias("start"), F.last_day(F.max("month")).alias("end"))


def _days(bounds: DataFrame) -> DataFrame:
    return bounds.select(F.explode(F.sequence("start", "end")).alias("date"))


def b1_calendar(c: Cleaned) -> DataFrame:
    d = F.col("date")
    wn = D.weeknum_monday(d)
    return _days(calendar_bounds(c)).select(
        "date", F.year(d).alias("year"), F.month(d).alias("month_no"),
        D.month_name_es(d).alias("month_name"), D.month_short_es(d).alias("month_short"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
        wn.alias("week_no"), D.day_name_es(d).alias("day_name"),
        D.year_month(d).alias("year_month"),
        D.year_week_key(F.year(d), wn).alias("year_week"))


def b2_year_week_bridge(c: Cleaned) -> DataFrame:
    """Weekly mart rows with their ``year-week`` key, and how many calendar days
    carry that key under the WEEKNUM(…, 2) calendar (the model's bridge) and
    under an ISO-week calendar.  A 0 marks a row the WEEKNUM bridge cannot reach."""
    cal = _days(calendar_bounds(c))
    d = F.col("date")
    by_weeknum = cal.groupBy(D.year_week_key(F.year(d), D.weeknum_monday(d)).alias("year_week")) \
        .agg(F.count("*").alias("days_weeknum_key"))
    by_iso = cal.groupBy(D.year_week_key(F.year(d), D.iso_week(d)).alias("year_week")) \
        .agg(F.count("*").alias("days_iso_key"))
    wk = g4_weekly_season(c).withColumn("year_week", D.year_week_key(F.col("year"), F.col("iso_week")))
    return (wk.join(F.broadcast(by_weeknum), "year_week", "left")
            .join(F.broadcast(by_iso), "year_week", "left")
            .select("year", "iso_week", "season", "year_week", "total_units",
                    F.coalesce("days_weeknum_key", F.lit(0).cast("long")).alias("days_weeknum_key"),
                    F.coalesce("days_iso_key", F.lit(0).cast("long")).alias("days_iso_key")))


def _by_year(c: Cleaned) -> DataFrame:
    return g1_exact(c).groupBy("year").agg(F.sum("_value").alias("_sales"), F.sum("total_units").alias("total_units"))


def b3_total_sales(c: Cleaned) -> DataFrame:
    return _by_year(c).select("year", F.col("_sales").cast("double").alias("total_sales"))


def b4_total_units(c: Cleaned) -> DataFrame:
    return _by_year(c).select("year", "total_units")


def b5_weighted_price(c: Cleaned) -> DataFrame:
    """Σ value / Σ units from the totals of the context (never a mean of ratios)."""
    return _by_year(c).select(
        "year", F.try_divide(F.col("_sales").cast("double"), F.col("total_units").cast("double"))
        .alias("weighted_price"))


def _shifted_sales(c: Cleaned, months: int, context) -> DataFrame:
    """Σ mart value on the context's calendar dates shifted by ``months``,
    intersected with the calendar, grouped by ``context(date)``."""
    cal = _days(calendar_bounds(c))
    shifted = cal.select(context(F.col("date")).alias("ctx"),
                         F.add_months("date", months).alias("shifted"))
    in_cal = shifted.join(cal.select(F.col("date").alias("shifted")), "shifted", "left_semi")
    mart = g1_exact(c).groupBy(F.col("month").alias("shifted")).agg(F.sum("_value").alias("_v"))
    return in_cal.join(mart, "shifted").groupBy("ctx").agg(F.sum("_v").alias("_prev"))


def _with_prior(c: Cleaned, months: int, context, ctx_name: str) -> DataFrame:
    cur = g1_exact(c).groupBy(context(F.col("month")).alias("ctx")).agg(F.sum("_value").alias("_cur"))
    prev = _shifted_sales(c, months, context)
    return cur.join(prev, "ctx", "left").withColumnRenamed("ctx", ctx_name)


def b6_prior_year(c: Cleaned) -> DataFrame:
    x = _with_prior(c, -12, F.year, "year")
    return x.select("year", F.col("_cur").cast("double").alias("total_sales"),
                    F.col("_prev").cast("double").alias("prior_year_sales"))


def b7_yoy_growth(c: Cleaned) -> DataFrame:
    x = _with_prior(c, -12, F.year, "year")
    return x.select("year", F.col("_cur").cast("double").alias("total_sales"),
                    F.col("_prev").cast("double").alias("prior_year_sales"),
                    F.try_divide((F.col("_cur") - F.col("_prev")).cast("double"),
                                 F.col("_prev").cast("double")).alias("yoy_growth"))


def b8_mom_growth(c: Cleaned) -> DataFrame:
    x = _with_prior(c, -1, D.month_start, "month")
    return x.select("month", F.col("_cur").cast("double").alias("total_sales"),
                    F.col("_prev").cast("double").alias("prior_month_sales"),
                    F.try_divide((F.col("_cur") - F.col("_prev")).cast("double"),
                                 F.col("_prev").cast("double")).alias("mom_growth"))


def measures(c: Cleaned, by: list[str], dates: str | None = None, where: dict[str, list] | None = None) -> DataFrame:
    """Every measure (B3-B8) for each combination of the mart columns ``by`` and
    of ``dates`` ("year", "month" or none), under the filters ``where``: lists
    of values of mart columns.  Filters on "year" and "month" choose contexts;
    prior periods are shifted out of them, as in the model, and not filtered."""
    where = dict(where or {})
    chosen = {k: where.pop(k) for k in ("year", "month") if k in where}
    context = {"year": F.year, "month": D.month_start, None: lambda d: F.lit(0)}[dates]
    mart = g1_exact(c)
    for column, values in where.items():
        mart = mart.where(F.col(column).isin(values))

    def kept(df: DataFrame, date) -> DataFrame:
        for k, values in chosen.items():
            df = df.where((F.year(date) if k == "year" else D.month_start(date)).isin(values))
        return df

    value = mart.groupBy(*by, "month").agg(F.sum("_value").alias("v"), F.sum("total_units").alias("u"))
    out = (kept(value, F.col("month")).groupBy(*by, context(F.col("month")).alias("ctx"))
           .agg(F.sum("v").alias("_cur"), F.sum("u").alias("total_units")))
    cal = _days(calendar_bounds(c))
    for months, name in ((-12, "_year"), (-1, "_month")):
        shifted = kept(cal, F.col("date")).select(context(F.col("date")).alias("ctx"), F.add_months("date", months).alias("month"))
        inside = shifted.join(cal.select(F.col("date").alias("month")), "month", "left_semi")
        # the calendar is bounded by the dates, the other side by the mart
        before = inside.join(value, "month").groupBy(*by, "ctx").agg(F.sum("v").alias(name))
        on = [out[k].eqNullSafe(before[k]) for k in (*by, "ctx")]
        out = out.join(before, on, "left").select(*[out[k] for k in out.columns], name)
    cur = F.col("_cur").cast("double")

    def growth(prior: str) -> F.Column:
        return F.try_divide((F.col("_cur") - F.col(prior)).cast("double"), F.col(prior).cast("double"))

    return out.select(
        *by, *([F.col("ctx").alias(dates)] if dates else []), cur.alias("total_sales"), "total_units",
        F.try_divide(cur, F.col("total_units").cast("double")).alias("weighted_price"),
        F.col("_year").cast("double").alias("prior_year_sales"), growth("_year").alias("yoy_growth"),
        F.col("_month").cast("double").alias("prior_month_sales"), growth("_month").alias("mom_growth"))


def _by(c: Cleaned, key: str) -> DataFrame:
    return g1_exact(c).groupBy(key).agg(F.sum("_value").cast("double").alias("total_sales"))


def b9_sales_by_product(c: Cleaned) -> DataFrame:
    return _by(c, "product_name").orderBy(F.desc("total_sales"), "product_name")


def b9_sales_by_country(c: Cleaned) -> DataFrame:
    return _by(c, "country").orderBy(F.desc("total_sales"), "country")


def b9_sales_by_month(c: Cleaned) -> DataFrame:
    return _by(c, "month").orderBy("month")


def b10_date_hierarchy(c: Cleaned) -> DataFrame:
    """Automatic date table: 1 Jan of the calendar's first year … 31 Dec of its last."""
    b = calendar_bounds(c).select(F.make_date(F.year("start"), F.lit(1), F.lit(1)).alias("start"),
                                  F.make_date(F.year("end"), F.lit(12), F.lit(31)).alias("end"))
    d = F.col("date")
    qn = F.floor((F.month(d) + 2) / 3).cast("int")
    return _days(b).select("date", F.year(d).alias("year"), F.month(d).alias("month_no"),
                           D.month_name_es(d).alias("month_name"), qn.alias("quarter_no"),
                           F.concat(F.lit("Trim. "), qn.cast("string")).alias("quarter"),
                           F.dayofmonth(d).alias("day"))
