"""Scalar-function checks over real table columns (F1–F34 that stand alone).

Each applies the library's expressions to values Spark derives from the driver
tables (raw customers, sale dates, prices), so the work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradecast.functions import dates as D
from tradecast.functions.numeric import round_half_up
from tradecast.functions.text import canonical_country, pg_initcap


def fn_strings(roles) -> DataFrame:
    c = roles.customer_raw
    return c.select(
        "customer_id",
        F.trim("name").alias("name_trim"),
        F.upper("name").alias("name_upper"),
        F.lower("name").alias("name_lower"),
        F.length("name").alias("name_length"),
        F.replace(F.col("country"), F.lit("."), F.lit("")).alias("country_no_dots"),
        F.col("country").like("U%").cast("int").alias("country_like_u"),
        (F.col("name") != F.trim("name")).cast("int").alias("name_padded"),
    )


def fn_initcap(roles) -> DataFrame:
    c = roles.customer_raw
    return c.select("customer_id",
                    pg_initcap("name").alias("name_initcap"),
                    pg_initcap(F.trim("country")).alias("country_initcap"),
                    canonical_country("country").alias("country_canonical"))


def _sale_dates(roles) -> DataFrame:
    return roles.sale_raw.select("sale_date").distinct()


def fn_dates(roles) -> DataFrame:
    d = _sale_dates(roles)
    last = roles.sale_raw.select(F.max("sale_date")).scalar()
    sd = F.col("sale_date")
    return d.select(
        "sale_date",
        D.month_start(sd).alias("month_start"),
        D.quarter_start(sd).alias("quarter_start"),
        F.year(sd).alias("year"),
        F.month(sd).alias("month"),
        F.dayofmonth(sd).alias("day"),
        F.quarter(sd).alias("quarter"),
        D.iso_week(sd).alias("iso_week"),
        D.iso_year(sd).alias("iso_year"),
        D.iso_dow(sd).alias("iso_dow"),
        D.days_between(last, sd).alias("days_to_last"),
        D.as_date(F.date_format(sd, "yyyy-MM-dd")).alias("parsed"),
        D.month_name_es(sd).alias("month_name"),
        D.day_name_es(sd).alias("day_name"),
        D.year_month(sd).alias("year_month"),
        F.concat(F.lit("Q"), F.quarter(sd).cast("string")).alias("quarter_label"),
    )


def fn_week_end(roles) -> DataFrame:
    sd = F.col("sale_date")
    return _sale_dates(roles).select("sale_date", D.week_end_sunday(sd).alias("week_end"),
                                     D.iso_dow(sd).alias("iso_dow"))


def fn_weeknum(roles) -> DataFrame:
    sd = F.col("sale_date")
    return _sale_dates(roles).select(
        "sale_date", D.weeknum_monday(sd).alias("weeknum"), D.iso_week(sd).alias("iso_week"),
        D.year_week_key(F.year(sd), D.weeknum_monday(sd)).alias("year_week_key"))


def fn_festivals(roles) -> DataFrame:
    years = _sale_dates(roles).select(F.year("sale_date").alias("year")).distinct()
    return years.select("year", D.valentines_day(F.col("year")).alias("valentines_day"),
                        D.mothers_day(F.col("year")).alias("mothers_day"))


def fn_round(roles) -> DataFrame:
    """Decimal half-up rounding and the engine-neutral double recipe."""
    li = roles.t("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    ratio = F.col("l_extendedprice") / F.col("l_quantity")
    price = (F.floor(ratio * F.lit(1000) + F.lit(0.5)) / F.lit(1000.0)).cast("decimal(10,3)")
    return li.select(
        "l_orderkey", "l_linenumber",
        price.cast("double").alias("price_3"),
        F.round(price, 2).cast("double").alias("price_round2"),
        F.round(price, 0).cast("double").alias("price_round0"),
        round_half_up(ratio, 2).alias("ratio_round2"),
        round_half_up(-ratio, 1).alias("neg_ratio_round1"),
    )
