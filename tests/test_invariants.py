"""Twin techniques and invariants on the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tradecast.functions.numeric import ratio_half_up_units, to_milli
from tradecast.operators.clean import Cleaned
from tradecast.plans import forecast as M
from tradecast.plans import marts as G
from tradecast.plans import questions as Q
from tradecast.plans import timeseries as TS
from tradecast.registry import cleaned
from tradecast.sources.roles import Roles


def _c(spark, sf_dir) -> Cleaned:
    return cleaned(spark, sf_dir)


def test_imputation_window_form_equals_join_form(spark, sf_dir):
    raw = Roles(spark, sf_dir).sale_raw
    w = Window.partitionBy("product_id")
    milli = to_milli("unit_price")
    s = F.sum(F.when(F.col("unit_price").isNotNull(), milli)).over(w)
    n = F.count("unit_price").over(w)
    cents = F.when(F.col("unit_price").isNotNull(), ratio_half_up_units(milli, 1, 2, 3)) \
        .otherwise(ratio_half_up_units(s, n, 2, 3))
    twin = raw.select("sale_id", "order_id", "line_no", "units", cents.alias("c"))
    c = _c(spark, sf_dir)
    joined = c.sales.select("sale_id", "order_id", "line_no", "units",
                            (F.col("unit_price") * 100).cast("long").alias("c"))
    assert twin.exceptAll(joined).count() == 0 and joined.exceptAll(twin).count() == 0
    assert c.sales.count() == raw.count()  # every raw row kept


def test_lapsed_left_anti_equals_except(spark, sf_dir):
    c = _c(spark, sf_dir)
    a = {r.customer_id for r in Q.q07_lapsed_customers(c).collect()}
    b = {r.customer_id for r in Q.q07b_lapsed_except(c).collect()}
    assert a == b


def test_rfm_distributed_equals_window_and_covers_customers(spark, sf_dir):
    c = _c(spark, sf_dir)
    d = G.g2_customer_rfm(c, "distributed")
    w = G.g2_customer_rfm(c, "window")
    assert d.exceptAll(w).count() == 0 and w.exceptAll(d).count() == 0
    buyers = c.sales.select("customer_id").distinct().count()
    seg_total = d.groupBy("segment").count().agg(F.sum("count")).first()[0]
    assert seg_total == buyers == d.count()


def test_panel_is_weeks_times_series(spark, sf_dir):
    c = _c(spark, sf_dir)
    p = TS.t3_dense_panel(c)
    weeks = TS.weekly_series(c).select("week_end").distinct().count()
    series = TS.weekly_series(c).select("series_id").distinct().count()
    assert p.count() == weeks * series
    f = M.m2_direct_features(c)
    assert f.count() == series * max(0, weeks - 52 - 12) * 12


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_value" in df.columns and "weighted_price" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())
