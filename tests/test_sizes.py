"""Tasks whose share does not grow with the tables."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal
from types import SimpleNamespace

from pyspark.sql import functions as F
from pyspark.sql.functions import spark_partition_id

from tradecast import registry, session
from tradecast.functions.numeric import ratio_half_up_units, to_cents, to_milli
from tradecast.operators.contracts import TableSpec
from tradecast.plans import forecast as M
from tradecast.plans import marts as G
from tradecast.plans.params import PER_PRODUCT
from tradecast.sources import load as LD
from tradecast.sources import roles as RO


def test_buckets_grow_with_the_rows_and_hold_what_is_read(spark, sf_dir, monkeypatch):
    """F25."""
    monkeypatch.setattr(RO, "BUCKET_ROWS", 500)
    plain, roles = RO.Roles(spark, sf_dir), RO.Roles(spark, sf_dir, buckets=2)
    lines = roles.t("lineitem")
    assert lines.columns == RO.BUCKET_COLUMNS["lineitem"]
    assert -(-lines.count() // 500) == len(lines.inputFiles()) > 2
    assert roles.sale_raw.exceptAll(plain.sale_raw).count() == 0 == plain.sale_raw.exceptAll(roles.sale_raw).count()


def test_rows_without_a_foreign_key_are_spread(spark):
    """a third of the movements have no harvest."""
    rows = spark.range(4000).select(F.col("id"), F.when(F.col("id") % 4 == 0, F.col("id") % 7).alias("up"))
    up = spark.range(5).select(F.col("id").alias("k"))
    aqe, small = "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(aqe), spark.conf.get(small)
    spark.conf.set(aqe, "false")
    spark.conf.set(small, "-1")
    try:
        out = LD.checked(rows, TableSpec(fk={"up": ("parent", "k")}), {"parent": up})
        got = out.withColumn("task", spark_partition_id()).collect()
    finally:
        spark.conf.set(aqe, before[0])
        spark.conf.set(small, before[1])
    assert out.columns == ["id", "up", "broken"] and len(got) == 4000
    assert all((r["broken"] == ["foreign_key:up"]) == (r["up"] is not None and r["up"] > 4) for r in got)
    none = [r["task"] for r in got if r["up"] is None]
    assert len(set(none)) == 8 and max(map(none.count, set(none))) < len(none) / 4


def test_rows_of_a_fit_are_counted_and_picked_before_they_are_made(spark, sf_dir):
    """The same rows as from the whole set."""
    c, p = registry.cleaned(spark, sf_dir), PER_PRODUCT
    whole = M.supervised(c, p, level=True).cache()
    counts = {r["target_date"]: r["count"] for r in whole.groupBy("target_date").count().collect()}
    weeks = M.target_weeks(c, p)
    assert {d: n for d, _, n in weeks if n} == counts
    shares = [0.01 if s == "train" else 2.0 if s == "val" and i % 3 == 0 else 0.0 for i, (_, s, _) in enumerate(weeks)]
    by_week = {str(d): x for (d, _, _), x in zip(weeks, shares, strict=True)}
    share = F.create_map(*[F.lit(x) for pair in by_week.items() for x in pair])[F.col("target_date").cast("string")]
    picked = M.supervised(c, p, level=True, shares=shares)
    expected = whole.where(M.row_hash() < share)
    assert expected.count() == picked.count() > 0
    assert picked.exceptAll(expected).count() == 0
    whole.unpersist()


def test_sums_of_metrics_are_whole_numbers(spark):
    """no decimal for each row; exact beyond a long, in any order."""
    rows = [("a", 10, 0.1234565, 0), ("a", 0, 3e6 + 0.000001, 1), ("a", 5_000_000, 0.0, 0), ("b", 3, None, 1), ("b", -2, 2.5, 0)]
    df = spark.createDataFrame(rows, "model string, y_target long, pred double, window_peak1 int")
    out = M.metrics(df)
    assert "decimal(28,6)" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r["model"]: r.asDict() for r in out.collect()}
    assert got["a"]["rmse"] == round(((10 - 0.1234565) ** 2 + 9e12 + 6 + 25e12) ** 0.5 / 3 ** 0.5, 1)
    assert got["a"]["mae"] == round((10 - 0.123457 + 3e6 + 5e6) / 3, 1)
    assert got["b"]["mae"] == 2.3  # the row without a prediction counts, but has no error


def test_the_monthly_mart_shuffles_narrow_rows_and_keeps_repeated_products(spark):
    """F14, F15, F18, F20-F23."""
    day = dt.date(2000, 1, 5)
    sales = spark.createDataFrame([(day, 1, 7, 2, Decimal("3.10")), (day, 1, 8, 1, Decimal("0.05")), (day, 2, 7, 5, None), (None, 1, 7, 1, Decimal("1.00")),
                                   (day, 3, 7, 9, Decimal("9.00")), (day, 1, 9, 9, Decimal("9.00")), (day, None, 7, 9, Decimal("9.00"))],
                                  "sale_date date, product_id long, customer_id long, units long, value_total decimal(18,2)")
    product = spark.createDataFrame([(1, "Rose", "A", "red"), (1, "Rose", "A", "red"), (1, "Rosa", "A", "red"), (2, None, "B", "x")],
                                    "product_id long, name string, kind string, color string")
    customer = spark.createDataFrame([(7, "c7", "UK", "k"), (8, "c8", "UK", "k")], "customer_id long, name string, country string, kind string")
    out = G._g1_exact(SimpleNamespace(sales=sales, product=product, customer=customer))
    plan = out._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"hashpartitioning\((month[^)]*)\)", plan)
    assert len(keys) == 1 and "product_name" not in keys[0], keys
    got = {(str(r["month"]), r["product_id"], r["product_name"]): (r["n_transactions"], r["total_units"], r["_value"]) for r in out.collect()}
    assert got == {("2000-01-01", 1, "Rose"): (4, 6, Decimal("6.30")), ("2000-01-01", 1, "Rosa"): (2, 3, Decimal("3.15")), ("2000-01-01", 2, None): (1, 5, None),
                   ("None", 1, "Rose"): (2, 2, Decimal("2.00")), ("None", 1, "Rosa"): (1, 1, Decimal("1.00"))}


def test_shuffles_begin_with_partitions_by_the_rows(spark, sf_dir, monkeypatch):
    """F12, F13, F24."""
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    monkeypatch.setattr(registry, "_SILVER", {})
    monkeypatch.setattr(session, "SHUFFLE_ROWS", 100)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    try:
        registry.cleaned(spark, sf_dir)
        assert spark.conf.get(name) == str(-(-lines // 100))
        session.shuffle_for(spark, 1000)  # smaller tables of the session leave it
        assert spark.conf.get(name) == str(-(-lines // 100))
    finally:
        spark.conf.unset(name)
    session.shuffle_for(spark, 800)  # its own partitions are enough
    assert spark.conf.get(name, None) is None


def test_ratios_and_units_are_exact_in_longs_and_beyond(spark):
    """no decimal for each row, and the same numbers."""
    pairs = [(a, b) for a in (0, 1, 5, 12345, 2 ** 51 + 1, 2 ** 52, 2 ** 61 // 1000, 2 ** 62 // 2000 + 1, 10 ** 24) for b in (1, 2, 3, 7, 2 ** 40 + 1, 2 ** 61 // 100 + 1)]
    df = spark.createDataFrame([(Decimal(a), b) for a, b in pairs], "a decimal(38,0), b long")
    for digits, scale in ((0, 0), (3, 2), (2, 3)):
        want = {(a, b): (2 * a * 10 ** digits + b * 10 ** scale) // (2 * b * 10 ** scale) for a, b in pairs}
        for r in df.select("a", "b", F.try_divide("a", "b").alias("q"), ratio_half_up_units("a", "b", digits, scale).alias("k")).where(F.col("q") < 1e14).collect():
            assert r["k"] == want[(int(r["a"]), r["b"])], r
    money = [Decimal(x) for x in ("0.01", "-0.01", "1.15", "703687441776.63", "703687441776.64", "9999999999999999.99", "-9999999999999999.99")] + [None]
    df = spark.createDataFrame([(x,) for x in money], "x decimal(18,2)")
    assert [r[0] for r in df.select(to_cents("x")).collect()] == [None if x is None else int(x * 100) for x in money]
    df = spark.createDataFrame([(Decimal(x),) for x in ("0.001", "2.675", "9999999.999", "-1.005")], "x decimal(10,3)")
    assert [r[0] for r in df.select(to_milli("x")).collect()] == [1, 2675, 9999999999, -1005]
    plan = spark.range(5).select(ratio_half_up_units(F.col("id"), F.col("id") + 1, 3, 2).alias("k"))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan  # longs first
