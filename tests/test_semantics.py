"""Literal mini-fixtures for semantics the driver tables do not exercise."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from reference_stats import adf_test

from tradecast.functions import dates as D
from tradecast.functions.numeric import ratio_half_up, round_half_up
from tradecast.functions.text import pg_initcap
from tradecast.operators import clean, profile
from tradecast.operators.rank import dist_ntile, window_ntile
from tradecast.operators import series as S
from tradecast.operators.series import durbin_levinson
from tradecast.plans import forecast as M
from tradecast.plans.params import DEFAULT

# A small dirty customer catalog: case and blank variants, USA spellings,
# padded kinds, five logical duplicates (29..33).
CUSTOMERS = [
    (1, "Rodriguez, Figueroa and Sanchez", "Reino Unido", "Importador"),
    (2, "Doyle Ltd", "Rusia", "Broker"),
    (3, "Mcclain, Miller and Henderson", "Usa", "Importador"),
    (4, "Davis and Sons", "U.S.A.", "Broker"),
    (5, "Guzman, Hoffman and Baldwin", "Países Bajos", "Importador"),
    (6, "Gardner, Robinson and Lawrence", "USA", "Broker"),
    (7, "BLAKE AND SONS", "Canadá", "Importador"),
    (8, "Henderson, Ramirez and Lewis", "USA", "Retailer"),
    (9, "Garcia-James", "Rusia", "Importador"),
    (10, "Abbott-Munoz", "USA", "Importador"),
    (11, "  Blair PLC  ", "España", "Importador  "),
    (12, "Dudley Group", "Países Bajos", "Retailer"),
    (13, "Arnold Ltd", "Rusia", "Retailer"),
    (14, "Mcclure, Ward and Lee", "Países Bajos", "Importador"),
    (15, "Williams and Sons", "Canadá", "Broker"),
    (16, "Galloway-Wyatt", "Canadá", "Retailer"),
    (17, "James Group", "usa ", "Broker"),
    (18, "Flowers, Martin and Kelly", "Reino Unido", "Broker"),
    (19, "Adams, Zuniga and Wong", "Países Bajos", "Importador"),
    (20, "Reid, Ferguson and Sanchez", "Rusia", "Importador"),
    (21, "Gray-Mayo", "USA", "Retailer"),
    (22, "Watts, Robinson and Nguyen", "USA", "Retailer"),
    (23, "Perez Inc", "Rusia", "Broker"),
    (24, "Morales-Jones", "Reino Unido", "Importador"),
    (25, "Walter, Edwards and Rios", "usa ", "Importador"),
    (26, "Wilkerson-Day", "Países Bajos", "Broker"),
    (27, "Baker and Sons", "España", "Retailer  "),
    (28, "Hoffman, Baker and Richards", "USA", "Retailer"),
    (29, "Abbott-Munoz", "USA", "Importador"),
    (30, "Wilkerson-Day", "Países Bajos", "Broker"),
    (31, "Garcia-James", "Rusia", "Importador"),
    (32, "Watts, Robinson and Nguyen", "USA", "Retailer"),
    (33, "Rodriguez, Figueroa and Sanchez", "Reino Unido", "Importador"),
]


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(CUSTOMERS, "customer_id long, name string, country string, kind string")


def test_canonical_customers(customers):
    m = {r.customer_id: r.canonical_id for r in clean.customer_map(customers).collect()}
    assert {k: m[k] for k in (29, 30, 31, 32, 33)} == {29: 10, 30: 26, 31: 9, 32: 22, 33: 1}
    assert all(m[k] == k for k in range(1, 29))
    dim = clean.customer_dim(customers)
    assert dim.count() == 28
    by_country = {r.country: r["count"] for r in dim.groupBy("country").count().collect()}
    assert by_country == {"USA": 10, "Rusia": 5, "Países Bajos": 5, "Reino Unido": 3, "Canadá": 3, "España": 2}
    names = {r.customer_id: r.name for r in dim.collect()}
    assert names[10] == "Abbott-Munoz" and names[16] == "Galloway-Wyatt"
    assert names[7] == "Blake And Sons" and names[11] == "Blair Plc"
    kinds = {r.customer_id: r.kind for r in dim.collect()}
    assert kinds[11] == "Importador" and kinds[27] == "Retailer"
    basic = {r.customer_id: r.country for r in clean.customer_dim_basic(customers).collect()}
    assert basic[4] == "U.S.A." and basic[17] == "USA" and basic[3] == "USA"


def test_profiling_defects(customers):
    assert [r.customer_id for r in profile.upper_names(customers).collect()] == [7]
    assert [r.customer_id for r in profile.padded_names(customers).collect()] == [11]
    assert sorted(r.customer_id for r in profile.padded_kinds(customers).collect()) == [11, 27]
    assert sorted(r.country for r in profile.country_variants(customers).collect()) == \
        sorted(["Usa", "U.S.A.", "USA", "usa "])
    assert profile.duplicate_names(customers).count() == 5
    assert profile.residual_logical(clean.customer_dim(customers)).count() == 0


def test_initcap_word_rule(spark):
    df = spark.createDataFrame([("abbott-MUNOZ",), ("o'neil",), ("BLAIR PLC",), ("x1y z",), ("",), (None,)], "s string")
    got = [r[0] for r in df.select(pg_initcap("s")).collect()]
    assert got == ["Abbott-Munoz", "O'Neil", "Blair Plc", "X1y Z", "", None]


def test_exact_rounding_ties(spark):
    df = spark.createDataFrame([(125,), (135,), (2675,), (5,)], "milli long")
    got = [r[0] for r in df.select(ratio_half_up(F.col("milli"), 1, 2, 3)).collect()]
    assert got == [0.13, 0.14, 2.68, 0.01]
    neg = spark.createDataFrame([(-1.25,), (1.25,), (-0.0000001,)], "x double")
    assert [r[0] for r in neg.select(round_half_up("x", 1)).collect()] == [-1.3, 1.3, 0.0]


def test_iso_year_ends(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2024, 12, 30),), (dt.date(2027, 1, 1),)], "d date")
    rows = df.select(D.iso_week("d"), F.year("d"), D.iso_year("d")).collect()
    assert [tuple(r) for r in rows] == [(52, 2023, 2022), (1, 2024, 2025), (53, 2027, 2026)]


def test_week_end_sunday(spark):
    df = spark.createDataFrame([(dt.date(2024, 6, 1),), (dt.date(2024, 6, 2),), (dt.date(2024, 6, 3),)], "d date")
    got = [r[0] for r in df.select(D.week_end_sunday("d")).collect()]
    assert got == [dt.date(2024, 6, 2), dt.date(2024, 6, 2), dt.date(2024, 6, 9)]


def test_festivals_and_weeknum(spark):
    df = spark.createDataFrame([(2022,), (2024,), (2026,)], "y int")
    got = [r[0] for r in df.select(D.mothers_day("y")).collect()]
    assert got == [dt.date(2022, 5, 8), dt.date(2024, 5, 12), dt.date(2026, 5, 10)]
    # WEEKNUM(d, 2): 2023-01-01 is a Sunday -> week 1; 2023-01-02 (Monday) -> week 2.
    w = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2023, 1, 2),), (dt.date(2024, 12, 31),)], "d date")
    assert [r[0] for r in w.select(D.weeknum_monday("d")).collect()] == [1, 2, 53]


def test_ntile_sizes_and_distributed_equals_window(spark):
    rows = [(i, i // 3) for i in range(28)]  # ties in the value
    df = spark.createDataFrame(rows, "id long, v long")
    order = [F.col("v").desc(), F.col("id").asc()]
    a = {r.id: r.b for r in window_ntile(df, 5, order, "b").collect()}
    b = {r.id: r.b for r in dist_ntile(df.repartition(7), 5, order, "b").collect()}
    assert a == b
    sizes = sorted(np.bincount(list(a.values()))[1:].tolist(), reverse=True)
    assert sizes == [6, 6, 6, 5, 5]
    big = spark.range(2003).select(F.col("id"), (F.col("id") * 7919 % 101).alias("v")).repartition(5)
    order = [F.col("v").asc(), F.col("id").asc()]
    x = {r.id: r.b for r in window_ntile(big, 7, order, "b").collect()}
    y = {r.id: r.b for r in dist_ntile(big, 7, order, "b").collect()}
    assert x == y


def test_dedup_null_key_keeps_lowest_id(spark):
    schema = ("movement_id long, move_date date, store_room_id int, production_id long, "
              "move_type string, quantity int")
    d = dt.date(2024, 3, 1)
    df = spark.createDataFrame([(91548, d, 2, None, "out", 40), (91540, d, 2, None, "out", 40),
                                (91541, d, 2, 7, "out", 40)], schema)
    got = sorted(r.movement_id for r in clean.movements_dedup(df).collect())
    assert got == [91540, 91541]


def test_unimputable_group_stays_null(spark):
    schema = ("sale_id long, order_id long, line_no int, sale_date date, customer_id long, product_id long, "
              "pack string, units long, unit_price decimal(10,3)")
    d = dt.date(2024, 1, 1)
    from decimal import Decimal
    sales = spark.createDataFrame([(1, 1, 1, d, 1, 100, "FB", 10, None), (2, 1, 2, d, 1, 200, "FB", 10, Decimal("0.125")),
                                   (3, 1, 3, d, 1, 200, "FB", 3, None)], schema)
    cmap = spark.createDataFrame([(1, "A", 1)], "customer_id long, clean_name string, canonical_id long")
    out = {r.sale_id: (r.unit_price, r.value_total) for r in clean.sales(sales, cmap).collect()}
    assert out[1] == (None, None)
    assert out[2] == (Decimal("0.13"), Decimal("1.25"))
    assert out[3] == (Decimal("0.13"), Decimal("0.38"))  # 3 x 0.125 = 0.375 -> 0.38 (unrounded price)
    assert [r.sale_id for r in profile.unimputable(sales).collect()] == [1]


def test_cost_function(spark):
    rows = [("m", 10, 8.0, 0), ("m", 10, 8.0, 1), ("m", 8, 10.0, 0), ("m", 8, 10.0, 1)]
    df = spark.createDataFrame(rows, "model string, y_target long, pred double, window_peak1 int")
    y, yh = F.col("y_target"), F.col("pred")
    cu = F.when(F.col("window_peak1") == 1, 0.60).otherwise(0.35)
    per_row = (F.greatest(y - yh, F.lit(0.0)) * cu + F.greatest(yh - y, F.lit(0.0)) * 0.28)
    got = [round(r[0], 10) for r in df.select(per_row).collect()]
    assert got == [0.7, 1.2, 0.56, 0.56]
    assert M.metrics(df).first().cost == 3.02


def test_capacity_from_area(spark):
    class _C:
        site = spark.createDataFrame([(1, __import__("decimal").Decimal("322.62"))], "site_id long, area decimal(6,2)")
    r = M.capacity(_C()).first()
    assert (r.capacity_base, r.capacity_max) == (3_839_178, 6_219_468)


def _panel(spark, values, start=dt.date(2020, 1, 5), series="s", skip: set | None = None):
    rows, d = [], start
    for i, v in enumerate(values):
        if not skip or i not in skip:
            rows.append((d, series, int(v)))
        d += dt.timedelta(days=7)
    return spark.createDataFrame(rows, "week_end date, series_id string, demand long")


def test_short_history_growth_is_one(spark):
    for n in (53 + 13, 59 + 13):
        f = M.direct_features(_panel(spark, np.arange(n) % 17 + 1), DEFAULT)
        g = {r.origin_date: r.growth for r in f.select("origin_date", "growth").distinct().collect()}
        origins = sorted(g)
        # origins with fewer than 60 weeks of history compare the recent 8 weeks with themselves
        for i, o in enumerate(origins):
            idx = 52 + i
            if idx < 59:
                assert g[o] == 1.0


def test_missing_lag52_week_falls_back_to_ma12(spark):
    vals = np.arange(80) * 3 + 5
    p = _panel(spark, vals, skip={10})  # week 10 never observed
    f = M.direct_features(p, DEFAULT).collect()
    # target dates whose date − 364 days is the unobserved week get ma_12
    missing = dt.date(2020, 1, 5) + dt.timedelta(days=70)
    hit = [r for r in f if r.target_date - dt.timedelta(days=364) == missing]
    assert hit and all(r.y_lag_52 == r.ma_12 for r in hit)
    ok = [r for r in f if r.target_date - dt.timedelta(days=364) != missing]
    assert all(r.y_lag_52 != r.ma_12 or r.y_lag_52 is not None for r in ok)


def test_no_leak_from_the_future(spark):
    vals = (np.sin(np.arange(120) / 5) * 50 + 100).astype(int)
    base = M.direct_features(_panel(spark, vals), DEFAULT)
    cut = dt.date(2020, 1, 5) + dt.timedelta(days=7 * 70)
    changed = vals.copy()
    changed[71:] += 1000  # everything after the origin at index 70
    pert = M.direct_features(_panel(spark, changed), DEFAULT)
    cols = ["origin_date", "horizon", "y_T", "y_T_1", "y_T_2", "y_T_3", "ma_4", "ma_12", "std_8", "growth"]
    a = sorted(tuple(r) for r in base.where(F.col("origin_date") <= cut).select(cols).collect())
    b = sorted(tuple(r) for r in pert.where(F.col("origin_date") <= cut).select(cols).collect())
    assert a == b and len(a) > 0


def test_durbin_levinson_ar1_and_yule_walker():
    phi = 0.6
    r = phi ** np.arange(10)
    p = durbin_levinson(r)
    assert math.isclose(p[1], phi) and np.allclose(p[2:], 0, atol=1e-12)
    rng = np.random.default_rng(1)
    x = rng.standard_normal(400).cumsum() * 0.1 + rng.standard_normal(400)
    x = x - x.mean()
    acf = np.array([np.dot(x[k:], x[:len(x) - k]) for k in range(8)]) / np.dot(x, x)
    p = durbin_levinson(acf)
    for k in range(1, 8):  # last coefficient of the order-k Yule-Walker solution
        R = np.array([[acf[abs(i - j)] for j in range(k)] for i in range(k)])
        assert math.isclose(np.linalg.solve(R, acf[1:k + 1])[-1], p[k], rel_tol=1e-9, abs_tol=1e-12)


def test_adf_separates_random_walk_from_noise():
    rng = np.random.default_rng(7)
    noise = adf_test(rng.standard_normal(300))
    walk = adf_test(rng.standard_normal(300).cumsum())
    assert noise["stationary_5pct"] == 1 and walk["stationary_5pct"] == 0
    # critical values follow the response surface in the number of observations
    assert noise["crit_5pct"] < -2.86 and noise["crit_1pct"] < noise["crit_5pct"] < noise["crit_10pct"]


def test_adf_equals_the_direct_regression(spark):
    rng = np.random.default_rng(11)
    series = {"noise": rng.standard_normal(300), "walk": rng.standard_normal(300).cumsum() * 1e4 + 5e5, "short": rng.standard_normal(9),
              "seasonal": 1e5 + 1e4 * np.sin(np.arange(345) / 8.3) + 2e3 * rng.standard_normal(345), "flat": np.ones(40), "two": np.array([1.0, 2.0])}
    rows = [(k, i, float(v)) for k, x in series.items() for i, v in enumerate(x)]
    out = {r["s"]: r for r in S.adf(spark.createDataFrame(rows, "s string, t int, y double").repartition(5), "s", "t", "y").collect()}
    assert set(out) == set(series)
    for k in ("noise", "walk", "seasonal", "short"):
        want = adf_test(series[k])
        assert (out[k]["n_obs"], out[k]["used_lag"], out[k]["stationary_5pct"]) == (want["n_obs"], want["used_lag"], want["stationary_5pct"])
        assert out[k]["adf_stat"] == pytest.approx(want["adf_stat"], abs=2e-6) and out[k]["crit_5pct"] == pytest.approx(want["crit_5pct"], abs=1e-6)
    assert out["noise"]["p_value"] < 0.001 < out["walk"]["p_value"]
    assert all((out[k]["p_value"] <= 0.05) == bool(out[k]["stationary_5pct"]) for k in ("noise", "walk", "seasonal"))
    assert all(out[k]["adf_stat"] is None and out[k]["n_obs"] == 0 for k in ("flat", "two"))


def test_adf_p_value_and_normal_distribution(spark):
    x = [-9.0, -7.5, -3.0, -0.1, 0.0, 1.96, 6.0, 9.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in x], "x double").coalesce(1).select(S.normal_cdf(F.col("x"))).collect()]
    assert got == pytest.approx([0.5 * math.erfc(-v / math.sqrt(2)) for v in x], abs=1e-12)
    # a published pair: statistic -3.2772, p = 0.015927
    p = spark.createDataFrame([(-3.2772,), (-30.0,), (3.0,)], "t double").coalesce(1).select(S.adf_p_value(F.col("t"))).collect()
    assert [r[0] for r in p] == pytest.approx([0.015927, 0.0, 1.0], abs=1e-4)
