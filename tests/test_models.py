"""MLlib forecasts: same test rows as the baselines, non-negative, four models scored."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradecast.registry import queries

Q = queries()


def test_gbt_and_quantile_cover_the_test_rows(spark):
    sf = "/root/testdata/sf0.01"
    naive = Q["m5_seasonal_naive"](spark, sf)
    gbt = Q["m7_gbt_mean"](spark, sf)
    assert gbt.count() == naive.count() > 0
    assert gbt.where(F.col("pred") < 0).count() == 0
    m = {r.model: r for r in Q["m10_metrics_h12_all"](spark, sf).collect()}
    assert len(m) == 4
    assert all(r.cost >= 0 for r in m.values())


def test_every_product_has_a_boosted_and_a_quantile_forecast(spark, sf_dir):
    gbt = Q["m7_gbt_mean_by_product"](spark, sf_dir)
    quantile = Q["m8_quantile_by_product"](spark, sf_dir)
    series = {r[0] for r in gbt.select("series_id").distinct().collect()}
    brands = Q["m7_gbt_mean"](spark, sf_dir).select("series_id").distinct().count()
    assert len(series) == spark.read.parquet(f"{sf_dir}/part.parquet").count() > brands
    assert gbt.count() == quantile.count()
    assert len({r.model for r in Q["m9_metrics_all_by_product"](spark, sf_dir).collect()}) == 4
    assert len({r.model for r in Q["m10_metrics_h12_all_by_product"](spark, sf_dir).collect()}) == 4
    assert Q["m12_capacity_gbt_by_product"](spark, sf_dir).count() > 0
