"""Per-product (scale-run) panel keys: whole-table comparison with the SQL twin
on the smallest driver tables (too many rows for the sf0.01 gate)."""

from __future__ import annotations

from harness import compare, duck

from tradecast.oracle.series import SLOW_SQL
from tradecast.registry import queries


def test_per_product_direct_features_match_sql(spark, sf_dir):
    r = compare(spark, sf_dir, queries()["m2_direct_features_by_product"],
                SLOW_SQL["m2_direct_features_by_product"], duck(sf_dir))
    assert r["cols_match"] and r["spark_rows"] == r["oracle_rows"] > 0 and r["hash_match"], r


def test_large_keys_keep_their_rows(spark, sf_dir, tmp_path):
    """Customer keys above ten million and an order key of eleven digits."""
    from pyspark.sql import functions as F

    from tradecast.operators.clean import customer_map, sales
    from tradecast.sources.roles import Roles
    shift = 10_000_000
    for name, keys in {"customer": ["c_custkey"], "orders": ["o_custkey"]}.items():
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        more = df
        for k in keys:
            more = more.withColumn(k, F.col(k) + shift)
        if name == "customer":
            more = df.unionByName(more.withColumn("c_name", F.concat(F.lit("New "), F.col("c_name"))))
        else:
            more = df.unionByName(more.withColumn("o_orderkey", F.col("o_orderkey") + 12_345_670_000))
        more.write.parquet(f"{tmp_path}/{name}.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lines.unionByName(lines.withColumn("l_orderkey", F.col("l_orderkey") + 12_345_670_000)).write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("nation", "part", "supplier", "region"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    roles = Roles(spark, str(tmp_path))
    cmap = customer_map(roles.customer_raw)
    assert cmap.count() == cmap.select("customer_id").distinct().count()
    assert cmap.select("canonical_id").distinct().count() == spark.read.parquet(f"{tmp_path}/customer.parquet").count()
    clean = sales(roles.sale_raw, cmap)
    assert clean.count() == roles.sale_raw.count() == 2 * lines.count()
    assert clean.where("customer_id IS NULL").count() == 0
    awb = roles.shipment.select("awb", "order_id")
    assert awb.select("awb").distinct().count() == awb.count()
    assert awb.where("order_id > 9999999999 AND length(awb) != 14").count() == 0


def test_csv_keeps_blanks(spark, sf_dir):
    from tradecast.sources.io import csv_roundtrip
    from tradecast.sources.roles import Roles
    roles = Roles(spark, sf_dir)
    back = csv_roundtrip(roles, "customer")
    assert back.exceptAll(roles.customer_raw).count() == 0
    assert back.where("name <> trim(name)").count() > 0
