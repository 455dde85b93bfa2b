"""Incremental ingest: a re-run picks up only newly landed files (checkpointed)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradecast.session import scratch_dir
from tradecast.sources.io import RAW_SCHEMAS, write_csv
from tradecast.sources.roles import Roles
from tradecast.streaming import ingest_csv


def test_ingest_is_incremental_and_exactly_once(spark, sf_dir):
    sale = Roles(spark, sf_dir).sale_raw.select(*RAW_SCHEMAS["sale"].fieldNames())
    base = scratch_dir(spark, "stream-test")
    landing, table, ckpt = f"{base}/landing", f"{base}/bronze", f"{base}/_ckpt"
    first = sale.where(F.col("order_id") % 2 == 0)
    second = sale.where(F.col("order_id") % 2 == 1)
    write_csv(first, f"{landing}/batch1")
    ingest_csv(spark, "sale", f"{landing}/*", table, ckpt)
    n1 = spark.read.parquet(table).count()
    assert n1 == first.count()
    ingest_csv(spark, "sale", f"{landing}/*", table, ckpt)          # nothing new: no duplicates
    assert spark.read.parquet(table).count() == n1
    write_csv(second, f"{landing}/batch2")
    ingest_csv(spark, "sale", f"{landing}/*", table, ckpt)          # only the new files
    got = spark.read.schema(RAW_SCHEMAS["sale"]).parquet(table)
    assert got.count() == sale.count()
    assert got.exceptAll(sale).count() == 0 and sale.exceptAll(got).count() == 0
