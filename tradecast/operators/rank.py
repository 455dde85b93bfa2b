"""Distributed global NTILE.

``ntile(n) OVER (ORDER BY ...)`` without ``PARTITION BY`` makes Spark move every
row into one partition (``Exchange SinglePartition``).  ``dist_ntile`` computes
the same buckets with a range shuffle instead:

1. ``repartitionByRange`` on the (total) order + sort inside each partition;
2. ``monotonically_increasing_id`` then numbers rows inside each partition
   (``(partition << 33) + row``);
3. per-partition counts -> prefix offsets: one row per partition, so the
   broadcast has a proven size bound;
4. global 0-based rank ``r`` -> bucket with ``q = N div n, m = N mod n``:
   ``r < m(q+1) ? r div (q+1) : m + (r - m(q+1)) div q`` (+1).

The order must be total (end with a unique id).  The numbered rows are written
to the shared checkpoint folder (one job) so the count pass and the rank pass
read identical data.  Matches ``F.ntile`` row for row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradecast.functions.numeric import int_div
from tradecast.session import scratch_dir


def window_ntile(df: DataFrame, n: int, order: list[Column], out: str) -> DataFrame:
    """One unpartitioned window (a single task): the tests compare against it."""
    return df.withColumn(out, F.ntile(n).over(Window.orderBy(*order)))


def dist_ntile(df: DataFrame, n: int, order: list[Column], out: str) -> DataFrame:
    cols = df.columns
    spark = df.sparkSession
    # Position inside each range partition is fixed once and written to the
    # shared folder: both passes below read the same rows, and a lost executor
    # re-reads the table instead of re-sampling the range bounds.
    path = scratch_dir(spark, "ntile")
    (df.repartitionByRange(*order)
     .sortWithinPartitions(*order)
     .withColumn("_pid", F.spark_partition_id())
     .withColumn("_mid", F.monotonically_increasing_id())
     .write.parquet(path))
    ranged = spark.read.parquet(path)
    per_part = ranged.groupBy("_pid").agg(F.count("*").alias("_cnt"))
    w_all = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = per_part.select(
        "_pid",
        (F.sum("_cnt").over(w_all) - F.col("_cnt")).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy()).alias("_total"),
    )
    r = F.col("_off") + (F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
    q = int_div(F.col("_total"), F.lit(n))
    m = F.col("_total") % F.lit(n)
    big = m * (q + 1)
    bucket = F.when(r < big, int_div(r, q + 1)).otherwise(m + int_div(r - big, q)) + F.lit(1)
    return (ranged.join(F.broadcast(offsets), "_pid")
            .select(*cols, bucket.cast("int").alias(out)))


def ntile(df: DataFrame, n: int, order: list[Column], out: str, method: str = "distributed") -> DataFrame:
    """The same plan at every size; ``method="window"`` is the form that the
    tests compare it with."""
    return window_ntile(df, n, order, out) if method == "window" else dist_ntile(df, n, order, out)
