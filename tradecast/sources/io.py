"""Sources and sinks: typed CSV scans, dependency-ordered append loads, mart
materialisation, and the feature-source fallback.

All written tables go to a fresh folder under the shared checkpoint folder
(``session.scratch_dir``), never to a machine-local path on a cluster.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradecast.session import scratch_dir

# Explicit schemas of the raw entities (no inference on read).
RAW_SCHEMAS: dict[str, T.StructType] = {
    "product": T.StructType([
        T.StructField("product_id", T.LongType(), False), T.StructField("name", T.StringType()),
        T.StructField("kind", T.StringType()), T.StructField("color", T.StringType())]),
    "site": T.StructType([
        T.StructField("site_id", T.LongType(), False), T.StructField("code", T.StringType()),
        T.StructField("area", T.DecimalType(6, 2)), T.StructField("product_id", T.LongType()),
        T.StructField("group_id", T.IntegerType())]),
    "store_room": T.StructType([
        T.StructField("store_room_id", T.IntegerType(), False), T.StructField("code", T.StringType()),
        T.StructField("target_temp", T.DecimalType(4, 2)), T.StructField("capacity", T.IntegerType())]),
    "carrier": T.StructType([
        T.StructField("carrier_id", T.IntegerType(), False), T.StructField("name", T.StringType()),
        T.StructField("iata", T.StringType())]),
    "forwarder": T.StructType([
        T.StructField("forwarder_id", T.IntegerType(), False), T.StructField("name", T.StringType()),
        T.StructField("country", T.StringType())]),
    "customer": T.StructType([
        T.StructField("customer_id", T.LongType(), False), T.StructField("name", T.StringType()),
        T.StructField("country", T.StringType()), T.StructField("kind", T.StringType())]),
    "production": T.StructType([
        T.StructField("production_id", T.LongType(), False), T.StructField("prod_date", T.DateType()),
        T.StructField("site_id", T.LongType()), T.StructField("units", T.LongType()),
        T.StructField("grade", T.StringType()), T.StructField("length_cm", T.IntegerType())]),
    "movement": T.StructType([
        T.StructField("movement_id", T.LongType(), False), T.StructField("order_id", T.LongType()),
        T.StructField("source_no", T.IntegerType()), T.StructField("move_date", T.DateType()),
        T.StructField("store_room_id", T.IntegerType()), T.StructField("production_id", T.LongType()),
        T.StructField("move_type", T.StringType()), T.StructField("quantity", T.IntegerType())]),
    "sale": T.StructType([
        T.StructField("sale_id", T.LongType(), False), T.StructField("order_id", T.LongType()),
        T.StructField("line_no", T.IntegerType()), T.StructField("sale_date", T.DateType()),
        T.StructField("customer_id", T.LongType()), T.StructField("product_id", T.LongType()),
        T.StructField("pack", T.StringType()), T.StructField("units", T.LongType()),
        T.StructField("unit_price", T.DecimalType(10, 3))]),
    "shipment": T.StructType([
        T.StructField("shipment_id", T.LongType(), False), T.StructField("ship_date", T.DateType()),
        T.StructField("order_id", T.LongType()), T.StructField("carrier_id", T.IntegerType()),
        T.StructField("forwarder_id", T.IntegerType()), T.StructField("awb", T.StringType()),
        T.StructField("weight", T.DecimalType(8, 2))]),
}

# Dimensions before facts, so every foreign key finds its parent already loaded.
LOAD_ORDER = ["product", "site", "store_room", "customer", "carrier", "forwarder",
              "production", "movement", "sale", "shipment"]

ROLE_ATTR = {"customer": "customer_raw", "sale": "sale_raw", "movement": "movement_raw"}


def role_frame(roles, name: str) -> DataFrame:
    return getattr(roles, ROLE_ATTR.get(name, name))


def read_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Header CSV with the declared schema; malformed rows fail the job."""
    return (spark.read.schema(RAW_SCHEMAS[name]).option("header", True)
            .option("mode", "FAILFAST").option("emptyValue", "").csv(path))


# Blanks around a value are data: Spark's writer strips them unless told not to.
CSV_WRITE = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_WRITE).csv(path)


def csv_roundtrip(roles, name: str = "sale") -> DataFrame:
    """Write a raw entity as CSV, scan it back with its declared schema."""
    spark = roles.spark
    path = scratch_dir(spark, f"csv-{name}")
    write_csv(role_frame(roles, name).select(*RAW_SCHEMAS[name].fieldNames()), path)
    return read_csv(spark, path, name)


def load_in_order(roles, order: list[str] = LOAD_ORDER) -> DataFrame:
    """S3: append every raw entity to a bronze parquet folder, dimensions first;
    returns (load_seq, table_name, n_rows) read back from what was written."""
    spark = roles.spark
    base = scratch_dir(spark, "bronze")
    counts = []
    for seq, name in enumerate(order, start=1):
        path = f"{base}/{name}"
        role_frame(roles, name).select(*RAW_SCHEMAS[name].fieldNames()).write.mode("append").parquet(path)
        counts.append(spark.read.parquet(path).agg(F.count("*").alias("n_rows"))
                      .select(F.lit(seq).alias("load_seq"), F.lit(name).alias("table_name"), "n_rows"))
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def append_twice(roles, name: str = "sale") -> DataFrame:
    """S3 on an existing target: the entity in two appends, even and odd keys,
    read back as one table."""
    spark = roles.spark
    path = f"{scratch_dir(spark, 'append')}/{name}"
    fields = RAW_SCHEMAS[name].fieldNames()
    rows = role_frame(roles, name).select(*fields)
    for half in (0, 1):
        rows.where(F.col(fields[0]) % 2 == half).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def rebuild_twice(df: DataFrame, name: str, partition_by: list[str]) -> DataFrame:
    """The mart written, and written again over what is there; the second
    run replaces the first, so every row comes once."""
    path = scratch_dir(df.sparkSession, f"mart-{name}")
    for _ in range(2):
        write_mart(df, path, partition_by)
    return df.sparkSession.read.parquet(path).select(*df.columns)


def write_mart(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrites ``path``.  Rows of a partition value are brought together
    first (and large values split), so a folder gets few files."""
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def refresh_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replaces the partition values that ``df`` holds and leaves all others as
    they are: a late period rewrites its own folder only."""
    (df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``df`` as a table of the catalog in ``buckets`` files by ``key``, sorted
    within each, in the shared folder.  Joins and groupings of such tables on
    their key need no exchange, and joins no sort.  Give tables that meet the
    same number of buckets, some 256 MB of the largest each."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", scratch_dir(spark, f"bucketed-{name}")).saveAsTable(table))
    return spark.table(table)


def restate_year(df: DataFrame, name: str, year: int, column: str) -> DataFrame:
    """S8 for one period: the mart by year, then one year restated (``column``
    doubled) in a refresh of its own, read back whole."""
    path = scratch_dir(df.sparkSession, f"mart-{name}")
    write_mart(df, path, ["year"])
    late = df.where(F.col("year") == year).withColumn(column, F.col(column) * 2)
    refresh_partitions(late, path, ["year"])
    return df.sparkSession.read.parquet(path).select(*df.columns)


def define_views(spark: SparkSession, views: dict[str, DataFrame]) -> list[str]:
    """Temporary views in the order given (dependencies first); a view that
    exists is replaced."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Overwrite a mart as parquet (optionally partitioned) and read it back."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"mart-{name}")
    write_mart(df, path, partition_by)
    back = spark.read.parquet(path)
    return back.select(*df.columns)


# The columns that the feature source has, whichever way it comes.
FEATURE_COLUMNS = ["sale_date", "product_id", "product_name", "product_kind", "demand", "revenue", "mean_price"]


def features_source(spark: SparkSession, table: str | None, rebuild) -> DataFrame:
    """The feature mart if the catalog has it, else rebuilt from raw."""
    df = spark.table(table) if table and spark.catalog.tableExists(table) else rebuild()
    return df.select(*FEATURE_COLUMNS)
