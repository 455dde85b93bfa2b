"""Incremental raw-file ingest with Structured Streaming (the append load, S3).

New CSV files landing in a folder are appended to a bronze parquet table by a
file-source stream with ``trigger(availableNow=True)``: each run processes
exactly the files not yet seen (tracked in the checkpoint), then stops.  The
checkpoint and the table live in the shared folder, so a lost executor or a
restarted driver resumes where it stopped without duplicating rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradecast.sources.io import RAW_SCHEMAS, role_frame, write_csv
from tradecast.session import scratch_dir


def ingest_csv(spark: SparkSession, name: str, landing: str, table: str, checkpoint: str,
               max_files_per_trigger: int | None = None) -> None:
    """Append every not-yet-ingested CSV file of entity ``name`` to ``table``."""
    reader = (spark.readStream.schema(RAW_SCHEMAS[name]).option("header", True)
              .option("mode", "FAILFAST"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(landing)
    q = (stream.writeStream.format("parquet").option("path", table)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def ingest_role(roles, name: str = "sale") -> DataFrame:
    """Land a raw entity as CSV files, ingest them with the stream, read the table."""
    spark = roles.spark
    base = scratch_dir(spark, f"stream-{name}")
    landing, table, ckpt = f"{base}/landing", f"{base}/bronze", f"{base}/_checkpoint"
    write_csv(role_frame(roles, name).select(*RAW_SCHEMAS[name].fieldNames()), landing)
    ingest_csv(spark, name, landing, table, ckpt)
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(table)
