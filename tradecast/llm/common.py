"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradecast.session import scratch_dir

#: A word is a maximal run of characters outside these six ASCII blanks.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds`` (a null id counts as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder in the shared checkpoint folder and read
    it back: cuts the lineage, and survives the loss of executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ROWS_AT_ONCE = 500     # texts turned to Python strings at a time
BYTES_AT_ONCE = "4m"  # of rows that a task sends to Python at a time


def short_batches(spark: SparkSession) -> None:
    """Bounds the bytes of the Arrow batches that tasks send to Python, unless the
    session already has a bound.  Spark's own is 10,000 rows or 64 MB, which the
    executor holds outside its heap, once more while a buffer grows, and Python again."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, BYTES_AT_ONCE)


def map_texts(docs: DataFrame, new: dict[str, T.DataType], start: Callable[[], Callable[[list], list]], keep_text: bool = True) -> DataFrame:
    """Adds the columns ``new`` to the rows of ``docs``, computed from ``text``
    in Python.  ``start`` is called once in a task and gives the function from a
    list of texts to a list of values for each new column.  Other columns pass
    through as Arrow arrays, untouched; those named like a new one go."""
    short_batches(docs.sparkSession)
    docs = docs.drop(*new)
    kept = docs if keep_text else docs.drop("text")
    names, schema = kept.columns, T.StructType([*kept.schema.fields, *(T.StructField(k, v) for k, v in new.items())])
    kinds = [_ARROW[v.simpleString()] for v in new.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = start()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(at, ROWS_AT_ONCE)
                values = f(b.column("text").to_pylist())
                arrays = [b.column(n) for n in names] + [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, *new])

    return docs.mapInArrow(run, schema)


_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(),
          "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}


def small_table(spark: SparkSession, rows: list[tuple], fields: str) -> DataFrame:
    """A table of a few rows of the driver, by way of Arrow.  A list would pass
    through Python workers of another kind, which then stay beside those that
    hold the models."""
    schema = T.StructType.fromDDL(fields)
    if not rows:
        return spark.createDataFrame([], schema)
    columns = [pa.array(v, _ARROW[f.dataType.simpleString()]) for v, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return spark.createDataFrame(pa.table(columns, names=schema.names), schema)


def shielded(docs: DataFrame, used: tuple[str, ...]) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``docs`` with all columns but ``used`` under names that clash with none,
    and the way back to the columns and names of ``docs``, and further columns."""
    names = docs.columns
    alias = {c: c if c in used else f"_column_{i}" for i, c in enumerate(names)}
    out = docs.toDF(*[alias[c] for c in names])
    return out, lambda df, *more: df.select(*[F.col(alias[c]).alias(c) for c in names], *more)


def ordered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` in a total order, written to the shared folder with ``_pid`` (the
    range it fell in; ranges follow the order) and ``_idx`` (gapless position
    within that range).

    Ranges split groups of equal leading keys when later keys differ, so one
    hot key never has to fit into one task.  The numbering is read back from
    the written table: a retried task cannot change it.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # upper 31 bits: partition; lower 33 bits: row within the partition
    ranged = ranged.withColumn("_mid", F.monotonically_increasing_id())
    return saved(ranged, name).withColumns({
        "_pid": F.shiftright("_mid", 33).cast("int"),
        "_idx": F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)),
    }).drop("_mid")


def range_offsets(df: DataFrame, value: Column) -> list[tuple[int, int]]:
    """(range, sum of ``value`` over all earlier ranges) of an ``ordered``
    table; one row per range, so as long as the number of partitions."""
    sums = df.groupBy("_pid").agg(F.sum(value).alias("v")).orderBy("_pid").collect()
    out, before = [], 0
    for r in sums:
        out.append((r["_pid"], before))
        before += r["v"] or 0
    return out


def with_global_index(df: DataFrame, alias: str) -> DataFrame:
    """Adds the 0-based position of each row in the order of ``ordered``."""
    offsets = range_offsets(df, F.lit(1))
    spark = df.sparkSession
    off = small_table(spark, offsets, "_pid int, _before long")
    return (df.join(F.broadcast(off), "_pid")  # one row per partition of the range shuffle
            .withColumn(alias, F.col("_before") + F.col("_idx")).drop("_before"))
