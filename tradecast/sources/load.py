"""Loading raw entities under their contract (S3 with C7-C12), and scans that
keep malformed lines (S1).

A load writes an entity once: each row with the rules that it breaks, in the
folder of the accepted or of the quarantined rows.  Counts are observed by the
same job.  Parents are loaded first, and a key refers to the accepted rows of
its parent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradecast.operators.contracts import SPECS, TableSpec
from tradecast.sources.io import CSV_WRITE, LOAD_ORDER, RAW_SCHEMAS

CORRUPT = "_corrupt_record"
NULL_SPREAD = 1 << 16  # parts that rows without a foreign key are dealt to


def row_rules(s: TableSpec) -> list[tuple[str, Column]]:
    """(name, whether a row breaks it) of the rules that a row shows by itself."""
    out = [(f"not_null:{c}", F.col(c).isNull()) for c in s.not_null]
    out += [(f"domain:{c}", ~F.col(c).isin(v)) for c, v in s.domain.items()]
    out += [(f"positive:{c}", F.col(c) <= 0) for c in s.positive]
    out += [(f"width:{c}", F.length(c) > n) for c, n in s.width.items()]
    out += [(f"decimal:{c}", F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{k})").isNull()) for c, (p, k) in s.decimal_fit.items()]
    return out


def checked(rows: DataFrame, s: TableSpec, parents: dict[str, DataFrame], loaded: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``broken``, the names of the rules that a row breaks.

    Of rows that share a unique key the first, in the order of all columns, may
    stay; none may if the key is in ``loaded``.  Null keys clash with none, and a
    null foreign key passes."""
    rules = row_rules(s)
    fields = rows.columns
    for i, key in enumerate(s.unique):
        known = F.lit(True)
        for c in key:
            known &= F.col(c).isNotNull()
        order = Window.partitionBy(*key).orderBy(*[c for c in fields if c not in key] or [F.lit(1)])
        rows = rows.withColumn(f"_again_{i}", known & (F.row_number().over(order) > 1))
        if loaded is not None:
            rows = rows.join(loaded.select(*key).distinct().withColumn(f"_have_{i}", F.lit(True)), key, "left")
            rows = rows.withColumn(f"_again_{i}", F.col(f"_again_{i}") | F.col(f"_have_{i}").isNotNull())
        rules.append((f"unique:{','.join(key)}", F.col(f"_again_{i}")))
    for i, (c, (parent, key)) in enumerate(s.fk.items()):
        # 0 as the optimizer can't see: of a literal it would make a plain condition, no key
        nought = F.pmod(F.xxhash64(c), F.lit(1)).cast("int")
        have = parents[parent].select(F.col(key).alias(c)).distinct().withColumns({"_part": nought, f"_parent_{i}": F.lit(True)})
        # null keys meet no parent; without a second key all of them would lie in one task
        part = F.when(F.col(c).isNull(), F.pmod(F.xxhash64(*fields), F.lit(NULL_SPREAD)).cast("int") + 1).otherwise(F.lit(0))
        rows = rows.withColumn("_part", part).join(have, [c, "_part"], "left").drop("_part")
        rules.append((f"foreign_key:{c}", F.col(c).isNotNull() & F.col(f"_parent_{i}").isNull()))
    broken = F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules]))
    return rows.select(*fields, broken.alias("broken"))


def accepted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("status = 'accepted'").drop("status", "broken")


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("status = 'quarantined'").drop("status")


def load_entity(rows: DataFrame, s: TableSpec, path: str, parents: dict[str, DataFrame], append: bool = False) -> dict:
    """Writes ``rows`` to ``path``; one scan of ``rows``.  Returns the observed
    counts ``n_loaded`` and ``n_quarantined``."""
    spark = rows.sparkSession
    done = checked(rows, s, parents, accepted(spark, path) if append else None)
    seen = Observation()
    bad = F.size("broken") > 0
    done = done.withColumn("status", F.when(bad, "quarantined").otherwise("accepted")).observe(
        seen, F.count_if(~bad).alias("n_loaded"), F.count_if(bad).alias("n_quarantined"))
    done.write.mode("append").partitionBy("status").parquet(path)
    return seen.get


def load_all(spark: SparkSession, frames: dict[str, DataFrame], base: str, specs: dict[str, TableSpec] = SPECS) -> DataFrame:
    """Loads all entities, parents first: load_seq, table_name, n_loaded,
    n_quarantined."""
    rows, parents = [], {}
    for seq, name in enumerate((n for n in LOAD_ORDER if n in frames), start=1):
        fields = RAW_SCHEMAS[name].fieldNames()
        counts = load_entity(frames[name].select(*fields), specs[name], f"{base}/{name}", parents)
        parents[name] = accepted(spark, f"{base}/{name}")
        rows.append((seq, name, counts["n_loaded"], counts["n_quarantined"]))
    return spark.createDataFrame(rows, "load_seq int, table_name string, n_loaded long, n_quarantined long")


def read_csv_permissive(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Header CSV with the declared schema; a malformed row comes with its text in
    ``_corrupt_record``, a good one with null there."""
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in RAW_SCHEMAS[name].fields], T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("emptyValue", "").csv(path))


def permissive_roundtrip(sales: DataFrame, path: str, every: int = 97) -> DataFrame:
    """Sales written as CSV with the units of every so many orders spelt out, and
    scanned permissively: ``status``, ``n_rows``, ``units`` by status and the
    number of lines whose text is there (``n_texts``)."""
    spoilt = F.col("order_id") % every == 0
    fields = RAW_SCHEMAS["sale"].fieldNames()
    text = sales.select(*[F.when(spoilt, "none").otherwise(F.col(c).cast("string")).alias(c) if c == "units" else c for c in fields])
    text.write.mode("overwrite").options(**CSV_WRITE).csv(path)
    back = read_csv_permissive(sales.sparkSession, path, "sale")
    status = F.when(F.col(CORRUPT).isNull(), "good").otherwise("malformed")
    return back.groupBy(status.alias("status")).agg(
        F.count("*").alias("n_rows"), F.coalesce(F.sum("units"), F.lit(0)).cast("long").alias("units"),
        F.count_if(F.col(CORRUPT).contains(",none,")).alias("n_texts"))
