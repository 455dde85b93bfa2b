"""Profiling and validation (DQ1–DQ14): each is a filter, a grouped count or one
aggregation pass; reports come out in long form (``stack`` / ``unionByName``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradecast.functions.text import clean_name
from tradecast.operators.clean import MOVEMENT_KEY, product_price_means

# Spellings the country-variant probe looks for.
USA_VARIANTS = ["USA", "U.S.A.", "ESTADOS UNIDOS"]


def padded_names(customer_raw: DataFrame) -> DataFrame:
    return (customer_raw.where(F.col("name") != F.trim("name"))
            .select("customer_id", "name", F.length("name").alias("name_length")))


def padded_kinds(customer_raw: DataFrame) -> DataFrame:
    return (customer_raw.where(F.col("kind") != F.trim("kind"))
            .select("customer_id", "kind", F.length("kind").alias("kind_length")))


def upper_names(customer_raw: DataFrame) -> DataFrame:
    return customer_raw.where(F.col("name") == F.upper("name")).select("customer_id", "name")


def lower_names(customer_raw: DataFrame) -> DataFrame:
    return customer_raw.where(F.col("name") == F.lower("name")).select("customer_id", "name")


def country_variants(customer_raw: DataFrame) -> DataFrame:
    return (customer_raw.where(F.trim(F.upper("country")).isin(USA_VARIANTS))
            .select("country").distinct())


def duplicate_names(customer_raw: DataFrame, normalised: bool = False) -> DataFrame:
    """Names used more than once; ``normalised`` groups on INITCAP(TRIM(name))
    (the raw grouping misses case/blank variants)."""
    key = clean_name("name") if normalised else F.col("name")
    return (customer_raw.groupBy(key.alias("name")).agg(F.count("*").alias("repetitions"))
            .where(F.col("repetitions") > 1))


def null_prices(sale_raw: DataFrame) -> DataFrame:
    return (sale_raw.where(F.col("unit_price").isNull())
            .select("sale_id", "customer_id", "product_id", "units",
                    F.col("unit_price").cast("double").alias("unit_price")))


def group_means(sale_raw: DataFrame) -> DataFrame:
    """Mean of the available prices per product (exact sum / count)."""
    return product_price_means(sale_raw).select(
        "product_id", ((F.col("price_milli_sum") / F.lit(1000.0)) / F.col("price_n")).alias("mean_price"))


def imputable(sale_raw: DataFrame) -> DataFrame:
    return (sale_raw.where(F.col("unit_price").isNull()).select("sale_id", "product_id")
            .join(group_means(sale_raw), "product_id", "left")
            .select("sale_id", "product_id", "mean_price"))


def unimputable(sale_raw: DataFrame) -> DataFrame:
    return imputable(sale_raw).where(F.col("mean_price").isNull())


def _metrics(df: DataFrame, **counts) -> DataFrame:
    """One pass over ``df``: a row (metric, value) for each counting expression."""
    names = list(counts)
    pairs = ", ".join(f"'{n}', {n}" for n in names)
    return (df.agg(*[c.cast("long").alias(n) for n, c in counts.items()])
            .selectExpr(f"stack({len(names)}, {pairs}) AS (metric, value)"))


def cleaning_counts(roles, cleaned) -> DataFrame:
    """Before/after report, one row per metric; every table is read once."""
    rows = F.count("*")
    parts = [
        _metrics(roles.customer_raw, customers_raw=rows),
        _metrics(cleaned.customer, customers_clean=rows),
        _metrics(roles.sale_raw, sales_raw=rows, sales_null_price_raw=F.count_if(F.col("unit_price").isNull())),
        _metrics(cleaned.sales, sales_clean=rows, sales_null_price_clean=F.count_if(F.col("unit_price").isNull()),
                 sales_without_customer=F.count_if(F.col("customer_id").isNull())),
        _metrics(roles.movement_raw, movements_raw=rows),
        _metrics(cleaned.movements, movements_clean=rows),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def residual_duplicates(movements_clean: DataFrame) -> DataFrame:
    return (movements_clean.groupBy(*MOVEMENT_KEY).agg(F.count("*").alias("repetitions"))
            .where(F.col("repetitions") > 1))


def residual_logical(customer_clean: DataFrame) -> DataFrame:
    return duplicate_names(customer_clean, normalised=True)


def column_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per column: type, nulls, % null, distinct values.  Exact: each column is
    read alone and counted by value, with a map-side combine, so the rows are
    never multiplied by the columns.  ``approx``: one pass of HyperLogLog++
    sketches over all of them."""
    out = None
    dtypes = dict(df.dtypes)
    if approx:
        pairs = ", ".join(f"'{c}', '{dtypes[c]}', n{i}, d{i}" for i, c in enumerate(df.columns))
        out = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)],
                     *[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(df.columns)]).selectExpr(
            "_n", f"stack({len(df.columns)}, {pairs}) AS (column_name, data_type, null_count, distinct_count)")
    else:
        for c in df.columns:
            x = F.col("_x")
            one = df.groupBy(F.col(c).alias("_x")).agg(F.count("*").alias("_c")).agg(
                F.sum("_c").alias("_n"), F.coalesce(F.sum(F.when(x.isNull(), F.col("_c"))), F.lit(0)).alias("null_count"),
                F.count("_x").alias("distinct_count")).select(
                "_n", F.lit(c).alias("column_name"), F.lit(dtypes[c]).alias("data_type"), "null_count", "distinct_count")
            out = one if out is None else out.unionByName(one)
    return out.select("column_name", "data_type", F.col("null_count").cast("long"),
                      (F.col("null_count") * 100 / F.col("_n")).alias("null_pct"), F.col("distinct_count").cast("long"))


PROFILE_LG_K = 14  # log2 of a sketch's registers: some 16 KB at most, whatever the rows


def distinct_error(lg_k: int = PROFILE_LG_K) -> float:
    """Three standard errors of a union of sketches, as a share of the count."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def profile_sketches(df: DataFrame, period: str, lg_k: int = PROFILE_LG_K) -> DataFrame:
    """One row per value of ``period`` and column: its type, ``n_rows``,
    ``null_count`` and ``sketch``, a HyperLogLog sketch of the values.  One pass
    with a map-side combine.  A period that changes is sketched anew by itself
    (``refresh_partitions``); the others are not read again."""
    dtypes = dict(df.dtypes)
    cols = df.columns
    pairs = ", ".join(f"'{c}', '{dtypes[c]}', n{i}, s{i}" for i, c in enumerate(cols))
    per = df.groupBy(F.col(period).alias("_period")).agg(
        F.count("*").alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)],
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(f"s{i}") for i, c in enumerate(cols)])
    return per.selectExpr("_period AS period", "n_rows", f"stack({len(cols)}, {pairs}) AS (column_name, data_type, null_count, sketch)")


def merged_profile(sketches: DataFrame) -> DataFrame:
    """The profile of all periods from their sketches: the columns of
    ``column_profile``, ``distinct_count`` within ``distinct_error``."""
    return sketches.groupBy("column_name", "data_type").agg(
        F.sum("n_rows").alias("_n"), F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_count")).select(
        "column_name", "data_type", F.col("null_count").cast("long"),
        (F.col("null_count") * 100 / F.col("_n")).alias("null_pct"), F.col("distinct_count").cast("long"))


def profile_error(merged: DataFrame, exact: DataFrame, lg_k: int = PROFILE_LG_K) -> DataFrame:
    """The merged profile, and whether its distinct counts are within the error
    of the exact ones."""
    true = exact.select("column_name", F.col("distinct_count").alias("_true"))
    return merged.join(true, "column_name").select(
        "column_name", "data_type", "null_count", "null_pct",
        (F.abs(F.col("distinct_count") - F.col("_true")) <= F.ceil(F.col("_true") * distinct_error(lg_k))).alias("within_error"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n_rows"))
