"""Query registry: key -> callable(spark, sf_dir) -> DataFrame, and key -> oracle SQL.

Every callable reads the driver tables under ``sf_dir`` through the session's
medallion store (bronze entities, silver tables, shared gold marts), which is
written once per Spark application into the shared checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradecast import streaming as ST
from tradecast.operators import clean as CL
from tradecast.operators import contracts as CT
from tradecast.operators import profile as PR
from tradecast.operators.clean import Cleaned
from tradecast.plans import expressions as X
from tradecast.plans import forecast as M
from tradecast.plans import marts as G
from tradecast.plans import measures as B
from tradecast.plans import questions as Q
from tradecast.plans import timeseries as TS
from tradecast.plans.params import PER_PRODUCT
from tradecast.session import scratch_dir, shuffle_for


def _models():
    """MLlib plans, imported on first use (pulls in pyspark.ml)."""
    from tradecast.plans import models
    return models


_SILVER: dict[tuple[str, str], Cleaned] = {}
_BUCKETED: dict = {}


def cleaned(spark: SparkSession, sf_dir: str) -> Cleaned:
    """The silver layer for ``sf_dir``, written once per Spark application into
    the shared checkpoint folder and reused by every query."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SILVER:
        from tradecast.sources.roles import Roles
        roles = Roles(spark, sf_dir, store=scratch_dir(spark, "bronze"))
        shuffle_for(spark, roles.t("lineitem").count())
        _SILVER[key] = Cleaned(roles, store=scratch_dir(spark, "silver"))
    return _SILVER[key]


def refresh(spark: SparkSession, sf_dir: str) -> None:
    """Forget the layers written for ``sf_dir``: the next query reads the
    sources anew.  Call it when files under ``sf_dir`` have changed."""
    for layer in (_SILVER, _BUCKETED):
        layer.pop((spark.sparkContext.applicationId, sf_dir), None)


def _r(fn):
    """Adapt ``fn(Roles)`` to ``(spark, sf_dir)`` (the session's bronze entities)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(cleaned(spark, sf_dir).roles)
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def _rc(fn):
    """Adapt ``fn(Roles, Cleaned)`` to ``(spark, sf_dir)``."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        c = cleaned(spark, sf_dir)
        return fn(c.roles, c)
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def _c(fn):
    """Adapt ``fn(Cleaned)`` to ``(spark, sf_dir)``."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(cleaned(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _question_queries() -> dict[str, Callable]:
    return {
        "q01_volume_by_product": _c(Q.q01_volume_by_product),
        "q02_value_by_product": _c(Q.q02_value_by_product),
        "q03_output_by_site": _c(Q.q03_output_by_site),
        "q04_yield_per_area_top": _c(Q.q04_yield_per_area_top),
        "q04b_yield_per_area_ranked": _c(Q.q04b_yield_per_area_ranked),
        "q05_waste_by_product": _c(Q.q05_waste_by_product),
        "q06_waste_pct": _c(Q.q06_waste_pct),
        "q07_lapsed_customers": _c(Q.q07_lapsed_customers),
        "q07b_lapsed_except": _c(Q.q07b_lapsed_except),
        "q08_value_by_customer": _c(Q.q08_value_by_customer),
        "q09_price_by_customer_kind": _c(Q.q09_price_by_customer_kind),
        "q10_season_weekly_mean": _c(Q.q10_season_weekly_mean),
        "q11_monthly_trend": _c(Q.q11_monthly_trend),
        "q12_quarterly_trend": _c(Q.q12_quarterly_trend),
        "q13_quarter_delta": _c(Q.q13_quarter_delta),
        "q14_season_pivot": _c(Q.q14_season_pivot),
        "q15_rfm_basic": _c(Q.q15_rfm_basic),
    }


def _mart_queries() -> dict[str, Callable]:
    return {
        "g1_sales_monthly": _c(G.g1_sales_monthly),
        "g2_customer_rfm": _c(G.g2_customer_rfm),
        "g3_site_yield": _c(G.g3_site_yield),
        "g4_weekly_season": _c(G.g4_weekly_season),
        "g4b_weekly_season_isoyear": _c(lambda c: G.g4_weekly_season(c, iso_year=True)),
        "g5_demand_features": _c(G.g5_demand_features),
    }


def _dbl(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def _features_from_mart(c: Cleaned) -> DataFrame:
    """S5, the branch that finds the mart: a table of the catalog."""
    from tradecast.sources import io as IO
    name = f"features_{uuid.uuid4().hex[:12]}"
    spark = c.roles.spark
    path = scratch_dir(spark, name)
    IO.write_mart(G.g5_demand_features(c), path)
    spark.read.parquet(path).createOrReplaceTempView(name)
    return IO.features_source(spark, name, lambda: G.features_from_raw(c.roles))


def _views_in_order(c: Cleaned) -> DataFrame:
    """The layers as views, each over those that it reads, asked through SQL."""
    from tradecast.sources import views as V
    spark, prefix = c.roles.spark, f"v{uuid.uuid4().hex[:12]}_"
    V.create_views(spark, c.roles, prefix, ["sales", "product"])
    out = spark.sql(
        f"SELECT p.kind, v.u FROM (SELECT product_id, sum(units) AS u FROM {prefix}sales GROUP BY product_id) v "
        f"JOIN {prefix}product p USING (product_id)").groupBy(F.col("kind").alias("product_kind")).agg(F.sum("u").alias("total_units"))
    V.drop_views(spark, prefix)
    return out


def _view_catalogue(c: Cleaned) -> DataFrame:
    """All sixteen views, one count of each."""
    from tradecast.sources import views as V
    spark, prefix = c.roles.spark, f"v{uuid.uuid4().hex[:12]}_"
    names = V.create_views(spark, c.roles, prefix)
    sql = " UNION ALL ".join(f"SELECT '{n.removeprefix(prefix)}' AS view_name, count(*) AS n_rows FROM {n}" for n in names)
    out = spark.sql(sql)
    V.drop_views(spark, prefix)
    return out


def _bucketed(name: str):
    """An entity that joins the order facts, off bronze tables bucketed by
    order key; written once for each application and source folder."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from tradecast.sources.roles import Roles
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _BUCKETED:
            _BUCKETED[key] = Roles(spark, sf_dir, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
        return getattr(_BUCKETED[key], name)
    return run


def _profile_merged(c: Cleaned) -> DataFrame:
    """DQ13, mergeable: sketches by year, written; one year sketched anew in its
    own folder; all merged, and held against the exact profile."""
    from tradecast.sources import io as IO
    features = G.g5_demand_features(c)
    dated = features.withColumn("_year", F.year("sale_date"))
    path = scratch_dir(c.roles.spark, "profile-sketches")
    fields = features.columns

    def sketches(rows: DataFrame) -> DataFrame:
        return PR.profile_sketches(rows, "_year").where(F.col("column_name").isin(fields))

    IO.write_mart(sketches(dated), path, ["period"])
    IO.refresh_partitions(sketches(dated.where("_year = 1997")), path, ["period"])
    return PR.profile_error(PR.merged_profile(c.roles.spark.read.parquet(path)), PR.column_profile(features))


def _load_enforced(r) -> DataFrame:
    from tradecast.sources import io as IO
    from tradecast.sources import load as LD
    # names of these parts repeat, so the id alone is their key
    specs = {**CT.SPECS, "product": replace(CT.SPECS["product"], unique=[["product_id"]])}
    return LD.load_all(r.spark, {n: IO.role_frame(r, n) for n in IO.LOAD_ORDER}, scratch_dir(r.spark, "enforced"), specs)


def _permissive(r) -> DataFrame:
    from tradecast.sources import load as LD
    return LD.permissive_roundtrip(r.sale_raw, scratch_dir(r.spark, "csv-permissive"))


def _quality_queries() -> dict[str, Callable]:
    from tradecast.sources import io as IO
    return {
        "clean_customer_map": _c(lambda c: c.customer_map),
        "clean_customer_dim": _c(lambda c: c.customer),
        "clean_customer_dim_basic": _r(lambda r: CL.customer_dim_basic(r.customer_raw)),
        "clean_dims": _c(lambda c: _dbl(c.site, "area")),
        "clean_dims_product": _c(lambda c: c.product),
        "clean_dims_store_room": _c(lambda c: _dbl(c.store_room, "target_temp")),
        "clean_dims_carrier": _c(lambda c: c.carrier),
        "clean_dims_forwarder": _c(lambda c: c.forwarder),
        "clean_shipments": _c(lambda c: _dbl(c.shipments, "weight")),
        "clean_sales": _c(lambda c: _dbl(c.sales, "unit_price", "value_total")),
        "clean_movements_dedup": _c(lambda c: c.movements),
        "contract_not_null": _r(lambda r: CT.not_null(CT.role_tables(r))),
        "contract_domain": _r(lambda r: CT.domain(CT.role_tables(r))),
        "contract_range": _r(lambda r: CT.positive(CT.role_tables(r))),
        "contract_unique": _r(lambda r: CT.unique(CT.role_tables(r))),
        "contract_fk": _r(lambda r: CT.foreign_keys(CT.role_tables(r))),
        "contract_width": _r(lambda r: CT.width(CT.role_tables(r))),
        "dq_padded": _r(lambda r: PR.padded_names(r.customer_raw)),
        "dq_padded_kind": _r(lambda r: PR.padded_kinds(r.customer_raw)),
        "dq_upper": _r(lambda r: PR.upper_names(r.customer_raw)),
        "dq_lower": _r(lambda r: PR.lower_names(r.customer_raw)),
        "dq_variants": _r(lambda r: PR.country_variants(r.customer_raw)),
        "dq_dup_names": _r(lambda r: PR.duplicate_names(r.customer_raw)),
        "dq_dup_names_normalised": _r(lambda r: PR.duplicate_names(r.customer_raw, normalised=True)),
        "dq_null_price": _r(lambda r: PR.null_prices(r.sale_raw)),
        "dq_group_mean": _r(lambda r: PR.group_means(r.sale_raw)),
        "dq_imputable": _r(lambda r: PR.imputable(r.sale_raw)),
        "dq_unimputable": _r(lambda r: PR.unimputable(r.sale_raw)),
        "dq_counts": _rc(PR.cleaning_counts),
        "dq_residual_dups": _c(lambda c: PR.residual_duplicates(c.movements)),
        "dq_residual_logical": _c(lambda c: PR.residual_logical(c.customer)),
        "dq_profile": _c(lambda c: PR.column_profile(G.g5_demand_features(c))),
        "dq_profile_merged": _c(_profile_merged),
        "bucketed_sales": _bucketed("sale_raw"),
        "bucketed_production": _bucketed("production"),
        "dq_value_counts": _c(lambda c: PR.value_counts(G.g5_demand_features(c), "product_kind")),
        "fn_strings": _r(X.fn_strings),
        "fn_initcap": _r(X.fn_initcap),
        "fn_dates": _r(X.fn_dates),
        "fn_week_end": _r(X.fn_week_end),
        "fn_weeknum": _r(X.fn_weeknum),
        "fn_festivals": _r(X.fn_festivals),
        "fn_round": _r(X.fn_round),
        "src_csv": _r(lambda r: IO.csv_roundtrip(r, "sale")),
        **{f"src_csv_{n}": _r(lambda r, n=n: _dbl(IO.csv_roundtrip(r, n), "area", "target_temp", "unit_price", "weight"))
           for n in IO.LOAD_ORDER if n != "sale"},
        "load_append_twice": _r(IO.append_twice),
        "load_order": _r(IO.load_in_order),
        "load_stream": _r(lambda r: ST.ingest_role(r, "sale")),
        "scan_features": _c(lambda c: G.g5_demand_features(c).orderBy("sale_date", "product_id")),
        "features_rebuild": _r(lambda r: IO.features_source(r.spark, None, lambda: G.features_from_raw(r))),
        "features_from_mart": _c(_features_from_mart),
        "views_in_order": _c(_views_in_order),
        "view_catalogue": _c(_view_catalogue),
        "load_enforced": _r(_load_enforced),
        "src_csv_permissive": _r(_permissive),
        "mart_refresh_year": _c(lambda c: IO.restate_year(G.g1_sales_monthly(c), "sales_monthly", 1997, "total_units")),
        "mart_roundtrip": _c(lambda c: IO.materialise(G.g1_sales_monthly(c), "sales_monthly", ["year"])),
        "mart_rebuild_twice": _c(lambda c: IO.rebuild_twice(G.g1_sales_monthly(c), "sales_monthly", ["year"])),
        "mart_roundtrip_rfm": _c(lambda c: IO.materialise(G.g2_customer_rfm(c), "customer_rfm", ["segment"])),
        "mart_roundtrip_yield": _c(lambda c: IO.materialise(G.g3_site_yield(c), "site_yield")),
        "mart_roundtrip_season": _c(lambda c: IO.materialise(G.g4_weekly_season(c), "weekly_season", ["year"])),
        "mart_roundtrip_features": _c(lambda c: IO.materialise(G.g5_demand_features(c), "features", ["month"])),
    }


def _measure_queries() -> dict[str, Callable]:
    names = ["b1_calendar", "b2_year_week_bridge", "b3_total_sales", "b4_total_units", "b5_weighted_price",
             "b6_prior_year", "b7_yoy_growth", "b8_mom_growth", "b9_sales_by_product", "b9_sales_by_country",
             "b9_sales_by_month", "b10_date_hierarchy"]
    out = {n: _c(getattr(B, n)) for n in names}
    out["measures_country_year"] = _c(lambda c: B.measures(c, ["country"], "year"))
    out["measures_kind_month"] = _c(lambda c: B.measures(c, ["product_kind"], "month"))
    out["measures_filtered"] = _c(lambda c: B.measures(c, ["customer_kind"], "year", {
        "country": ["USA", "France"], "product_kind": ["SMALL", "LARGE"], "year": [1999, 2000]}))
    return out


def _series_queries() -> dict[str, Callable]:
    return {
        "t1_daily_global": _c(TS.t1_daily_global),
        "t1_daily_dense": _c(TS.t1_daily_dense),
        "t2_weekly_global": _c(TS.t2_weekly_global),
        "t2_weekly_product": _c(TS.t2_weekly_product),
        "t3_dense_panel": _c(TS.t3_dense_panel),
        "t3_dense_panel_by_product": _c(lambda c: TS.t3_dense_panel(c, "product_id")),
        "e1_rolling8": _c(TS.e1_rolling8),
        "e2_adf": _c(TS.e2_adf),
        "e2_adf_by_series": _c(lambda c: TS.e2_adf(c, "product_color")),
        "e3_decompose": _c(TS.e3_decompose),
        "e4_acf": _c(TS.e4_acf),
        "e4_pacf": _c(TS.e4_pacf),
        "e5_product_share_top15": _c(TS.e5_product_share_top),
        "m1_festival_calendar": _c(M.m1_festival_calendar),
        "m2_direct_features": _c(M.m2_direct_features),
        "m2_direct_features_by_product": _c(lambda c: M.m2_direct_features(c, PER_PRODUCT)),
        "m2_feature_sums": _c(M.m2_feature_sums),
        "m2_feature_sums_by_product": _c(lambda c: M.m2_feature_sums(c, PER_PRODUCT)),
        **{f"{f.__name__}_by_product": _c(lambda c, f=f: f(c, PER_PRODUCT)) for f in (
            M.m4_time_split, M.m9_metrics_global, M.m10_metrics_h12, M.m11_h12_curve, M.m12_capacity, M.m13_newsvendor)},
        "m3_target_calendar": _c(M.m3_target_calendar),
        "m4_time_split": _c(M.m4_time_split),
        "m5_seasonal_naive": _c(M.m5_seasonal_naive),
        "m6_naive_growth": _c(M.m6_naive_growth),
        "m9_metrics_global": _c(M.m9_metrics_global),
        "m10_metrics_h12": _c(M.m10_metrics_h12),
        "m11_h12_curve": _c(M.m11_h12_curve),
        "m12_capacity": _c(M.m12_capacity),
        "m13_newsvendor": _c(M.m13_newsvendor),
        "m7_gbt_mean": _c(lambda c: _models().m7_gbt_mean(c)),
        "m8_quantile": _c(lambda c: _models().m8_quantile(c)),
        "m9_metrics_all": _c(lambda c: _models().m9_metrics_all(c)),
        "m10_metrics_h12_all": _c(lambda c: _models().m10_metrics_h12_all(c)),
        "m12_capacity_gbt": _c(lambda c: _models().m12_capacity_gbt(c)),
        **{f"{n}_by_product": _c(lambda c, n=n: getattr(_models(), n)(c, PER_PRODUCT)) for n in (
            "m7_gbt_mean", "m8_quantile", "m9_metrics_all", "m10_metrics_h12_all", "m12_capacity_gbt")},
    }


def queries() -> dict[str, Callable]:
    out: dict[str, Callable] = {}
    for part in (_question_queries, _mart_queries, _quality_queries, _measure_queries, _series_queries):
        out.update(part())
    return out


def oracle_sql() -> dict[str, str]:
    from tradecast.oracle import layers as OL
    from tradecast.oracle import marts as OG
    from tradecast.oracle import measures as OB
    from tradecast.oracle import quality as OX
    from tradecast.oracle import questions as OQ
    from tradecast.oracle import series as OS
    out: dict[str, str] = {}
    for part in (OQ.SQL, OG.SQL, OX.SQL, OB.SQL, OS.SQL, OL.SQL):
        out.update(part)
    return out
