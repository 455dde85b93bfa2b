"""Gold marts G1–G5.

Facts are pre-aggregated on their own keys before meeting the dimensions, so
the joins see one row per (period, product, customer) rather than one per sale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradecast.functions import dates as D
from tradecast.functions.numeric import ratio_half_up, ratio_half_up_units, to_cents
from tradecast.operators.clean import Cleaned
from tradecast.plans.questions import rfm_base, rfm_scores

G1_KEYS = ["month", "year", "month_no", "product_id", "product_name", "product_kind",
           "product_color", "country", "customer_kind"]


def g1_exact(c: Cleaned) -> DataFrame:
    """The monthly mart with its value kept as an exact decimal (``_value``).
    Materialised once per session (the measures all read it)."""
    return c.cached("g1_exact", lambda: _g1_exact(c))


def _g1_exact(c: Cleaned) -> DataFrame:
    # Customers come first, so that one narrow row for each row of the mart is
    # shuffled; product attributes, which follow from the id, come last and are
    # no keys of the grouping.
    cust = c.customer.select("customer_id", "country", F.col("kind").alias("customer_kind"))
    mart = (c.sales.select(D.month_start("sale_date").alias("month"), "product_id", "customer_id", "units", "value_total")
            .join(cust, "customer_id").groupBy("month", "product_id", "country", "customer_kind")
            .agg(F.count("*").alias("n"), F.sum("units").alias("u"), F.sum("value_total").alias("v")))
    # a product that is there several times counts as often
    prod = c.product.groupBy("product_id", F.col("name").alias("product_name"), F.col("kind").alias("product_kind"),
                             F.col("color").alias("product_color")).agg(F.count("*").alias("_times"))
    wide, once = "decimal(38,2)", F.col("_times") == 1

    def total(x: str, kind: str) -> F.Column:
        return F.when(once, F.col(x).cast(kind)).otherwise((F.col(x) * F.col("_times")).cast(kind))

    j = mart.join(prod, "product_id").withColumns({"year": F.year("month"), "month_no": F.month("month")})
    return j.select(*G1_KEYS, total("n", "long").alias("n_transactions"), total("u", "long").alias("total_units"),
                    total("v", wide).alias("_value"))


def g1_sales_monthly(c: Cleaned) -> DataFrame:
    """month × product × country × customer kind; weighted price rounded to 3."""
    agg = g1_exact(c)
    return agg.select(*G1_KEYS, "n_transactions", "total_units",
                      F.col("_value").cast("double").alias("total_value"),
                      F.when(F.col("total_units") > 0,
                             ratio_half_up(to_cents("_value"), F.col("total_units"), 3, 2))
                      .alias("weighted_price"))


# G2 segments, first match wins (r, f, m are NTILE(5) scores).
G2_CHAMPIONS = "Campeones (Champions)"
G2_LOYAL = "Clientes Leales (Loyal)"
G2_PROMISING = "Prometedores / Recientes"
G2_AT_RISK = "En Riesgo (At Risk)"
G2_LOST = "Hibernando / Perdidos"
G2_OTHER = "Potenciales / Regulares"


def g2_segment(r, f, m) -> F.Column:
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), F.lit(G2_CHAMPIONS))
            .when((r >= 3) & (f >= 3), F.lit(G2_LOYAL))
            .when((r >= 4) & (f <= 2), F.lit(G2_PROMISING))
            .when((r <= 2) & (f >= 3), F.lit(G2_AT_RISK))
            .when((r <= 2) & (f <= 2), F.lit(G2_LOST))
            .otherwise(F.lit(G2_OTHER)))


def g2_customer_rfm(c: Cleaned, method: str = "distributed") -> DataFrame:
    x = rfm_scores(rfm_base(c, F.col("value_total")), method)
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    seg = x.select("customer_id", "recency_days", "frequency",
                   F.col("_money").cast("double").alias("monetary"),
                   "r_score", "f_score", "m_score", (r + f + m).alias("rfm_total"),
                   g2_segment(r, f, m).alias("segment"))
    cust = c.customer.select("customer_id", F.col("name").alias("customer_name"), "country",
                             F.col("kind").alias("customer_kind"))
    return seg.join(cust, "customer_id").select(
        "customer_id", "customer_name", "country", "customer_kind", "recency_days", "frequency",
        "monetary", "r_score", "f_score", "m_score", "rfm_total", "segment")


def g3_site_yield(c: Cleaned) -> DataFrame:
    prod = (c.production.groupBy("site_id")
            .agg(F.sum("units").alias("harvested_units"), F.count("*").alias("n_harvests")))
    # Waste per harvest first (partial aggregation), then to the site.
    waste_h = (c.movements.where(F.col("move_type") == "waste")
               .groupBy("production_id").agg(F.sum("quantity").alias("w")))
    waste = (waste_h.join(c.production.select("production_id", "site_id"), "production_id")
             .groupBy("site_id").agg(F.sum("w").cast("long").alias("waste_units")))
    s = c.site.select("site_id", "code", "area", "product_name")
    j = prod.join(s, "site_id").join(waste, "site_id", "left")
    waste_units = F.coalesce(F.col("waste_units"), F.lit(0).cast("long"))
    return j.select(
        "site_id", "code", F.col("area").cast("double").alias("area"), "product_name",
        "harvested_units", "n_harvests",
        ratio_half_up(F.col("harvested_units") * 100, (F.col("area") * 100).cast("long"), 0).alias("units_per_area"),
        waste_units.alias("waste_units"),
        F.when(F.col("harvested_units") > 0, ratio_half_up(waste_units * 100, F.col("harvested_units"), 2))
        .alias("waste_pct"))


def g4_weekly_season(c: Cleaned, iso_year: bool = False) -> DataFrame:
    """year × ISO week × season.  ``iso_year=False`` pairs the calendar year with the
    ISO week (as the reference does: 30-Dec-2024 -> (2024, 1)); ``True`` uses the ISO year."""
    yr = D.iso_year("sale_date") if iso_year else F.year("sale_date")
    return (c.sales.groupBy(yr.alias("year"), D.iso_week("sale_date").alias("iso_week"),
                            D.season("sale_date").alias("season"))
            .agg(F.count("*").alias("n_orders"), F.sum("units").alias("total_units"),
                 F.sum("value_total").cast("double").alias("total_value")))


def g5_exact(c: Cleaned) -> DataFrame:
    """day × product: demand, exact revenue (decimal ``_rev``) and the rounded
    mean price in thousandths (long ``_price_milli``), for downstream re-aggregation.
    Materialised with the silver layer when the bundle has a store."""
    return c.cached("g5_exact", lambda: _g5_exact(c))


def _g5_exact(c: Cleaned) -> DataFrame:
    pre = (c.sales.groupBy("sale_date", "product_id")
           .agg(F.sum("units").alias("demand"), F.sum("value_total").alias("_rev"),
                F.sum(to_cents("unit_price")).alias("_pc"), F.count("unit_price").alias("_pn")))
    prod = c.product.select("product_id", F.col("name").alias("product_name"),
                            F.col("kind").alias("product_kind"), F.col("color").alias("product_color"))
    w = D.iso_week("sale_date")
    return pre.join(prod, "product_id").select(
        "sale_date", "product_id", "product_name", "product_kind", "product_color", "demand", "_rev",
        F.when(F.col("_pn") > 0, ratio_half_up_units(F.col("_pc"), F.col("_pn"), 3, 2)).alias("_price_milli"),
        F.when(w.between(*D.PEAK1_WEEKS), 1).otherwise(0).alias("flag_peak1"),
        F.when(w.between(*D.PEAK2_WEEKS), 1).otherwise(0).alias("flag_peak2"))


def g5_demand_features(c: Cleaned) -> DataFrame:
    """day × product demand, revenue, mean price (3), calendar and season flags."""
    g = g5_exact(c)
    sd = F.col("sale_date")
    return g.select(
        "sale_date", "product_id", "product_name", "product_kind", "demand",
        F.col("_rev").cast("double").alias("revenue"),
        (F.col("_price_milli") / F.lit(1000.0)).alias("mean_price"),
        D.iso_dow(sd).alias("day_of_week"), F.month(sd).alias("month"), D.iso_week(sd).alias("iso_week"),
        "flag_peak1", "flag_peak2")


def features_from_raw(roles) -> DataFrame:
    """S5 fallback: the feature mart rebuilt straight from raw sales, as the
    notebook does when the warehouse is down — unrounded mean imputation, raw
    (untrimmed) product attributes, no customer clean-up.  Floating sums are
    rounded to 6 decimals."""
    from tradecast.functions.numeric import round_half_up
    from tradecast.operators.profile import group_means
    s = roles.sale_raw
    priced = (s.join(group_means(s), "product_id", "left")
              .select("sale_date", "product_id", "units",
                      F.coalesce(F.col("unit_price").cast("double"), F.col("mean_price")).alias("price")))
    pre = (priced.groupBy("sale_date", "product_id")
           .agg(F.sum("units").alias("demand"), F.sum(F.col("units") * F.col("price")).alias("_rev"),
                F.avg("price").alias("_mp")))
    prod = roles.product.select("product_id", F.col("name").alias("product_name"),
                                F.col("kind").alias("product_kind"))
    return pre.join(prod, "product_id").select(
        "sale_date", "product_id", "product_name", "product_kind", "demand",
        round_half_up(F.col("_rev"), 6).alias("revenue"), round_half_up(F.col("_mp"), 6).alias("mean_price"))
