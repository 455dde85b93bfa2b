"""Cleaning operators: canonical entities, imputation, deterministic de-duplication.

Scale notes
-----------
* Canonical ids and the surviving duplicate use ``groupBy`` + ``min`` (map-side
  partial aggregation) instead of a per-key window, so a key holding a third of
  all rows never lands whole in one task.
* Group means are pre-aggregated (one row per product) before they meet the
  fact; AQE turns the join into a broadcast when the aggregate is small, and
  splits skewed partitions when it is not.
"""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradecast.functions.numeric import int_div, ratio_half_up_units, to_milli, units_to_decimal
from tradecast.functions.text import basic_country, canonical_country, clean_name


def customer_map(customer_raw: DataFrame) -> DataFrame:
    """Every raw customer id -> (clean name, canonical id = min id of that clean name)."""
    keyed = customer_raw.select("customer_id", clean_name("name").alias("clean_name"))
    canon = keyed.groupBy("clean_name").agg(F.min("customer_id").alias("canonical_id"))
    return keyed.join(canon, "clean_name").select("customer_id", "clean_name", "canonical_id")


def _canonical_rows(customer_raw: DataFrame) -> DataFrame:
    canon_ids = (customer_raw.groupBy(clean_name("name").alias("clean_name"))
                 .agg(F.min("customer_id").alias("customer_id"))
                 .select("customer_id"))
    return customer_raw.join(canon_ids, "customer_id", "left_semi")


def customer_dim(customer_raw: DataFrame) -> DataFrame:
    """Canonical customers only, names INITCAP(TRIM), countries canonicalised."""
    return _canonical_rows(customer_raw).select(
        "customer_id",
        clean_name("name").alias("name"),
        canonical_country("country").alias("country"),
        F.trim("kind").alias("kind"),
    )


def customer_dim_basic(customer_raw: DataFrame) -> DataFrame:
    """Legacy variant: country only ``TRIM(UPPER())``."""
    return _canonical_rows(customer_raw).select(
        "customer_id",
        clean_name("name").alias("name"),
        basic_country("country").alias("country"),
        F.trim("kind").alias("kind"),
    )


def product_dim(product: DataFrame) -> DataFrame:
    return product.select("product_id", F.trim("name").alias("name"),
                          F.trim("kind").alias("kind"), F.trim("color").alias("color"))


def site_dim(site: DataFrame, product: DataFrame) -> DataFrame:
    """Sites denormalised with their product's attributes (inner, as the reference)."""
    p = product_dim(product).select(
        "product_id", F.col("name").alias("product_name"),
        F.col("kind").alias("product_kind"), F.col("color").alias("product_color"))
    return site.select("site_id", F.trim("code").alias("code"), "area", "product_id").join(p, "product_id") \
        .select("site_id", "code", "area", "product_id", "product_name", "product_kind", "product_color")


def store_room_dim(store_room: DataFrame) -> DataFrame:
    return store_room.select("store_room_id", F.trim("code").alias("code"), "target_temp", "capacity")


def carrier_dim(carrier: DataFrame) -> DataFrame:
    return carrier.select("carrier_id", F.trim("name").alias("name"), F.trim("iata").alias("iata"))


def forwarder_dim(forwarder: DataFrame) -> DataFrame:
    return forwarder.select("forwarder_id", F.trim("name").alias("name"), F.trim("country").alias("country"))


def shipments(shipment: DataFrame) -> DataFrame:
    return shipment.select("shipment_id", "ship_date", "order_id", "carrier_id", "forwarder_id", "awb", "weight")


def product_price_means(sale_raw: DataFrame) -> DataFrame:
    """Per product: exact sum of known prices (thousandths) and their count."""
    return (sale_raw.where(F.col("unit_price").isNotNull())
            .groupBy("product_id")
            .agg(F.sum(to_milli("unit_price")).alias("price_milli_sum"),
                 F.count("*").alias("price_n")))


def sales(sale_raw: DataFrame, cmap: DataFrame) -> DataFrame:
    """Clean sales: canonical customer, imputed price, value.

    * ``unit_price`` = ROUND(COALESCE(price, product mean), 2)  — decimal(12,2)
    * ``value_total`` = ROUND(units * COALESCE(price, product mean), 2) — uses the
      *unrounded* price, decimal(18,2)
    Every raw row is kept (left joins); a product without any price stays NULL.
    Only rows without a price meet the product means; the others stay where
    they are.
    """
    means = product_price_means(sale_raw)
    priced = sale_raw.where(F.col("unit_price").isNotNull()).select(
        "*", F.lit(None).cast("long").alias("price_milli_sum"), F.lit(None).cast("long").alias("price_n"))
    unpriced = sale_raw.where(F.col("unit_price").isNull()).join(means, "product_id", "left")
    s = priced.unionByName(unpriced).join(cmap.select("customer_id", "canonical_id"), "customer_id", "left")
    known = F.col("unit_price").isNotNull()
    milli = to_milli("unit_price")
    # Known price (most rows): half-up to cents in long arithmetic.  Imputed rows
    # divide large exact sums, so they take the wide-decimal path.
    price_cents = F.when(known, int_div(milli + 5, 10)) \
        .otherwise(ratio_half_up_units(F.col("price_milli_sum"), F.col("price_n"), 2, 3))
    value_cents = F.when(known, int_div(F.col("units") * milli + 5, 10)) \
        .otherwise(ratio_half_up_units(F.col("units").cast("decimal(38,0)") * F.col("price_milli_sum"),
                                       F.col("price_n"), 2, 3))
    return s.select(
        "sale_id", "order_id", "line_no", "sale_date",
        F.col("canonical_id").alias("customer_id"),
        "product_id", "pack", "units",
        units_to_decimal(price_cents, 2, 12).alias("unit_price"),
        units_to_decimal(value_cents, 2, 18).alias("value_total"),
    )


MOVEMENT_KEY = ["move_date", "store_room_id", "production_id", "move_type", "quantity"]


def movements_dedup(movement_raw: DataFrame) -> DataFrame:
    """Exact duplicates on the business key collapse to the lowest movement id.

    ``groupBy`` treats NULL keys as equal, like ``PARTITION BY``; ``min`` is
    partially aggregated on the map side.
    """
    return (movement_raw.groupBy(*MOVEMENT_KEY)
            .agg(F.min("movement_id").alias("movement_id"))
            .select("movement_id", *MOVEMENT_KEY))


class Cleaned:
    """The silver layer over a :class:`~tradecast.sources.roles.Roles` bundle.

    With ``store=None`` every table is a lazy view (re-planned on each use).
    With a ``store`` folder (inside the shared checkpoint folder) each table is
    written once as parquet on first use and read back afterwards: queries that
    touch a table several times scan the small silver copy instead of
    re-running the raw joins, and the written table cuts the lineage, so a lost
    executor recomputes from it rather than from the raw sources.
    """

    def __init__(self, roles, store: str | None = None):
        self.roles = roles
        self.store = store
        self._written: dict[str, str] = {}
        self._locks: dict[str, threading.Lock] = {}
        self._guard = threading.Lock()

    def cached(self, name: str, build, cluster_by: str | None = None) -> DataFrame:
        """``cluster_by``: sort each partition by this column before writing, so
        parquet row-group min/max statistics let date-range filters skip data
        (a local sort, no shuffle)."""
        if self.store is None:
            return build()
        with self._lock(name):
            if name not in self._written:
                path = f"{self.store}/{name}"
                df = build()
                if cluster_by:
                    df = df.sortWithinPartitions(cluster_by)
                df.write.mode("overwrite").parquet(path)
                self._written[name] = path
        return self.roles.spark.read.parquet(self._written[name])

    def _lock(self, name: str) -> threading.Lock:
        with self._guard:
            return self._locks.setdefault(name, threading.Lock())

    def materialize(self, waves: list[list] | None = None, workers: int = 4) -> None:
        """Write the store's tables ahead of the queries.  Tables inside one wave
        are independent and are submitted as concurrent Spark jobs (small jobs
        then share the executors instead of queuing); shared dependencies are
        built once thanks to the per-table locks."""
        if waves is None:
            waves = [[lambda: self.customer_map, lambda: self.customer, lambda: self.product,
                      lambda: self.site, lambda: self.movements, lambda: self.production],
                     [lambda: self.sales]]
        with ThreadPoolExecutor(max_workers=workers) as pool:
            for wave in waves:
                list(pool.map(lambda f: f(), wave))

    @property
    def customer_map(self) -> DataFrame:
        return self.cached("customer_map", lambda: customer_map(self.roles.customer_raw))

    @property
    def customer(self) -> DataFrame:
        return self.cached("customer", lambda: customer_dim(self.roles.customer_raw))

    @property
    def product(self) -> DataFrame:
        return self.cached("product", lambda: product_dim(self.roles.product))

    @property
    def site(self) -> DataFrame:
        return self.cached("site", lambda: site_dim(self.roles.site, self.roles.product))

    @property
    def sales(self) -> DataFrame:
        return self.cached("sales", lambda: sales(self.roles.sale_raw, self.customer_map), "sale_date")

    @property
    def movements(self) -> DataFrame:
        return self.cached("movements", lambda: movements_dedup(self.roles.movement_raw), "move_date")

    @property
    def store_room(self) -> DataFrame:
        return self.cached("store_room", lambda: store_room_dim(self.roles.store_room))

    @property
    def carrier(self) -> DataFrame:
        return self.cached("carrier", lambda: carrier_dim(self.roles.carrier))

    @property
    def forwarder(self) -> DataFrame:
        return self.cached("forwarder", lambda: forwarder_dim(self.roles.forwarder))

    @property
    def shipments(self) -> DataFrame:
        return self.cached("shipments", lambda: shipments(self.roles.shipment), "ship_date")

    @property
    def production(self) -> DataFrame:
        return self.cached("production", lambda: self.roles.production)
