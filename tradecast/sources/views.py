"""The layers as named views (S6): eleven cleaned ones and five marts.

A view names the views that it reads; the order to create them in follows from
that, and they are dropped in reverse.  Names carry a prefix, so that the views
of several sources live side by side in one session.  A mart is the same plan
as elsewhere in the library, handed views in place of written tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from tradecast.operators import clean as CL
from tradecast.plans import marts as G


class Layer:
    """What a plan reads: attributes are views, and nothing is written."""

    def __init__(self, spark: SparkSession, roles, prefix: str):
        self.spark, self.roles, self.prefix = spark, roles, prefix

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.table(self.prefix + name)

    def cached(self, name: str, build: Callable[[], DataFrame], cluster_by: str | None = None) -> DataFrame:
        return build()


@dataclass(frozen=True)
class View:
    build: Callable[[Layer], DataFrame]
    reads: tuple[str, ...] = ()


CATALOG: dict[str, View] = {
    "sales_monthly": View(G.g1_sales_monthly, ("sales", "product", "customer")),
    "customer_rfm": View(G.g2_customer_rfm, ("sales", "customer")),
    "site_yield": View(G.g3_site_yield, ("site", "production", "movements")),
    "weekly_season": View(G.g4_weekly_season, ("sales",)),
    "demand_features": View(G.g5_demand_features, ("sales", "product")),
    "customer_map": View(lambda v: CL.customer_map(v.roles.customer_raw)),
    "customer": View(lambda v: CL.customer_dim(v.roles.customer_raw)),
    "product": View(lambda v: CL.product_dim(v.roles.product)),
    "site": View(lambda v: CL.site_dim(v.roles.site, v.roles.product)),
    "store_room": View(lambda v: CL.store_room_dim(v.roles.store_room)),
    "carrier": View(lambda v: CL.carrier_dim(v.roles.carrier)),
    "forwarder": View(lambda v: CL.forwarder_dim(v.roles.forwarder)),
    "production": View(lambda v: v.roles.production),
    "movements": View(lambda v: CL.movements_dedup(v.roles.movement_raw)),
    "sales": View(lambda v: CL.sales(v.roles.sale_raw, v.customer_map), ("customer_map",)),
    "shipments": View(lambda v: CL.shipments(v.roles.shipment)),
}


def creation_order(catalog: dict[str, View], wanted: Iterable[str] | None = None) -> list[str]:
    """Every view after those that it reads; with ``wanted``, only what it needs."""
    need, todo = set(), list(wanted if wanted is not None else catalog)
    while todo:
        name = todo.pop()
        if name not in need:
            need.add(name)
            todo += catalog[name].reads
    return list(TopologicalSorter({n: catalog[n].reads for n in catalog if n in need}).static_order())


def create_views(spark: SparkSession, roles, prefix: str, wanted: Iterable[str] | None = None,
                 catalog: dict[str, View] = CATALOG) -> list[str]:
    """Creates the views, or replaces those that exist; returns their names."""
    layer = Layer(spark, roles, prefix)
    names = creation_order(catalog, wanted)
    for name in names:
        catalog[name].build(layer).createOrReplaceTempView(prefix + name)
    return [prefix + n for n in names]


def drop_views(spark: SparkSession, prefix: str, catalog: dict[str, View] = CATALOG) -> list[str]:
    """Drops the views of a prefix, readers before what they read; those that do
    not exist are passed over."""
    return [prefix + n for n in reversed(creation_order(catalog)) if spark.catalog.dropTempView(prefix + n)]
