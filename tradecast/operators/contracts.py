"""Data contracts (the raw schema's NOT NULL / CHECK / UNIQUE / FK / width rules)
re-aimed as batch checks that report violation counts.

Each check is one aggregation pass per table (``count_if`` per column, then
``stack`` to long form), never a row-by-row loop.  Foreign keys are reduced to
their distinct values with counts (partial aggregation) before the anti-join
with the referenced keys, so the shuffle carries distinct keys, not rows.
A NULL foreign key passes, as in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class TableSpec:
    not_null: list[str] = field(default_factory=list)
    domain: dict[str, list[str]] = field(default_factory=dict)
    positive: list[str] = field(default_factory=list)
    unique: list[list[str]] = field(default_factory=list)
    fk: dict[str, tuple[str, str]] = field(default_factory=dict)  # col -> (table, col)
    width: dict[str, int] = field(default_factory=dict)            # varchar(n)
    decimal_fit: dict[str, tuple[int, int]] = field(default_factory=dict)  # numeric(p, s)


# The raw contract per entity (our English names).
SPECS: dict[str, TableSpec] = {
    "product": TableSpec(
        not_null=["product_id", "name", "kind", "color"],
        domain={"kind": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]},
        unique=[["product_id"], ["name"]],
        width={"name": 100, "kind": 20, "color": 50}),
    "site": TableSpec(
        not_null=["site_id", "code", "area", "product_id"],
        positive=["area"], unique=[["site_id"], ["code"]],
        fk={"product_id": ("product", "product_id")},
        width={"code": 20}, decimal_fit={"area": (6, 2)}),
    "store_room": TableSpec(
        not_null=["store_room_id", "code", "capacity"],
        positive=["capacity"], unique=[["store_room_id"], ["code"]],
        width={"code": 20}, decimal_fit={"target_temp": (4, 2)}),
    "customer": TableSpec(
        not_null=["customer_id", "name", "country", "kind"],
        unique=[["customer_id"]],
        width={"name": 150, "country": 100, "kind": 20}),
    "carrier": TableSpec(
        not_null=["carrier_id", "name", "iata"], unique=[["carrier_id"], ["iata"]],
        width={"name": 100, "iata": 2}),
    "forwarder": TableSpec(
        not_null=["forwarder_id", "name", "country"], unique=[["forwarder_id"]],
        width={"name": 150, "country": 100}),
    "production": TableSpec(
        not_null=["production_id", "prod_date", "site_id", "units", "grade", "length_cm"],
        domain={"grade": ["A", "B", "C"]}, positive=["units", "length_cm"],
        unique=[["production_id"]], fk={"site_id": ("site", "site_id")}, width={"grade": 1}),
    "movement": TableSpec(
        not_null=["movement_id", "move_date", "store_room_id", "move_type", "quantity"],
        domain={"move_type": ["in", "out", "waste"]}, positive=["quantity"],
        unique=[["movement_id"]],
        fk={"store_room_id": ("store_room", "store_room_id"),
            "production_id": ("production", "production_id")},
        width={"move_type": 10}),
    "sale": TableSpec(
        not_null=["sale_id", "sale_date", "customer_id", "product_id", "pack", "units"],
        domain={"pack": ["FB", "HB", "QB", "EB"]}, positive=["units", "unit_price"],
        unique=[["sale_id"]],
        fk={"customer_id": ("customer", "customer_id"), "product_id": ("product", "product_id")},
        width={"pack": 2}, decimal_fit={"unit_price": (6, 3)}),
    "shipment": TableSpec(
        not_null=["shipment_id", "ship_date", "order_id", "carrier_id", "weight"],
        positive=["weight"], unique=[["shipment_id"], ["awb"]],
        fk={"order_id": ("sale", "order_id"), "carrier_id": ("carrier", "carrier_id"),
            "forwarder_id": ("forwarder", "forwarder_id")},
        width={"awb": 15}, decimal_fit={"weight": (8, 2)}),
}

ROLE_ATTR = {"customer": "customer_raw", "sale": "sale_raw", "movement": "movement_raw"}


def role_tables(roles) -> dict[str, DataFrame]:
    return {name: getattr(roles, ROLE_ATTR.get(name, name)) for name in SPECS}


def _long(table: str, df: DataFrame, counts: dict[str, F.Column]) -> DataFrame | None:
    """One aggregation pass over ``df``; rows (table_name, column_name, violations)."""
    if not counts:
        return None
    names = list(counts)
    agg = df.agg(*[c.alias(f"v{i}") for i, c in enumerate(counts.values())])
    pairs = ", ".join(f"'{n}', v{i}" for i, n in enumerate(names))
    return agg.selectExpr(f"'{table}' AS table_name",
                          f"stack({len(names)}, {pairs}) AS (column_name, violations)") \
        .select("table_name", "column_name", F.col("violations").cast("long"))


def _union(frames) -> DataFrame:
    frames = [f for f in frames if f is not None]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def not_null(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(_long(t, tables[t], {c: F.count_if(F.col(c).isNull()) for c in s.not_null})
                  for t, s in SPECS.items())


def domain(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(_long(t, tables[t], {c: F.count_if(~F.col(c).isin(vals)) for c, vals in s.domain.items()})
                  for t, s in SPECS.items())


def positive(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(_long(t, tables[t], {c: F.count_if(F.col(c) <= 0) for c in s.positive})
                  for t, s in SPECS.items())


def width(tables: dict[str, DataFrame]) -> DataFrame:
    """VARCHAR(n) length and NUMERIC(p, s) fit (the value must cast without overflow)."""
    def fit(c, p, s):
        x = F.col(c)
        return F.count_if(x.isNotNull() & x.try_cast(f"decimal({p},{s})").isNull())
    out = []
    for t, s in SPECS.items():
        checks = {c: F.count_if(F.length(c) > n) for c, n in s.width.items()}
        checks.update({c: fit(c, p, sc) for c, (p, sc) in s.decimal_fit.items()})
        out.append(_long(t, tables[t], checks))
    return _union(out)


def unique(tables: dict[str, DataFrame]) -> DataFrame:
    """Per key: number of duplicated key values and surplus rows.  NULL keys are
    ignored (SQL UNIQUE allows many NULLs).

    Each key is counted by its own typed columns, with a map-side combine, and
    gives one row, of an empty table too."""
    out = []
    for t, s in SPECS.items():
        for key in s.unique:
            n = tables[t].dropna(subset=key).groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1")
            out.append(n.agg(F.count("*").alias("duplicate_keys"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("surplus_rows"))
                       .select(F.lit(t).alias("table_name"), F.lit(",".join(key)).alias("key_columns"), "duplicate_keys", "surplus_rows"))
    return _union(out)


def foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    out = []
    for t, s in SPECS.items():
        for col, (rt, rc) in s.fk.items():
            vals = tables[t].where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_k")).count()
            ref = tables[rt].select(F.col(rc).alias("_k")).distinct()
            orphans = vals.join(ref, "_k", "left_anti")
            out.append(orphans.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("orphan_rows"),
                                   F.count("*").cast("long").alias("orphan_keys"))
                       .select(F.lit(t).alias("table_name"), F.lit(col).alias("column_name"),
                               F.lit(rt).alias("ref_table"), "orphan_rows", "orphan_keys"))
    return _union(out)
