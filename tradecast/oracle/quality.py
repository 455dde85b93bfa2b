"""Oracle SQL for cleaning, contracts, profiling, scalar functions and sources."""

from __future__ import annotations

from tradecast.oracle.base import canon_country, dbl_round, initcap, week_end, with_ctes
from tradecast.oracle.marts import EXTRA as M_EXTRA
from tradecast.oracle.marts import G1, G2, G3, G5, g4

ROLE_CTE = {"product": "r_product", "site": "r_site", "store_room": "r_store_room", "customer": "r_customer",
            "carrier": "r_carrier", "forwarder": "r_forwarder", "production": "r_production",
            "movement": "r_movement", "sale": "r_sale", "shipment": "r_shipment"}


def q(body: str, extra: dict | None = None) -> str:
    return with_ctes(body, {**M_EXTRA, **(extra or {})})


def _as_double(entity: str) -> str:
    """Decimal columns as doubles, like the query's."""
    column = {"site": "area", "store_room": "target_temp", "shipment": "weight"}.get(entity)
    return f"REPLACE (CAST({column} AS DOUBLE) AS {column})" if column else ""


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# The raw contract as the source schema states it, written out here so that the
# oracle doesn't take the engine's word for it.
# Per entity NOT NULL columns; value lists; positive columns; keys;
# references; varchar lengths; numeric (precision, scale).
CONTRACT = {
    "product": ("product_id name kind color", {"kind": "ECONOMY LARGE MEDIUM PROMO SMALL STANDARD"}, "",
                "product_id name", {}, {"name": 100, "kind": 20, "color": 50}, {}),
    "site": ("site_id code area product_id", {}, "area", "site_id code", {"product_id": "product"}, {"code": 20}, {"area": (6, 2)}),
    "store_room": ("store_room_id code capacity", {}, "capacity", "store_room_id code", {}, {"code": 20}, {"target_temp": (4, 2)}),
    "customer": ("customer_id name country kind", {}, "", "customer_id", {}, {"name": 150, "country": 100, "kind": 20}, {}),
    "carrier": ("carrier_id name iata", {}, "", "carrier_id iata", {}, {"name": 100, "iata": 2}, {}),
    "forwarder": ("forwarder_id name country", {}, "", "forwarder_id", {}, {"name": 150, "country": 100}, {}),
    "production": ("production_id prod_date site_id units grade length_cm", {"grade": "A B C"}, "units length_cm",
                   "production_id", {"site_id": "site"}, {"grade": 1}, {}),
    "movement": ("movement_id move_date store_room_id move_type quantity", {"move_type": "in out waste"}, "quantity",
                 "movement_id", {"store_room_id": "store_room", "production_id": "production"}, {"move_type": 10}, {}),
    "sale": ("sale_id sale_date customer_id product_id pack units", {"pack": "FB HB QB EB"}, "units unit_price", "sale_id",
             {"customer_id": "customer", "product_id": "product"}, {"pack": 2}, {"unit_price": (6, 3)}),
    "shipment": ("shipment_id ship_date order_id carrier_id weight", {}, "weight", "shipment_id awb",
                 {"order_id": "sale", "carrier_id": "carrier", "forwarder_id": "forwarder"}, {"awb": 15}, {"weight": (8, 2)}),
}
REQUIRED, VALUES, POSITIVE, KEYS, REFERENCES, WIDTHS, NUMERIC = range(7)


def _count_checks(make) -> str:
    parts = []
    for t, spec in CONTRACT.items():
        for col, cond in make(spec):
            parts.append(f"SELECT {_sq(t)} AS table_name, {_sq(col)} AS column_name, "
                         f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS violations FROM {ROLE_CTE[t]}")
    return "\nUNION ALL\n".join(parts)


def contract_not_null() -> str:
    return q(_count_checks(lambda s: [(c, f"{c} IS NULL") for c in s[REQUIRED].split()]))


def contract_domain() -> str:
    return q(_count_checks(lambda s: [(c, f"NOT ({c} IN ({', '.join(_sq(v) for v in vals.split())}))")
                                      for c, vals in s[VALUES].items()]))


def contract_range() -> str:
    return q(_count_checks(lambda s: [(c, f"{c} <= 0") for c in s[POSITIVE].split()]))


def contract_width() -> str:
    return q(_count_checks(lambda s: [(c, f"length({c}) > {n}") for c, n in s[WIDTHS].items()]
                           + [(c, f"{c} IS NOT NULL AND TRY_CAST({c} AS DECIMAL({p},{sc})) IS NULL")
                              for c, (p, sc) in s[NUMERIC].items()]))


def contract_unique() -> str:
    parts = []
    for t, spec in CONTRACT.items():
        for cols in spec[KEYS].split():
            nn = f"{cols} IS NOT NULL"
            parts.append(f"""SELECT {_sq(t)} AS table_name, {_sq(cols)} AS key_columns,
                CAST(count(*) AS BIGINT) AS duplicate_keys, CAST(COALESCE(sum(n - 1), 0) AS BIGINT) AS surplus_rows
                FROM (SELECT {cols}, count(*) AS n FROM {ROLE_CTE[t]} WHERE {nn} GROUP BY {cols} HAVING count(*) > 1)""")
    return q("\nUNION ALL\n".join(parts))


def contract_fk() -> str:
    parts = []
    for t, spec in CONTRACT.items():
        for col, rt in spec[REFERENCES].items():
            rc = col
            parts.append(f"""SELECT {_sq(t)} AS table_name, {_sq(col)} AS column_name, {_sq(rt)} AS ref_table,
                CAST(count(*) AS BIGINT) AS orphan_rows, CAST(count(DISTINCT f.{col}) AS BIGINT) AS orphan_keys
                FROM {ROLE_CTE[t]} f WHERE f.{col} IS NOT NULL
                  AND NOT EXISTS (SELECT 1 FROM {ROLE_CTE[rt]} r WHERE r.{rc} = f.{col})""")
    return q("\nUNION ALL\n".join(parts))


G5_TYPES = [("sale_date", "date"), ("product_id", "bigint"), ("product_name", "string"),
            ("product_kind", "string"), ("demand", "bigint"), ("revenue", "double"),
            ("mean_price", "double"), ("day_of_week", "int"), ("month", "int"), ("iso_week", "int"),
            ("flag_peak1", "int"), ("flag_peak2", "int")]


def dq_profile() -> str:
    parts = [f"""SELECT {_sq(c)} AS column_name, {_sq(t)} AS data_type,
        CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count,
        count(*) FILTER (WHERE {c} IS NULL) * 100 / count(*) AS null_pct,
        CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_count FROM g_features""" for c, t in G5_TYPES]
    return q("\nUNION ALL\n".join(parts))


MEANS = "SELECT product_id, (milli_sum / 1000.0e0) / n AS mean_price FROM s_price_mean"

RAW_FEATURES = f"""SELECT v.sale_date, v.product_id, p.name AS product_name, p.kind AS product_kind,
      CAST(sum(v.units) AS BIGINT) AS demand,
      {dbl_round('sum(v.units * v.price)', 6)} AS revenue,
      {dbl_round('avg(v.price)', 6)} AS mean_price
    FROM (SELECT r.sale_date, r.product_id, r.units,
                 COALESCE(CAST(r.unit_price AS DOUBLE), m.mean_price) AS price
          FROM r_sale r LEFT JOIN ({MEANS}) m ON r.product_id = m.product_id) v
    JOIN r_product p ON v.product_id = p.product_id
    GROUP BY v.sale_date, v.product_id, p.name, p.kind"""

COUNTS = """SELECT 'customers_raw' AS metric, CAST(count(*) AS BIGINT) AS value FROM r_customer
    UNION ALL SELECT 'customers_clean', count(*) FROM s_customer
    UNION ALL SELECT 'sales_raw', count(*) FROM r_sale
    UNION ALL SELECT 'sales_clean', count(*) FROM s_sale
    UNION ALL SELECT 'sales_null_price_raw', count(*) FROM r_sale WHERE unit_price IS NULL
    UNION ALL SELECT 'sales_null_price_clean', count(*) FROM s_sale WHERE unit_price IS NULL
    UNION ALL SELECT 'sales_without_customer', count(*) FROM s_sale WHERE customer_id IS NULL
    UNION ALL SELECT 'movements_raw', count(*) FROM r_movement
    UNION ALL SELECT 'movements_clean', count(*) FROM s_movement"""

SALE_DATES = "SELECT DISTINCT sale_date FROM r_sale"

SQL = {
    # cleaning
    "clean_customer_map": q("SELECT customer_id, clean_name, canonical_id FROM s_customer_map"),
    "clean_customer_dim": q("SELECT customer_id, name, country, kind FROM s_customer"),
    "clean_customer_dim_basic": q("SELECT customer_id, name, country, kind FROM s_customer_basic"),
    "clean_dims": q("""SELECT site_id, code, CAST(area AS DOUBLE) AS area, product_id, product_name,
        product_kind, product_color FROM s_site"""),
    "clean_dims_product": q("SELECT * FROM s_product"),
    "clean_dims_store_room": q("""SELECT store_room_id, trim(code) AS code, CAST(target_temp AS DOUBLE) AS target_temp, capacity
        FROM r_store_room"""),
    "clean_dims_carrier": q("SELECT carrier_id, trim(name) AS name, trim(iata) AS iata FROM r_carrier"),
    "clean_dims_forwarder": q("SELECT forwarder_id, trim(name) AS name, trim(country) AS country FROM r_forwarder"),
    "clean_shipments": q("""SELECT shipment_id, ship_date, order_id, carrier_id, forwarder_id, awb,
        CAST(weight AS DOUBLE) AS weight FROM r_shipment"""),
    "clean_sales": q("""SELECT sale_id, order_id, line_no, sale_date, customer_id, product_id, pack, units,
        CAST(unit_price AS DOUBLE) AS unit_price, CAST(value_total AS DOUBLE) AS value_total FROM s_sale"""),
    "clean_movements_dedup": q("SELECT * FROM s_movement"),
    # contracts
    "contract_not_null": contract_not_null(),
    "contract_domain": contract_domain(),
    "contract_range": contract_range(),
    "contract_unique": contract_unique(),
    "contract_fk": contract_fk(),
    "contract_width": contract_width(),
    # profiling
    "dq_padded": q("SELECT customer_id, name, CAST(length(name) AS INTEGER) AS name_length FROM r_customer WHERE name <> trim(name)"),
    "dq_padded_kind": q("SELECT customer_id, kind, CAST(length(kind) AS INTEGER) AS kind_length FROM r_customer WHERE kind <> trim(kind)"),
    "dq_upper": q("SELECT customer_id, name FROM r_customer WHERE name = upper(name)"),
    "dq_lower": q("SELECT customer_id, name FROM r_customer WHERE name = lower(name)"),
    "dq_variants": q("SELECT DISTINCT country FROM r_customer WHERE trim(upper(country)) IN ('USA', 'U.S.A.', 'ESTADOS UNIDOS')"),
    "dq_dup_names": q("SELECT name, count(*) AS repetitions FROM r_customer GROUP BY name HAVING count(*) > 1"),
    "dq_dup_names_normalised": q(f"""SELECT {initcap('trim(name)')} AS name, count(*) AS repetitions
        FROM r_customer GROUP BY 1 HAVING count(*) > 1"""),
    "dq_null_price": q("""SELECT sale_id, customer_id, product_id, units, CAST(unit_price AS DOUBLE) AS unit_price
        FROM r_sale WHERE unit_price IS NULL"""),
    "dq_group_mean": q(MEANS),
    "dq_imputable": q(f"""SELECT v.sale_id, v.product_id, m.mean_price FROM r_sale v
        LEFT JOIN ({MEANS}) m ON v.product_id = m.product_id WHERE v.unit_price IS NULL"""),
    "dq_unimputable": q(f"""SELECT v.sale_id, v.product_id, m.mean_price FROM r_sale v
        LEFT JOIN ({MEANS}) m ON v.product_id = m.product_id WHERE v.unit_price IS NULL AND m.mean_price IS NULL"""),
    "dq_counts": q(COUNTS),
    "dq_residual_dups": q("""SELECT move_date, store_room_id, production_id, move_type, quantity, count(*) AS repetitions
        FROM s_movement GROUP BY move_date, store_room_id, production_id, move_type, quantity HAVING count(*) > 1"""),
    "dq_residual_logical": q(f"""SELECT {initcap('trim(name)')} AS name, count(*) AS repetitions
        FROM s_customer GROUP BY 1 HAVING count(*) > 1"""),
    "dq_profile": dq_profile(),
    "dq_value_counts": q("SELECT product_kind, count(*) AS n_rows FROM g_features GROUP BY product_kind"),
    # scalar functions
    "fn_strings": q("""SELECT customer_id, trim(name) AS name_trim, upper(name) AS name_upper, lower(name) AS name_lower,
        CAST(length(name) AS INTEGER) AS name_length, replace(country, '.', '') AS country_no_dots,
        CAST(country LIKE 'U%' AS INTEGER) AS country_like_u, CAST(name <> trim(name) AS INTEGER) AS name_padded
        FROM r_customer"""),
    "fn_initcap": q(f"""SELECT customer_id, {initcap('name')} AS name_initcap, {initcap('trim(country)')} AS country_initcap,
        {canon_country('country')} AS country_canonical FROM r_customer"""),
    "fn_dates": q(f"""SELECT sale_date, CAST(date_trunc('month', sale_date) AS DATE) AS month_start,
        CAST(date_trunc('quarter', sale_date) AS DATE) AS quarter_start,
        CAST(year(sale_date) AS INTEGER) AS year, CAST(month(sale_date) AS INTEGER) AS month,
        CAST(day(sale_date) AS INTEGER) AS day, CAST(quarter(sale_date) AS INTEGER) AS quarter,
        CAST(week(sale_date) AS INTEGER) AS iso_week, CAST(yearweek(sale_date) // 100 AS INTEGER) AS iso_year,
        CAST(isodow(sale_date) AS INTEGER) AS iso_dow,
        CAST(date_diff('day', sale_date, (SELECT max(sale_date) FROM r_sale)) AS INTEGER) AS days_to_last,
        CAST(strftime(sale_date, '%Y-%m-%d') AS DATE) AS parsed,
        ['enero','febrero','marzo','abril','mayo','junio','julio','agosto','septiembre','octubre','noviembre','diciembre'][month(sale_date)] AS month_name,
        ['lunes','martes','miércoles','jueves','viernes','sábado','domingo'][isodow(sale_date)] AS day_name,
        strftime(sale_date, '%Y-%m') AS year_month, 'Q' || CAST(quarter(sale_date) AS VARCHAR) AS quarter_label
        FROM ({SALE_DATES})"""),
    "fn_week_end": q(f"""SELECT sale_date, {week_end('sale_date')} AS week_end, CAST(isodow(sale_date) AS INTEGER) AS iso_dow
        FROM ({SALE_DATES})"""),
    "fn_weeknum": q(f"""SELECT sale_date, wn AS weeknum, CAST(week(sale_date) AS INTEGER) AS iso_week,
        CAST(year(sale_date) AS VARCHAR) || '-' || lpad(CAST(wn AS VARCHAR), 2, '0') AS year_week_key
        FROM (SELECT sale_date, CAST((dayofyear(sale_date) - 1 + isodow(make_date(year(sale_date), 1, 1)) - 1) // 7 + 1 AS INTEGER) AS wn
              FROM ({SALE_DATES}))"""),
    "fn_festivals": q(f"""SELECT yr AS year, make_date(yr, 2, 14) AS valentines_day,
        {week_end('make_date(yr, 5, 1)')} + 7 AS mothers_day
        FROM (SELECT DISTINCT CAST(year(sale_date) AS INTEGER) AS yr FROM ({SALE_DATES}))"""),
    "fn_round": q(f"""SELECT l_orderkey, l_linenumber, CAST(p AS DOUBLE) AS price_3,
        CAST(round(p, 2) AS DOUBLE) AS price_round2, CAST(round(p, 0) AS DOUBLE) AS price_round0,
        {dbl_round('ratio', 2)} AS ratio_round2, {dbl_round('-ratio', 1)} AS neg_ratio_round1
        FROM (SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS ratio,
                     CAST(floor(l_extendedprice / l_quantity * 1000 + 0.5e0) / 1000.0e0 AS DECIMAL(10,3)) AS p
              FROM lineitem)"""),
    # sources
    "src_csv": q("SELECT * FROM r_sale"),
    **{f"src_csv_{n}": q(f"SELECT * {_as_double(n)} FROM {ROLE_CTE[n]}") for n in ROLE_CTE if n != "sale"},
    "load_append_twice": q("SELECT * FROM r_sale"),
    "load_stream": q("SELECT * FROM r_sale"),
    "load_order": q(" UNION ALL ".join(
        f"SELECT {i} AS load_seq, '{n}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM {ROLE_CTE[n]}"
        for i, n in enumerate(["product", "site", "store_room", "customer", "carrier", "forwarder",
                               "production", "movement", "sale", "shipment"], start=1))),
    "scan_features": q(G5),
    "features_rebuild": q(RAW_FEATURES),
    "features_from_mart": q(f"""SELECT sale_date, product_id, product_name, product_kind, demand, revenue, mean_price
        FROM ({G5})"""),
    "views_in_order": q("""SELECT p.kind AS product_kind, CAST(sum(v.units) AS BIGINT) AS total_units
        FROM s_sale v JOIN s_product p ON v.product_id = p.product_id GROUP BY p.kind"""),
    "mart_roundtrip": q(G1),
    "mart_rebuild_twice": q(G1),
    "mart_roundtrip_rfm": q(G2),
    "mart_roundtrip_yield": q(G3),
    "mart_roundtrip_season": q(g4(False)),
    "mart_roundtrip_features": q(G5),
}
