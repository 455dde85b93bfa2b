"""DuckDB SQL building blocks for the correctness oracle.

Written independently of the Spark code: the oracle sees only the driver's raw
views, so every query inlines the role bindings and the clean layer as CTEs.
Exactness rules shared with the Spark side: money summed as decimals, ratios
rounded half-up with integer (HUGEINT) division, doubles rounded with
``sign(x)*floor(|x|*10^d+0.5)/10^d``.
"""

from __future__ import annotations


def initcap(x: str) -> str:
    """PostgreSQL INITCAP: a word starts after any non-letter/digit."""
    return ("array_to_string(list_transform(regexp_extract_all(lower(" + x + "), "
            "'([\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+)'), "
            "lambda r: upper(substr(r, 1, 1)) || substr(r, 2)), '')")


# Spellings of the United States, and patterns with the country they stand for.
USA_SPELLINGS = ["USA", "ESTADOS UNIDOS"]
COUNTRY_PATTERNS = [("Pa%ses Bajos", "Países Bajos"), ("Espa%a", "España"), ("Canad%", "Canadá"),
                    ("Reino Unido", "Reino Unido"), ("Rusia", "Rusia")]


def canon_country(x: str) -> str:
    ic = initcap(f"trim({x})")
    usa = ", ".join(f"'{s}'" for s in USA_SPELLINGS)
    rules = " ".join(f"WHEN {ic} LIKE '{pattern}' THEN '{name}'" for pattern, name in COUNTRY_PATTERNS)
    return f"CASE WHEN upper(replace(trim({x}), '.', '')) IN ({usa}) THEN 'USA' {rules} ELSE {ic} END"


def half_up_units(num: str, den: str, digits: int = 0, num_scale: int = 0) -> str:
    """HUGEINT k = round_half_up(num / 10^num_scale / den, digits) * 10^digits."""
    return (f"((CAST({num} AS HUGEINT) * {2 * 10 ** digits} + CAST({den} AS HUGEINT) * {10 ** num_scale}) "
            f"// (CAST({den} AS HUGEINT) * {2 * 10 ** num_scale}))")


def half_up(num: str, den: str, digits: int = 0, num_scale: int = 0) -> str:
    return f"(CAST({half_up_units(num, den, digits, num_scale)} AS DOUBLE) / {float(10 ** digits)!r})"


def dbl_round(x: str, digits: int) -> str:
    f = float(10 ** digits)
    r = f"(sign({x}) * floor(abs({x}) * {f!r} + 0.5e0) / {f!r})"
    return f"(CASE WHEN {r} = 0 THEN 0.0e0 ELSE {r} END)"


def isodow(d: str) -> str:
    return f"CAST(isodow({d}) AS INTEGER)"


def week_end(d: str) -> str:
    return f"({d} + CAST((7 - isodow({d})) % 7 AS INTEGER))"


def season(d: str) -> str:
    return (f"CASE WHEN week({d}) BETWEEN 3 AND 6 THEN 'San Valentin' "
            f"WHEN week({d}) BETWEEN 15 AND 18 THEN 'Dia de la Madre' ELSE 'Normal' END")


ROLE_CTES: dict[str, str] = {
    "r_product": """SELECT p_partkey AS product_id, p_name AS name, p_type AS kind, p_brand AS color FROM part""",
    "r_site": """SELECT s_suppkey AS site_id, s_name AS code,
        CAST((15 + s_suppkey % 66) / 10.0e0 AS DECIMAL(6,2)) AS area,
        s_suppkey AS product_id, s_nationkey AS group_id FROM supplier""",
    "r_store_room": """SELECT n_nationkey AS store_room_id, n_name AS code,
        CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE CAST(0.5e0 + (n_nationkey % 4) / 2.0e0 AS DECIMAL(4,2)) END AS target_temp,
        CAST((n_nationkey + 1) * 100 AS INTEGER) AS capacity FROM nation""",
    "r_carrier": """SELECT r_regionkey AS carrier_id, r_name AS name, 'C' || CAST(r_regionkey AS VARCHAR) AS iata FROM region""",
    "r_forwarder": """SELECT n_nationkey AS forwarder_id, n_name AS name, CAST(n_regionkey AS VARCHAR) AS country
        FROM nation""",
    "r_customer_base": """SELECT c.c_custkey AS k, c.c_name, c.c_mktsegment,
        CASE WHEN n.n_nationkey <> 1 THEN n.n_name
             WHEN c.c_custkey % 4 = 0 THEN 'U.S.A.'
             WHEN c.c_custkey % 4 = 1 THEN 'usa '
             WHEN c.c_custkey % 4 = 2 THEN 'Estados Unidos'
             ELSE 'Usa' END AS country,
        CASE WHEN c.c_custkey % 20 = 0 THEN c.c_mktsegment || '  ' ELSE c.c_mktsegment END AS kind
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "r_customer": """SELECT k * 2 AS customer_id,
            CASE WHEN k % 10 = 3 THEN upper(c_name) WHEN k % 10 = 5 THEN lower(c_name)
                 WHEN k % 10 = 7 THEN '  ' || c_name || '  ' ELSE c_name END AS name,
            country, kind FROM r_customer_base
        UNION ALL
        SELECT k * 2 + 1, CASE WHEN k % 60 = 0 THEN upper(c_name) ELSE ' ' || lower(c_name) END,
            country, kind FROM r_customer_base WHERE k % 30 = 0""",
    "r_sale": """SELECT l.l_orderkey * 8 + l.l_linenumber AS sale_id, l.l_orderkey AS order_id,
        l.l_linenumber AS line_no, CAST(o.o_orderdate AS DATE) AS sale_date,
        CASE WHEN o.o_custkey % 30 = 0 AND l.l_orderkey % 2 = 0 THEN o.o_custkey * 2 + 1 ELSE o.o_custkey * 2 END AS customer_id,
        l.l_partkey AS product_id,
        CASE l.l_returnflag WHEN 'N' THEN 'FB' WHEN 'A' THEN 'HB' ELSE 'QB' END AS pack,
        CAST(l.l_quantity AS BIGINT) AS units,
        CASE WHEN l.l_orderkey % 50 = 0 THEN NULL
             ELSE CAST(floor(l.l_extendedprice / l.l_quantity * 1000 + 0.5e0) / 1000.0e0 AS DECIMAL(10,3)) END AS unit_price
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "r_production": """SELECT o.o_orderkey AS production_id, CAST(o.o_orderdate AS DATE) AS prod_date,
        a.site_id, a.units,
        CASE o.o_orderkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS grade,
        CAST(40 + (o.o_orderkey % 4) * 10 AS INTEGER) AS length_cm
        FROM orders o JOIN (SELECT l_orderkey, min(l_suppkey) AS site_id,
                                   CAST(sum(l_quantity) * 10 AS BIGINT) AS units
                            FROM lineitem GROUP BY l_orderkey) a ON o.o_orderkey = a.l_orderkey""",
    "r_movement": """SELECT l_orderkey * 8 + l_linenumber AS movement_id, l_orderkey AS order_id,
        l_linenumber AS source_no, CAST(l_shipdate AS DATE) AS move_date,
        CAST(l_suppkey % 4 AS INTEGER) AS store_room_id,
        CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_orderkey END AS production_id,
        CASE l_returnflag WHEN 'N' THEN 'in' WHEN 'A' THEN 'out' ELSE 'waste' END AS move_type,
        CAST(l_quantity AS INTEGER) AS quantity FROM lineitem""",
    "r_shipment": """SELECT o_orderkey AS shipment_id, CAST(o_orderdate AS DATE) AS ship_date, o_orderkey AS order_id,
        CAST(o_orderkey % 5 AS INTEGER) AS carrier_id,
        CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_custkey % 25 AS INTEGER) END AS forwarder_id,
        'AWB' || repeat('0', greatest(0, 10 - length(CAST(o_orderkey AS VARCHAR)))) || CAST(o_orderkey AS VARCHAR) AS awb,
        CAST(floor(o_totalprice / 10.0e0 + 0.5e0) / 100.0e0 AS DECIMAL(8,2)) AS weight FROM orders""",
}

CLEAN_CTES: dict[str, str] = {
    "s_customer_map": f"""SELECT m.customer_id, m.clean_name, g.canonical_id
        FROM (SELECT customer_id, {initcap('trim(name)')} AS clean_name FROM r_customer) m
        JOIN (SELECT {initcap('trim(name)')} AS clean_name, min(customer_id) AS canonical_id
              FROM r_customer GROUP BY 1) g ON m.clean_name = g.clean_name""",
    "s_customer": f"""SELECT c.customer_id, {initcap('trim(c.name)')} AS name,
        {canon_country('c.country')} AS country, trim(c.kind) AS kind
        FROM r_customer c JOIN s_customer_map m ON c.customer_id = m.customer_id
        WHERE c.customer_id = m.canonical_id""",
    "s_customer_basic": f"""SELECT c.customer_id, {initcap('trim(c.name)')} AS name,
        trim(upper(c.country)) AS country, trim(c.kind) AS kind
        FROM r_customer c JOIN s_customer_map m ON c.customer_id = m.customer_id
        WHERE c.customer_id = m.canonical_id""",
    "s_product": """SELECT product_id, trim(name) AS name, trim(kind) AS kind, trim(color) AS color FROM r_product""",
    "s_site": """SELECT s.site_id, trim(s.code) AS code, s.area, s.product_id, p.name AS product_name,
        p.kind AS product_kind, p.color AS product_color
        FROM r_site s JOIN s_product p ON s.product_id = p.product_id""",
    "s_price_mean": """SELECT product_id, sum(CAST(unit_price * 1000 AS BIGINT)) AS milli_sum, count(*) AS n
        FROM r_sale WHERE unit_price IS NOT NULL GROUP BY product_id""",
    "s_sale": f"""SELECT v.sale_id, v.order_id, v.line_no, v.sale_date, m.canonical_id AS customer_id,
        v.product_id, v.pack, v.units,
        CAST(CAST(CASE WHEN v.unit_price IS NOT NULL
                  THEN {half_up_units('CAST(v.unit_price * 1000 AS BIGINT)', '1', 2, 3)}
                  ELSE {half_up_units('p.milli_sum', 'p.n', 2, 3)} END AS DECIMAL(38,0)) * 0.01 AS DECIMAL(12,2)) AS unit_price,
        CAST(CAST(CASE WHEN v.unit_price IS NOT NULL
                  THEN {half_up_units('v.units * CAST(v.unit_price * 1000 AS BIGINT)', '1', 2, 3)}
                  ELSE {half_up_units('CAST(v.units AS HUGEINT) * p.milli_sum', 'p.n', 2, 3)} END AS DECIMAL(38,0)) * 0.01 AS DECIMAL(18,2)) AS value_total
        FROM r_sale v
        LEFT JOIN s_customer_map m ON v.customer_id = m.customer_id
        LEFT JOIN s_price_mean p ON v.product_id = p.product_id""",
    "s_movement": """SELECT movement_id, move_date, store_room_id, production_id, move_type, quantity FROM (
        SELECT *, row_number() OVER (PARTITION BY move_date, store_room_id, production_id, move_type, quantity
                                     ORDER BY movement_id) AS rn FROM r_movement) WHERE rn = 1""",
}

ALL_CTES = {**ROLE_CTES, **CLEAN_CTES}


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with every CTE it (transitively) references."""
    ctes = dict(ALL_CTES)
    if extra:
        ctes.update(extra)
    order = list(ctes)
    needed: set[str] = set()

    def visit(text: str):
        for name in order:
            if name not in needed and _mentions(text, name):
                needed.add(name)
                visit(ctes[name])

    visit(body)
    parts = [f"{n} AS ({ctes[n]})" for n in order if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


def _mentions(text: str, name: str) -> bool:
    import re
    return re.search(r"\b" + re.escape(name) + r"\b", text) is not None
