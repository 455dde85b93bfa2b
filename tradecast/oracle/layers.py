"""Oracle SQL for the view catalogue, the enforced load, the permissive scan and
the refresh of one period, bucketed bronze and merged profiles (DuckDB dialect)."""

from __future__ import annotations

from tradecast.oracle import marts as OG
from tradecast.oracle import quality as OX

VIEWS = {
    "customer_map": OX.SQL["clean_customer_map"], "customer": OX.SQL["clean_customer_dim"], "product": OX.SQL["clean_dims_product"],
    "site": OX.SQL["clean_dims"], "store_room": OX.SQL["clean_dims_store_room"], "carrier": OX.SQL["clean_dims_carrier"],
    "forwarder": OX.SQL["clean_dims_forwarder"], "production": OX.SQL["src_csv_production"], "movements": OX.SQL["clean_movements_dedup"],
    "sales": OX.SQL["clean_sales"], "shipments": OX.SQL["clean_shipments"], "sales_monthly": OG.SQL["g1_sales_monthly"],
    "customer_rfm": OG.SQL["g2_customer_rfm"], "site_yield": OG.SQL["g3_site_yield"], "weekly_season": OG.SQL["g4_weekly_season"],
    "demand_features": OG.SQL["g5_demand_features"],
}

SQL = {
    "view_catalogue": " UNION ALL ".join(f"SELECT '{n}' AS view_name, count(*) AS n_rows FROM ({s})" for n, s in VIEWS.items()),
    # what these tables break: line ids repeat, and prices from 1,000 on do not fit
    "load_enforced": f"""WITH n AS ({OX.SQL['load_order']}), h AS ({OX.SQL['src_csv_shipment']}),
        s AS (SELECT order_id, (unit_price IS NULL OR unit_price < 1000) AND 1 = row_number() OVER (
                PARTITION BY sale_id ORDER BY order_id NULLS FIRST, line_no NULLS FIRST, sale_date NULLS FIRST, customer_id NULLS FIRST,
                product_id NULLS FIRST, pack NULLS FIRST, units NULLS FIRST, unit_price NULLS FIRST) AS good FROM ({OX.SQL['src_csv']})),
        bad AS (SELECT 'sale' AS table_name, count(*) AS b FROM s WHERE NOT good
                UNION ALL SELECT 'movement', count(*) - count(DISTINCT movement_id) FROM ({OX.SQL['src_csv_movement']})
                UNION ALL SELECT 'shipment', count(*) FROM h WHERE order_id NOT IN (SELECT order_id FROM s WHERE good))
        SELECT load_seq, table_name, n_rows - COALESCE(b, 0) AS n_loaded, COALESCE(b, 0) AS n_quarantined FROM n LEFT JOIN bad USING (table_name)""",
    "src_csv_permissive": f"""SELECT CASE WHEN order_id % 97 = 0 THEN 'malformed' ELSE 'good' END AS status, count(*) AS n_rows,
        CAST(sum(CASE WHEN order_id % 97 = 0 THEN 0 ELSE units END) AS BIGINT) AS units,
        CAST(sum(CASE WHEN order_id % 97 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_texts FROM ({OX.SQL['src_csv']}) GROUP BY 1""",
    "bucketed_sales": OX.SQL["src_csv"],
    "bucketed_production": OX.SQL["src_csv_production"],
    # the sketches' distinct counts are within their error
    "dq_profile_merged": f"SELECT column_name, data_type, null_count, null_pct, TRUE AS within_error FROM ({OX.SQL['dq_profile']})",
    "mart_refresh_year": f"""SELECT * REPLACE (CASE WHEN year = 1997 THEN total_units * 2 ELSE total_units END AS total_units)
        FROM ({OG.SQL['g1_sales_monthly']})""",
}
