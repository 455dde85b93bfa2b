"""Oracle SQL for the business questions (DuckDB dialect)."""

from __future__ import annotations

from tradecast.oracle.base import half_up, season, with_ctes

VAL = "CAST(v.units AS DECIMAL(38,0)) * v.unit_price"

SEASON_UNITS = f"""SELECT season, yr AS year, CAST(sum(units) AS BIGINT) AS total_units,
    CAST({half_up('sum(units)', "CASE WHEN season = 'Normal' THEN 44 ELSE 4 END", 0)} AS BIGINT) AS weekly_mean
    FROM (SELECT CAST(year(sale_date) AS INTEGER) AS yr, {season('sale_date')} AS season, units FROM s_sale)
    WHERE (season = 'Normal' AND yr IN (1995, 1996, 1997, 1998, 1999, 2000))
       OR (season <> 'Normal' AND yr IN (1995, 1996, 1997, 1998, 1999, 2000, 2001))
    GROUP BY season, yr"""

SITE_OUTPUT = """SELECT s.site_id, s.product_name, s.area, o.total_units
    FROM (SELECT site_id, CAST(sum(units) AS BIGINT) AS total_units FROM r_production GROUP BY site_id) o
    JOIN s_site s ON s.site_id = o.site_id"""

WASTE_BY_PRODUCT = """SELECT s.product_name AS name, CAST(sum(m.quantity) AS BIGINT) AS waste_units
    FROM s_movement m JOIN r_production p ON p.production_id = m.production_id
    JOIN s_site s ON s.site_id = p.site_id
    WHERE m.move_type = 'waste' GROUP BY s.product_name"""

RFM_BASE = """SELECT customer_id,
      CAST(date_diff('day', max(sale_date), (SELECT max(sale_date) FROM s_sale)) AS INTEGER) AS recency_days,
      count(*) AS frequency, sum(CAST(units AS DECIMAL(38,0)) * unit_price) AS money
    FROM s_sale GROUP BY customer_id"""

RFM_SCORES = """SELECT *, CAST(ntile(5) OVER (ORDER BY recency_days DESC, customer_id) AS INTEGER) AS r_score,
      CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS f_score,
      CAST(ntile(5) OVER (ORDER BY money, customer_id) AS INTEGER) AS m_score
    FROM q_rfm_base"""

EXTRA = {
    "q_season_units": SEASON_UNITS,
    "q_site_output": SITE_OUTPUT,
    "q_waste_by_product": WASTE_BY_PRODUCT,
    "q_rfm_base": RFM_BASE,
    "q_rfm_scores": RFM_SCORES,
}


def _q(body: str) -> str:
    return with_ctes(body, EXTRA)


def _years_customers(lo: str, hi: str, inclusive: bool) -> str:
    op = "<=" if inclusive else "<"
    return f"SELECT DISTINCT customer_id FROM s_sale WHERE sale_date >= DATE '{lo}' AND sale_date {op} DATE '{hi}'"


SQL = {
    "q01_volume_by_product": _q("""SELECT p.name, CAST(sum(v.units) AS BIGINT) AS total_units
        FROM s_sale v JOIN s_product p ON p.product_id = v.product_id GROUP BY p.name"""),
    "q02_value_by_product": _q(f"""SELECT name, total_units,
          {half_up('CAST(val * 100 AS HUGEINT)', 'total_units', 2, 2)} AS weighted_price,
          CAST(val AS DOUBLE) AS total_value
        FROM (SELECT p.name, CAST(sum(v.units) AS BIGINT) AS total_units, sum({VAL}) AS val
              FROM s_sale v JOIN s_product p ON p.product_id = v.product_id GROUP BY p.name)"""),
    "q03_output_by_site": _q("SELECT site_id, product_name, total_units FROM q_site_output"),
    "q04_yield_per_area_top": _q(f"""SELECT site_id, product_name, CAST(area AS DOUBLE) AS area, total_units,
          {half_up('total_units * 100', 'CAST(area * 100 AS BIGINT)', 0)} AS units_per_area
        FROM q_site_output ORDER BY total_units DESC, site_id LIMIT 3"""),
    "q04b_yield_per_area_ranked": _q(f"""SELECT * FROM (SELECT site_id, product_name, CAST(area AS DOUBLE) AS area, total_units,
          {half_up('total_units * 100', 'CAST(area * 100 AS BIGINT)', 0)} AS units_per_area
        FROM q_site_output) ORDER BY units_per_area DESC, total_units DESC, site_id LIMIT 3"""),
    "q05_waste_by_product": _q("SELECT name, waste_units FROM q_waste_by_product"),
    "q06_waste_pct": _q(f"""SELECT o.name, o.total_units, w.waste_units,
          {half_up('w.waste_units * 100', 'o.total_units', 2)} AS waste_pct
        FROM (SELECT product_name AS name, CAST(sum(total_units) AS BIGINT) AS total_units
              FROM q_site_output GROUP BY product_name) o
        JOIN q_waste_by_product w ON o.name = w.name"""),
    "q07_lapsed_customers": _q(f"""SELECT a.customer_id FROM ({_years_customers('2000-01-01', '2001-01-01', False)}) a
        LEFT JOIN ({_years_customers('2001-01-01', '2001-12-31', True)}) b ON a.customer_id = b.customer_id
        WHERE b.customer_id IS NULL"""),
    "q07b_lapsed_except": _q(f"""{_years_customers('2000-01-01', '2001-01-01', False)}
        EXCEPT {_years_customers('2001-01-01', '2001-12-31', True)}"""),
    "q08_value_by_customer": _q(f"""SELECT c.customer_id, c.name, CAST(sum({VAL}) AS DOUBLE) AS total_value
        FROM s_sale v JOIN s_customer c ON v.customer_id = c.customer_id GROUP BY c.customer_id, c.name"""),
    "q09_price_by_customer_kind": _q(f"""SELECT kind, n_sales, total_units,
          {half_up('CAST(val * 100 AS HUGEINT)', 'total_units', 2, 2)} AS weighted_price
        FROM (SELECT c.kind, count(*) AS n_sales, CAST(sum(v.units) AS BIGINT) AS total_units, sum({VAL}) AS val
              FROM s_sale v JOIN s_customer c ON v.customer_id = c.customer_id GROUP BY c.kind)"""),
    "q10_season_weekly_mean": _q("SELECT season, year, total_units, weekly_mean FROM q_season_units"),
    "q11_monthly_trend": _q(f"""SELECT CAST(date_trunc('month', v.sale_date) AS DATE) AS month,
          CAST(sum(v.units) AS BIGINT) AS total_units, CAST(sum({VAL}) AS DOUBLE) AS total_value
        FROM s_sale v GROUP BY 1"""),
    "q12_quarterly_trend": _q(f"""SELECT CAST(date_trunc('quarter', v.sale_date) AS DATE) AS quarter,
          CAST(sum(v.units) AS BIGINT) AS total_units, CAST(sum({VAL}) AS DOUBLE) AS total_value
        FROM s_sale v GROUP BY 1"""),
    "q13_quarter_delta": _q(f"""SELECT quarter, CAST(val AS DOUBLE) AS total_value,
          CAST(lag(val) OVER (ORDER BY quarter) AS DOUBLE) AS previous_value,
          CAST(val - lag(val) OVER (ORDER BY quarter) AS DOUBLE) AS difference
        FROM (SELECT CAST(date_trunc('quarter', v.sale_date) AS DATE) AS quarter, sum({VAL}) AS val
              FROM s_sale v GROUP BY 1)"""),
    "q14_season_pivot": _q("""SELECT year,
          CAST(sum(CASE WHEN season = 'San Valentin' THEN weekly_mean END) AS BIGINT) AS mean_peak1,
          CAST(sum(CASE WHEN season = 'Dia de la Madre' THEN weekly_mean END) AS BIGINT) AS mean_peak2,
          CAST(sum(CASE WHEN season = 'Normal' THEN weekly_mean END) AS BIGINT) AS mean_normal,
          CAST(sum(CASE WHEN season = 'San Valentin' THEN weekly_mean END)
             - sum(CASE WHEN season = 'Normal' THEN weekly_mean END) AS BIGINT) AS diff_peak1_vs_normal,
          CAST(sum(CASE WHEN season = 'Dia de la Madre' THEN weekly_mean END)
             - sum(CASE WHEN season = 'Normal' THEN weekly_mean END) AS BIGINT) AS diff_peak2_vs_normal
        FROM q_season_units GROUP BY year"""),
    "q15_rfm_basic": _q(f"""SELECT customer_id, r_score, f_score, m_score,
          {half_up('r_score + f_score + m_score', '3', 1)} AS score_mean,
          CASE WHEN r_score + f_score + m_score >= 12 THEN 'Champion'
               WHEN r_score + f_score + m_score >= 9 THEN 'Cliente valioso'
               ELSE 'En riesgo / basico' END AS segment
        FROM q_rfm_scores"""),
}
