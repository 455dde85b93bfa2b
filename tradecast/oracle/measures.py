"""Oracle SQL for the semantic-layer measures (DuckDB dialect)."""

from __future__ import annotations

from tradecast.oracle.base import with_ctes
from tradecast.oracle.marts import EXTRA as M_EXTRA
from tradecast.oracle.marts import g4

MONTHS = "['enero','febrero','marzo','abril','mayo','junio','julio','agosto','septiembre','octubre','noviembre','diciembre']"
MONTHS_SHORT = "['ene','feb','mar','abr','may','jun','jul','ago','sep','oct','nov','dic']"
DAYS = "['lunes','martes','miércoles','jueves','viernes','sábado','domingo']"


def weeknum(d: str) -> str:
    return f"CAST((dayofyear({d}) - 1 + isodow(make_date(year({d}), 1, 1)) - 1) // 7 + 1 AS INTEGER)"


def yw(y: str, w: str) -> str:
    return f"(CAST({y} AS VARCHAR) || '-' || lpad(CAST({w} AS VARCHAR), 2, '0'))"


EXTRA = {
    **M_EXTRA,
    "m_bounds": """SELECT CAST(date_trunc('month', min(sale_date)) AS DATE) AS s, last_day(max(sale_date)) AS e FROM s_sale""",
    "m_cal": """SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
        FROM m_bounds""",
    "m_mart": """SELECT CAST(date_trunc('month', v.sale_date) AS DATE) AS month, CAST(year(v.sale_date) AS INTEGER) AS year,
        v.units, v.value_total, p.name AS product_name, p.kind AS product_kind, c.country, c.kind AS customer_kind
        FROM s_sale v JOIN s_product p ON v.product_id = p.product_id JOIN s_customer c ON v.customer_id = c.customer_id""",
    "m_month_value": "SELECT month, sum(value_total) AS v FROM m_mart GROUP BY month",
    "m_prev_year": """SELECT CAST(year(c.date) AS INTEGER) AS year, sum(mv.v) AS prev
        FROM m_cal c JOIN m_cal c2 ON c2.date = CAST(c.date - INTERVAL 12 MONTH AS DATE)
        JOIN m_month_value mv ON mv.month = c2.date GROUP BY 1""",
    "m_prev_month": """SELECT CAST(date_trunc('month', c.date) AS DATE) AS month, sum(mv.v) AS prev
        FROM m_cal c JOIN m_cal c2 ON c2.date = CAST(c.date - INTERVAL 1 MONTH AS DATE)
        JOIN m_month_value mv ON mv.month = c2.date GROUP BY 1""",
    "m_year_cur": "SELECT year, sum(value_total) AS cur, CAST(sum(units) AS BIGINT) AS units FROM m_mart GROUP BY year",
    "m_month_cur": "SELECT month, sum(value_total) AS cur FROM m_mart GROUP BY month",
}


def q(body: str) -> str:
    return with_ctes(body, EXTRA)


GROWTH = "CASE WHEN prev IS NULL OR prev = 0 THEN NULL ELSE CAST(cur - prev AS DOUBLE) / CAST(prev AS DOUBLE) END"

CONTEXT = {"year": "CAST(year({d}) AS INTEGER)", "month": "CAST(date_trunc('month', {d}) AS DATE)"}


def measures(by: str, dates: str, where: str = "TRUE", when: str = "TRUE") -> str:
    """All measures by one attribute and a date context; ``where`` filters the
    mart, ``when`` the dates ({d}) of the contexts."""
    def prior(months: int) -> str:
        return f"""SELECT mv.a, {CONTEXT[dates].format(d='c.date')} AS x, sum(mv.v) AS prev FROM m_cal c
            JOIN m_cal c2 ON c2.date = CAST(c.date - INTERVAL {months} MONTH AS DATE)
            JOIN (SELECT {by} AS a, month, sum(value_total) AS v FROM m_mart WHERE {where} GROUP BY 1, 2) mv ON mv.month = c2.date
            WHERE {when.format(d='c.date')} GROUP BY 1, 2"""
    def growth(prev: str) -> str:
        return f"CASE WHEN {prev} = 0 THEN NULL ELSE CAST(k.cur - {prev} AS DOUBLE) / CAST({prev} AS DOUBLE) END"
    return q(f"""SELECT k.a AS {by}, k.x AS {dates}, CAST(k.cur AS DOUBLE) AS total_sales, k.units AS total_units,
        CASE WHEN k.units = 0 THEN NULL ELSE CAST(k.cur AS DOUBLE) / CAST(k.units AS DOUBLE) END AS weighted_price,
        CAST(y.prev AS DOUBLE) AS prior_year_sales, {growth('y.prev')} AS yoy_growth,
        CAST(m.prev AS DOUBLE) AS prior_month_sales, {growth('m.prev')} AS mom_growth
        FROM (SELECT {by} AS a, {CONTEXT[dates].format(d='month')} AS x, sum(value_total) AS cur, CAST(sum(units) AS BIGINT) AS units
              FROM m_mart WHERE {where} AND {when.format(d='month')} GROUP BY 1, 2) k
        LEFT JOIN ({prior(12)}) y ON y.a = k.a AND y.x = k.x LEFT JOIN ({prior(1)}) m ON m.a = k.a AND m.x = k.x""")


SQL = {
    "measures_country_year": measures("country", "year"),
    "measures_kind_month": measures("product_kind", "month"),
    "measures_filtered": measures("customer_kind", "year", "country IN ('USA', 'France') AND product_kind IN ('SMALL', 'LARGE')",
                                  "year({d}) IN (1999, 2000)"),
    "b1_calendar": q(f"""SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month_no,
        {MONTHS}[month(date)] AS month_name, {MONTHS_SHORT}[month(date)] AS month_short,
        'Q' || CAST(quarter(date) AS VARCHAR) AS quarter, {weeknum('date')} AS week_no,
        {DAYS}[isodow(date)] AS day_name, strftime(date, '%Y-%m') AS year_month,
        {yw('year(date)', weeknum('date'))} AS year_week FROM m_cal"""),
    "b2_year_week_bridge": q(f"""SELECT w.year, w.iso_week, w.season, {yw('w.year', 'w.iso_week')} AS year_week, w.total_units,
        COALESCE(a.n, 0) AS days_weeknum_key, COALESCE(b.n, 0) AS days_iso_key
        FROM ({g4(False)}) w
        LEFT JOIN (SELECT {yw('year(date)', weeknum('date'))} AS k, count(*) AS n FROM m_cal GROUP BY 1) a
          ON a.k = {yw('w.year', 'w.iso_week')}
        LEFT JOIN (SELECT {yw('year(date)', 'week(date)')} AS k, count(*) AS n FROM m_cal GROUP BY 1) b
          ON b.k = {yw('w.year', 'w.iso_week')}"""),
    "b3_total_sales": q("SELECT year, CAST(cur AS DOUBLE) AS total_sales FROM m_year_cur"),
    "b4_total_units": q("SELECT year, units AS total_units FROM m_year_cur"),
    "b5_weighted_price": q("""SELECT year, CASE WHEN units = 0 THEN NULL ELSE CAST(cur AS DOUBLE) / CAST(units AS DOUBLE) END
        AS weighted_price FROM m_year_cur"""),
    "b6_prior_year": q("""SELECT c.year, CAST(c.cur AS DOUBLE) AS total_sales, CAST(p.prev AS DOUBLE) AS prior_year_sales
        FROM m_year_cur c LEFT JOIN m_prev_year p ON c.year = p.year"""),
    "b7_yoy_growth": q(f"""SELECT year, CAST(cur AS DOUBLE) AS total_sales, CAST(prev AS DOUBLE) AS prior_year_sales,
        {GROWTH} AS yoy_growth FROM (SELECT c.year, c.cur, p.prev FROM m_year_cur c LEFT JOIN m_prev_year p ON c.year = p.year)"""),
    "b8_mom_growth": q(f"""SELECT month, CAST(cur AS DOUBLE) AS total_sales, CAST(prev AS DOUBLE) AS prior_month_sales,
        {GROWTH} AS mom_growth FROM (SELECT c.month, c.cur, p.prev FROM m_month_cur c LEFT JOIN m_prev_month p ON c.month = p.month)"""),
    "b9_sales_by_product": q("SELECT product_name, CAST(sum(value_total) AS DOUBLE) AS total_sales FROM m_mart GROUP BY 1"),
    "b9_sales_by_country": q("SELECT country, CAST(sum(value_total) AS DOUBLE) AS total_sales FROM m_mart GROUP BY 1"),
    "b9_sales_by_month": q("SELECT month, CAST(sum(value_total) AS DOUBLE) AS total_sales FROM m_mart GROUP BY 1"),
    "b10_date_hierarchy": q(f"""SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month_no,
        {MONTHS}[month(date)] AS month_name, CAST((month(date) + 2) // 3 AS INTEGER) AS quarter_no,
        'Trim. ' || CAST((month(date) + 2) // 3 AS VARCHAR) AS quarter, CAST(day(date) AS INTEGER) AS day
        FROM (SELECT CAST(unnest(generate_series(CAST(make_date(year(s), 1, 1) AS TIMESTAMP),
                                                CAST(make_date(year(e), 12, 31) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
              FROM m_bounds)"""),
}
