"""Oracle SQL for the time-series and forecasting operators (DuckDB dialect)."""

from __future__ import annotations

from tradecast.oracle.base import dbl_round, half_up_units, week_end, with_ctes
from tradecast.oracle.marts import EXTRA as M_EXTRA

TWO_PI = 6.283185307179586  # repr(2 * math.pi)


def cal(t: str) -> str:
    d1 = f"(date_diff('day', make_date(year({t}), 2, 14), {t}) / 7.0e0)"
    d2 = f"(date_diff('day', {week_end(f'make_date(year({t}), 5, 1)')} + 7, {t}) / 7.0e0)"
    return f"""CAST(week({t}) AS INTEGER) AS target_iso_week,
        {dbl_round(f'sin(({TWO_PI!r} * week({t})) / 52.0e0)', 12)} AS sin_week,
        {dbl_round(f'cos(({TWO_PI!r} * week({t})) / 52.0e0)', 12)} AS cos_week,
        {d1} AS dist_peak1_weeks, {d2} AS dist_peak2_weeks,
        CASE WHEN {d1} BETWEEN -4.5e0 AND 0.5e0 THEN 1 ELSE 0 END AS window_peak1,
        CASE WHEN {d2} BETWEEN -4.5e0 AND 0.5e0 THEN 1 ELSE 0 END AS window_peak2"""


NAIVE = "M0 seasonal naive (t-52)"
GROWTH = "M0b naive x growth"

EXTRA = {
    **M_EXTRA,
    "t_g5": f"""SELECT v.sale_date, v.product_id, p.name AS product_name, p.kind AS product_kind, p.color AS product_color,
        sum(v.units) AS demand, sum(v.value_total) AS rev,
        CASE WHEN count(v.unit_price) > 0 THEN
          {half_up_units('sum(CAST(v.unit_price * 100 AS BIGINT))', 'count(v.unit_price)', 3, 2)} END AS pm,
        CASE WHEN week(v.sale_date) BETWEEN 3 AND 6 THEN 1 ELSE 0 END AS flag_peak1,
        CASE WHEN week(v.sale_date) BETWEEN 15 AND 18 THEN 1 ELSE 0 END AS flag_peak2
        FROM s_sale v JOIN s_product p ON v.product_id = p.product_id
        GROUP BY v.sale_date, v.product_id, p.name, p.kind, p.color""",
    "t_daily": """SELECT sale_date AS date, CAST(sum(demand) AS BIGINT) AS demand, sum(rev) AS rev,
        CAST(sum(pm) AS DOUBLE) AS pm, count(pm) AS pn, max(flag_peak1) AS f1, max(flag_peak2) AS f2
        FROM t_g5 GROUP BY sale_date""",
    "t_dense": """SELECT d.date, COALESCE(t.demand, 0) AS demand, COALESCE(CAST(t.rev AS DOUBLE), 0.0e0) AS revenue,
        COALESCE((t.pm / 1000.0e0) / t.pn, 0.0e0) AS mean_price,
        COALESCE(t.f1, 0) AS flag_peak1, COALESCE(t.f2, 0) AS flag_peak2
        FROM (SELECT CAST(unnest(generate_series(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP),
                                                 INTERVAL 1 DAY)) AS DATE) AS date FROM t_daily) d
        LEFT JOIN t_daily t ON d.date = t.date""",
    "t_weekly": f"""SELECT {week_end('date')} AS week_end, CAST(sum(demand) AS BIGINT) AS demand,
        CAST(sum(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
        {dbl_round('avg(mean_price)', 9)} AS mean_price FROM t_dense GROUP BY 1""",
    "t_wseries": f"""SELECT {week_end('sale_date')} AS week_end, CAST(product_color AS VARCHAR) AS series_id,
        CAST(sum(demand) AS BIGINT) AS demand, CAST(sum(rev) AS DOUBLE) AS revenue,
        (CAST(sum(pm) AS DOUBLE) / 1000.0e0) / count(pm) AS mean_price FROM t_g5 GROUP BY 1, 2""",
    "t_panel": """SELECT w.week_end, s.series_id, COALESCE(x.demand, 0) AS demand, x.revenue, x.mean_price
        FROM (SELECT DISTINCT week_end FROM t_wseries) w CROSS JOIN (SELECT DISTINCT series_id FROM t_wseries) s
        LEFT JOIN t_wseries x ON x.week_end = w.week_end AND x.series_id = s.series_id""",
    # E3
    "e_x": """SELECT week_end, CAST(demand AS DOUBLE) AS y, row_number() OVER (ORDER BY week_end) - 1 AS idx,
        lag(CAST(demand AS DOUBLE), 26) OVER (ORDER BY week_end) AS l,
        lead(CAST(demand AS DOUBLE), 26) OVER (ORDER BY week_end) AS r,
        sum(CAST(demand AS DOUBLE)) OVER (ORDER BY week_end ROWS BETWEEN 25 PRECEDING AND 25 FOLLOWING) AS core
        FROM t_weekly""",
    "e_tr": """SELECT week_end, y, idx % 52 AS phase,
        CASE WHEN l IS NOT NULL AND r IS NOT NULL THEN (core + 0.5e0 * (l + r)) / 52.0e0 END AS trend FROM e_x""",
    "e_ph": """SELECT phase, pm - avg(pm) OVER () AS seasonal FROM (SELECT phase, avg(y - trend) AS pm FROM e_tr GROUP BY phase)""",
    # E4
    "a_x": "SELECT demand, row_number() OVER (ORDER BY week_end) AS idx FROM t_weekly",
    "a_d": "SELECT idx, demand - (SELECT avg(demand) FROM a_x) AS d FROM a_x",
    # M2
    "f_panel": "SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY week_end) - 1 AS idx FROM t_panel",
    "f_origin": f"""SELECT series_id, idx, week_end AS origin_date, demand AS y_T,
        lag(demand, 1) OVER w AS y_T_1, lag(demand, 2) OVER w AS y_T_2, lag(demand, 3) OVER w AS y_T_3,
        avg(demand) OVER (PARTITION BY series_id ORDER BY idx ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS ma_4,
        avg(demand) OVER (PARTITION BY series_id ORDER BY idx ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS ma_12,
        {dbl_round('stddev_samp(demand) OVER (PARTITION BY series_id ORDER BY idx ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)', 6)} AS std_8,
        sum(demand) OVER (PARTITION BY series_id ORDER BY idx ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS recent8,
        CASE WHEN idx >= 59
             THEN sum(demand) OVER (PARTITION BY series_id ORDER BY idx ROWS BETWEEN 59 PRECEDING AND 52 PRECEDING)
             ELSE sum(demand) OVER (PARTITION BY series_id ORDER BY idx ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) END AS ly8
        FROM f_panel WINDOW w AS (PARTITION BY series_id ORDER BY idx)""",
    "f_feat": f"""SELECT r.series_id, r.origin_date, CAST(h.horizon AS INTEGER) AS horizon, t.week_end AS target_date,
        t.demand AS y_target, COALESCE(CAST(p.demand AS DOUBLE), r.ma_12) AS y_lag_52,
        r.y_T, r.y_T_1, r.y_T_2, r.y_T_3, r.ma_4, r.ma_12, r.std_8,
        (r.recent8 + 1.0e0) / (r.ly8 + 1.0e0) AS growth, {cal('t.week_end')}
        FROM f_origin r
        JOIN (SELECT range AS horizon FROM range(1, 13)) h ON TRUE
        JOIN f_panel t ON t.series_id = r.series_id AND t.idx = r.idx + h.horizon
        LEFT JOIN f_panel p ON p.series_id = r.series_id AND p.week_end = CAST(t.week_end - INTERVAL 364 DAY AS DATE)
        WHERE r.idx >= 52 AND r.idx <= (SELECT count(DISTINCT week_end) FROM f_panel) - 13""",
    "f_test": "SELECT * FROM f_feat WHERE target_date >= DATE '2001-01-01'",
    "f_pred": f"""SELECT series_id, origin_date, horizon, target_date, y_target, window_peak1,
          '{NAIVE}' AS model, greatest(y_lag_52, 0.0e0) AS pred FROM f_test
        UNION ALL SELECT series_id, origin_date, horizon, target_date, y_target, window_peak1,
          '{GROWTH}', greatest(y_lag_52 * growth, 0.0e0) FROM f_test""",
    "f_curve": f"""SELECT target_date, CAST(sum(CASE WHEN model = '{NAIVE}' THEN y_target END) AS BIGINT) AS actual,
        max(window_peak1) AS window_peak1,
        {dbl_round(f"sum(CASE WHEN model = '{NAIVE}' THEN pred END)", 6)} AS pred_naive,
        {dbl_round(f"sum(CASE WHEN model = '{GROWTH}' THEN pred END)", 6)} AS pred_growth
        FROM f_pred WHERE horizon = 12 GROUP BY target_date""",
    "f_cap": f"""SELECT a / 100.0e0 AS total_area, CAST({half_up_units('a * 1190000', '10000', 0)} AS BIGINT) AS capacity_base
        FROM (SELECT CAST(sum(area * 100) AS BIGINT) AS a FROM s_site)""",
}


def metrics_sql(where: str = "") -> str:
    y, yh = "CAST(y_target AS DOUBLE)", "pred"
    cost = (f"greatest({y} - {yh}, 0.0e0) * CASE WHEN window_peak1 = 1 THEN 0.6e0 ELSE 0.35e0 END"
            f" + greatest({yh} - {y}, 0.0e0) * 0.28e0")
    return f"""SELECT model,
        {dbl_round('s_abs / s_y * 100.0e0', 2)} AS wape_pct, {dbl_round('s_abs / n', 1)} AS mae,
        {dbl_round('sqrt(s_sq / n)', 1)} AS rmse, {dbl_round('(s_yh - s_y) / s_y * 100.0e0', 2)} AS bias_pct,
        {dbl_round('s_cost', 2)} AS cost
        FROM (SELECT model, sum(abs({y} - {yh})) AS s_abs, sum({y}) AS s_y, sum({yh}) AS s_yh,
                     sum(({y} - {yh}) * ({y} - {yh})) AS s_sq, count(*) AS n, sum({cost}) AS s_cost
              FROM f_pred {where} GROUP BY model)"""


def q(body: str) -> str:
    return with_ctes(body, EXTRA)


SQL = {
    "t1_daily_global": q("""SELECT date, demand, CAST(rev AS DOUBLE) AS revenue, (pm / 1000.0e0) / pn AS mean_price,
        f1 AS flag_peak1, f2 AS flag_peak2 FROM t_daily"""),
    "t1_daily_dense": q("SELECT * FROM t_dense"),
    "t2_weekly_global": q("SELECT * FROM t_weekly"),
    "t2_weekly_product": q(f"""SELECT {week_end('sale_date')} AS week_end, product_id, product_name, product_kind,
        CAST(sum(demand) AS BIGINT) AS demand, CAST(sum(rev) AS DOUBLE) AS revenue,
        (CAST(sum(pm) AS DOUBLE) / 1000.0e0) / count(pm) AS mean_price FROM t_g5 GROUP BY 1, 2, 3, 4"""),
    "t3_dense_panel": q("SELECT * FROM t_panel"),
    "e1_rolling8": q("""SELECT week_end, demand,
        CASE WHEN count(demand) OVER w = 8 THEN avg(demand) OVER w END AS rolling_mean_8
        FROM t_weekly WINDOW w AS (ORDER BY week_end ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)"""),
    "e3_decompose": q(f"""SELECT t.week_end, t.y AS observed, {dbl_round('t.trend', 6)} AS trend,
        {dbl_round('p.seasonal', 6)} AS seasonal, {dbl_round('t.y - t.trend - p.seasonal', 6)} AS resid
        FROM e_tr t JOIN e_ph p ON t.phase = p.phase"""),
    "e4_acf": q(f"""SELECT 'all' AS series_id, CAST(l.k AS INTEGER) AS lag,
        {dbl_round('COALESCE(sum(a.d * b.d), 0.0e0) / (SELECT sum(d * d) FROM a_d)', 9)} AS acf
        FROM (SELECT range AS k FROM range(1, 56)) l JOIN a_d a ON TRUE JOIN a_d b ON b.idx = a.idx - l.k
        GROUP BY l.k"""),
    "e5_product_share_top15": q("""SELECT product_name, product_kind, CAST(sum(demand) AS BIGINT) AS total_units,
        CAST(sum(rev) AS DOUBLE) AS total_revenue, (CAST(sum(pm) AS DOUBLE) / 1000.0e0) / count(pm) AS mean_price,
        CAST(COALESCE(sum(CASE WHEN flag_peak1 = 1 THEN demand END), 0) AS BIGINT) AS peak_units,
        CAST(COALESCE(sum(CASE WHEN flag_peak1 = 1 THEN demand END), 0) AS BIGINT) * 100 / CAST(sum(demand) AS BIGINT) AS peak_pct
        FROM t_g5 GROUP BY product_name, product_kind
        ORDER BY total_units DESC, product_name, product_kind LIMIT 15"""),
    "m1_festival_calendar": q(f"""SELECT yr AS year, make_date(yr, 2, 14) AS valentines_day,
        {week_end('make_date(yr, 5, 1)')} + 7 AS mothers_day,
        CAST(week(make_date(yr, 2, 14)) AS INTEGER) AS valentines_iso_week,
        CAST(week({week_end('make_date(yr, 5, 1)')} + 7) AS INTEGER) AS mothers_iso_week
        FROM (SELECT DISTINCT CAST(year(sale_date) AS INTEGER) AS yr FROM s_sale)"""),
    "m2_direct_features": q("SELECT * FROM f_feat"),
    "m3_target_calendar": q(f"SELECT week_end AS target_date, {cal('week_end')} FROM (SELECT DISTINCT week_end FROM t_panel)"),
    "m4_time_split": q("""SELECT split, count(*) AS n_rows FROM (SELECT CASE
            WHEN target_date <= DATE '1999-12-31' THEN 'train'
            WHEN target_date BETWEEN DATE '2000-01-01' AND DATE '2000-06-30' THEN 'val'
            WHEN target_date BETWEEN DATE '2000-07-01' AND DATE '2000-12-31' THEN 'mid'
            WHEN target_date >= DATE '2001-01-01' THEN 'test' END AS split FROM f_feat) GROUP BY split
        UNION ALL SELECT 'retrain', count(*) FROM f_feat WHERE target_date <= DATE '2000-12-31'"""),
    "m5_seasonal_naive": q("""SELECT series_id, origin_date, horizon, target_date, y_target, window_peak1,
        greatest(y_lag_52, 0.0e0) AS pred FROM f_test"""),
    "m6_naive_growth": q("""SELECT series_id, origin_date, horizon, target_date, y_target, window_peak1,
        greatest(y_lag_52 * growth, 0.0e0) AS pred FROM f_test"""),
    "m9_metrics_global": q(metrics_sql()),
    "m10_metrics_h12": q(f"""SELECT *, {dbl_round('base - cost', 2)} AS saving_vs_naive,
        {dbl_round('(base - cost) / base * 100.0e0', 1)} AS saving_pct
        FROM (SELECT *, max(CASE WHEN model = '{NAIVE}' THEN cost END) OVER () AS base
              FROM ({metrics_sql('WHERE horizon = 12')}))""".replace("SELECT *, ", "SELECT model, wape_pct, mae, rmse, bias_pct, cost, ", 1)),
    "m11_h12_curve": q("SELECT target_date, actual, pred_naive, pred_growth FROM f_curve"),
    "m12_capacity": q("""SELECT c.target_date, c.actual, c.pred_naive, k.total_area, k.capacity_base,
        CAST((k.capacity_base * 324 + 100) // 200 AS BIGINT) AS capacity_max,
        CAST(c.pred_naive > k.capacity_base AS INTEGER) AS over_base,
        CAST(c.pred_naive > (k.capacity_base * 324 + 100) // 200 AS INTEGER) AS over_max
        FROM f_curve c CROSS JOIN f_cap k"""),
    "m13_newsvendor": q("""SELECT target_date, window_peak1,
        CASE WHEN window_peak1 = 1 THEN 0.6e0 ELSE 0.35e0 END AS cost_under, 0.28e0 AS cost_over,
        CASE WHEN window_peak1 = 1 THEN 0.6e0 ELSE 0.35e0 END / (CASE WHEN window_peak1 = 1 THEN 0.6e0 ELSE 0.35e0 END + 0.28e0) AS alpha
        FROM f_curve"""),
}

# Per-product panels: the same SQL with the product key as the series.
_BY_PRODUCT = ("CAST(product_color AS VARCHAR) AS series_id", "CAST(product_id AS VARCHAR) AS series_id")
for _key in ("t3_dense_panel", "m4_time_split", "m9_metrics_global", "m10_metrics_h12", "m11_h12_curve", "m12_capacity", "m13_newsvendor"):
    SQL[f"{_key}_by_product"] = SQL[_key].replace(*_BY_PRODUCT)


def feature_sums() -> str:
    whole = ["y_target", "y_T", "y_T_1", "y_T_2", "y_T_3", "target_iso_week", "window_peak1", "window_peak2"]
    parts = ["y_lag_52", "ma_4", "ma_12", "std_8", "growth", "dist_peak1_weeks", "dist_peak2_weeks"]
    return q(f"""SELECT CASE WHEN target_date <= DATE '1999-12-31' THEN 'train'
            WHEN target_date BETWEEN DATE '2000-01-01' AND DATE '2000-06-30' THEN 'val'
            WHEN target_date BETWEEN DATE '2000-07-01' AND DATE '2000-12-31' THEN 'mid'
            WHEN target_date >= DATE '2001-01-01' THEN 'test' END AS split, horizon,
        count(*) AS n_rows, count(DISTINCT series_id) AS n_series,
        {', '.join(f'CAST(sum({x}) AS BIGINT) AS sum_{x}' for x in whole)},
        {', '.join(f'CAST(sum(CAST(floor({x} * 1000 + 0.5e0) AS BIGINT)) AS BIGINT) AS milli_{x}' for x in parts)}
        FROM f_feat GROUP BY 1, 2""")


SQL["m2_feature_sums"] = feature_sums()
SQL["m2_feature_sums_by_product"] = feature_sums().replace(*_BY_PRODUCT)
SQL["e4_pacf"] = q(f"""SELECT 'all' AS series_id, lag, {dbl_round('p', 6)} AS pacf FROM (
    WITH RECURSIVE lags AS (SELECT list(acf ORDER BY lag) AS r FROM ({SQL['e4_acf']})),
    fold AS (
      SELECT CAST(1 AS INTEGER) AS lag, [r[1]] AS phi, r[1] AS p, r FROM lags
      UNION ALL
      SELECT lag + 1, list_append(list_transform(range(1, lag + 1), lambda j: phi[j] - a * phi[lag + 1 - j]), a), a, r
      FROM (SELECT *, (r[lag + 1] - list_sum(list_transform(range(1, lag + 1), lambda j: phi[j] * r[lag + 1 - j])))
                      / (1 - list_sum(list_transform(range(1, lag + 1), lambda j: phi[j] * r[j]))) AS a
            FROM fold WHERE lag < 55))
    SELECT lag, p FROM fold)""")
# Exact SQL twin of the per-product supervised set (millions of rows at sf0.01):
# kept out of the driver's gate, compared in full at sf0.001 by tests/test_scale_paths.py.
SLOW_SQL = {"m2_direct_features_by_product": SQL["m2_direct_features"].replace(*_BY_PRODUCT)}


def adf(source: str) -> str:
    """The ADF test of each series of ``source`` by successive orthogonalisation
    of the regressors (no moments), and the normal distribution by Simpson's rule."""
    def eliminate(name: str, start: str, last: str) -> str:
        """Column after column is taken out of those behind it."""
        return f"""{name} AS (
          SELECT series_id, 0 AS j, {last} AS upto, cols FROM {start}
          UNION ALL
          SELECT series_id, j + 1, upto, list_transform(cols, lambda c, i: CASE WHEN i <= j + 1 THEN c ELSE
            list_transform(list_zip(c, cols[j + 1]), lambda e: e[1] - e[2] *
              (list_dot_product(c, cols[j + 1]) / list_dot_product(cols[j + 1], cols[j + 1]))) END)
          FROM {name} WHERE j < upto)"""

    def lagged(lags: str) -> str:
        return f"list_transform(range(1, {lags} + 1), lambda j: list_transform(range({lags} + 1, n), lambda t: d[t - j]))"

    def column(what: str, lags: str) -> str:
        return f"list_transform(range({lags} + 1, n), lambda t: {what})"

    crit = {c: f"{b[0]}e0 + {b[1]}e0 / n_obs + {b[2]}e0 / (n_obs * n_obs) + {b[3]}e0 / (n_obs * n_obs * n_obs)" for c, b in {
        "1": (-3.43035, -6.5393, -16.786, -79.433), "5": (-2.86154, -2.8903, -4.234, -40.040), "10": (-2.56677, -1.5384, -2.809, 0.0)}.items()}
    return q(f"""SELECT * FROM (
    WITH RECURSIVE src AS (SELECT series_id, list(CAST(demand AS DOUBLE) ORDER BY week_end) AS y, CAST(count(*) AS INTEGER) AS n FROM {source} GROUP BY series_id),
    lev AS (SELECT series_id, n, least(CAST(ceil(12 * pow(n / 100.0e0, 0.25e0)) AS INTEGER), n // 2 - 2) AS p,
                   list_transform(y, lambda v: (v - list_avg(y)) / list_stddev_samp(y)) AS x FROM src),
    dif AS (SELECT *, list_transform(range(1, n), lambda t: x[t + 1] - x[t]) AS d FROM lev WHERE p >= 0),
    wide AS (SELECT series_id, n, p, list_concat(list_concat([{column('1.0e0', 'p')}, {column('x[t]', 'p')}], {lagged('p')}), [{column('d[t]', 'p')}]) AS cols FROM dif),
    {eliminate('g', 'wide', 'p + 2')},
    fits AS (SELECT g.series_id, j - 2 AS k, n - 1 - p AS nobs, list_dot_product(g.cols[-1], g.cols[-1]) AS ssr FROM g JOIN wide USING (series_id) WHERE j >= 2),
    pick AS (SELECT series_id, CAST(arg_min(k, nobs * (ln({TWO_PI!r}) + ln(ssr / nobs) + 1) + 2 * (k + 2)) AS INTEGER) AS k FROM fits GROUP BY series_id),
    wide2 AS (SELECT series_id, n, k, list_concat(list_concat([{column('1.0e0', 'k')}], {lagged('k')}), [{column('x[t]', 'k')}, {column('d[t]', 'k')}]) AS cols
              FROM dif JOIN pick USING (series_id)),
    {eliminate('h', 'wide2', 'k + 1')},
    res AS (SELECT h.series_id, k AS used_lag, n - 1 - k AS n_obs, list_dot_product(h.cols[-1], h.cols[-2]) AS tr, list_dot_product(h.cols[-2], h.cols[-2]) AS rr,
                   list_dot_product(h.cols[-1], h.cols[-1]) AS tt FROM h JOIN wide2 USING (series_id) WHERE j = upto),
    st AS (SELECT *, (tr / rr) / sqrt((tt - tr * tr / rr) / (n_obs - used_lag - 2) / rr) AS t FROM res),
    pz AS (SELECT *, CASE WHEN t <= -1.61e0 THEN 2.1659e0 + 1.4412e0 * t + 0.038269e0 * t * t
                          ELSE 1.7339e0 + 0.93202e0 * t - 0.12745e0 * t * t - 0.010368e0 * t * t * t END AS z FROM st),
    pv AS (SELECT *, CASE WHEN t < -18.83e0 THEN 0.0e0 WHEN t > 2.74e0 THEN 1.0e0 ELSE 0.5e0 + z / 6000 / sqrt({TWO_PI!r}) * list_sum(list_transform(range(0, 2001), lambda i:
             exp(-(z * i / 2000) * (z * i / 2000) / 2) * CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)) END AS p_value FROM pz)
    SELECT series_id, CAST(n_obs AS INTEGER) AS n_obs, used_lag, {dbl_round('t', 6)} AS adf_stat, {dbl_round('p_value', 6)} AS p_value,
           {', '.join(f"{dbl_round(f'({x})', 6)} AS crit_{c}pct" for c, x in crit.items())}, CAST(t < {crit['5']} AS INTEGER) AS stationary_5pct FROM pv)""")


SQL["e2_adf"] = adf("(SELECT 'all' AS series_id, week_end, demand FROM t_weekly)")
SQL["e2_adf_by_series"] = adf("t_panel")
