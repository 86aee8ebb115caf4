"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each twin is written independently in plain SQL over the driver tables.  CTEs
are kept in one dictionary and a query names the ones it needs; ``compose``
emits them in dependency order inside one ``WITH``.  Double outputs are
rounded to 6 decimals in both engines (``+ 0.0`` folds a negative zero), since
the two engines may sum a frame in different orders.
"""

from __future__ import annotations

import re

from ..config import (DRIVER_PANEL_THRESHOLDS as T, FACTOR_LABELS, RISK_SUMMARY, RISK_SUMMARY_ELSE, SERIES,
                      RECESSION_INTERVALS)

K = "c_mktsegment"
CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body


def _deps(body: str) -> list[str]:
    words = set(re.findall(r"\b([a-z_][a-z0-9_]*)\b", body))
    return [n for n in CTES if n in words]


def compose(select: str, doubles: tuple[str, ...] = ()) -> str:
    order: list[str] = []

    def visit(n: str, stack=()):
        if n in order:
            return
        for d in _deps(CTES[n]):
            if d != n and d not in stack:
                visit(d, stack + (n,))
        order.append(n)

    for d in _deps(select):
        visit(d)
    sql = select
    if order:
        sql = "WITH " + ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in order) + "\n" + select
    if doubles:
        rep = ", ".join(f"CAST(round(CAST({c} AS DECIMAL(38,9)), 6) AS DOUBLE) AS {c}" for c in doubles)
        sql = f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"
    return sql


W = f"PARTITION BY {K} ORDER BY period_date_key"


def pct(x: str, n: int, w: str = "w") -> str:
    return f"(({x}) - lag({x}, {n}) OVER {w}) / nullif(lag({x}, {n}) OVER {w}, 0) * 100"


# --------------------------------------------------------------------------
# Observation panel (market segment = economy)
# --------------------------------------------------------------------------
cte("om", f"""
  SELECT c.{K}, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS m,
         count(*) AS n_orders,
         sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS sum_price,
         count(*) FILTER (WHERE o.o_orderstatus = 'F') AS n_f,
         max(o.o_orderdate) AS last_ts
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2""")
cte("lm", f"""
  SELECT c.{K}, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS m,
         count(*) AS n_lines,
         sum(CAST(l.l_discount AS DECIMAL(12,2))) AS sum_disc,
         sum(l.l_extendedprice / nullif(l.l_quantity, 0)) AS sum_unit,
         max(l.l_shipdate) AS last_ts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2""")
cte("gq", f"""
  SELECT {K}, CAST(date_trunc('quarter', m) AS DATE) AS m, sum(sum_price) AS sum_price, max(last_ts) AS last_ts
  FROM om GROUP BY 1, 2""")
cte("obs", f"""
  SELECT {K}, 'HOUST' AS series_id, m AS observation_date, CAST(n_orders AS DOUBLE) AS value, last_ts AS ingested_at FROM om
  UNION ALL SELECT {K}, 'UMCSENT', m, CAST(sum_price AS DOUBLE) / n_orders / 2500.0, last_ts FROM om
  UNION ALL SELECT {K}, 'UNRATE', m, CAST(n_f * 100 AS DOUBLE) / n_orders, last_ts FROM om
  UNION ALL SELECT {K}, 'GDPC1', m, CAST(sum_price AS DOUBLE) / 1000000.0, last_ts FROM gq
  UNION ALL SELECT {K}, 'FEDFUNDS', m, CAST(sum_disc * 100 AS DOUBLE) / n_lines, last_ts FROM lm
  UNION ALL SELECT {K}, 'CPIAUCSL', m, sum_unit / n_lines / 10.0, last_ts FROM lm""")

STG_NAME = {"GDPC1": "stg_gdp", "CPIAUCSL": "stg_cpi", "UNRATE": "stg_unemployment_rate",
            "FEDFUNDS": "stg_federal_funds_rate", "UMCSENT": "stg_consumer_sentiment", "HOUST": "stg_housing_starts"}

for _s in SERIES:
    cte(STG_NAME[_s.series_id], f"""
  SELECT {K}, observation_date AS period_date, CAST(observation_date AS DATE) AS period_date_key,
         series_id AS series_code, CAST(value AS DECIMAL({_s.precision},{_s.scale})) AS {_s.value_col},
         'FRED' AS data_source, '{_s.indicator_type}' AS indicator_type, '{_s.series_id}' AS indicator_name,
         CAST(ingested_at AS TIMESTAMP) AS loaded_at,
         row_number() OVER (PARTITION BY {K} ORDER BY observation_date DESC) = 1 AS is_latest
  FROM obs WHERE series_id = '{_s.series_id}' AND value IS NOT NULL""")

META = "data_source, indicator_type, indicator_name, loaded_at, is_latest"

cte("int_gdp", f"""
  SELECT {K}, period_date, period_date_key, series_code, gdp_billions_usd, qoq_growth_pct, yoy_growth_pct,
         coalesce(qoq_growth_pct < 0, false) AS is_qoq_negative_growth,
         coalesce(yoy_growth_pct < 0, false) AS is_yoy_negative_growth, {META}
  FROM (SELECT *, {pct('CAST(gdp_billions_usd AS DOUBLE)', 1)} AS qoq_growth_pct,
               {pct('CAST(gdp_billions_usd AS DOUBLE)', 4)} AS yoy_growth_pct
        FROM stg_gdp WINDOW w AS ({W})) g""")

cte("int_cpi", f"""
  SELECT {K}, period_date, period_date_key, series_code, cpi_index, yoy_inflation_rate_pct, mom_change_pct,
         avg(mom_change_pct) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3m_inflation_pct,
         CASE WHEN yoy_inflation_rate_pct <= {T.inflation_mild} THEN 'Mild'
              WHEN yoy_inflation_rate_pct <= {T.inflation_moderate} THEN 'Moderate'
              WHEN yoy_inflation_rate_pct <= {T.inflation_high} THEN 'High' ELSE 'Severe' END
           AS inflation_severity_category, {META}
  FROM (SELECT *, {pct('CAST(cpi_index AS DOUBLE)', 12)} AS yoy_inflation_rate_pct,
               {pct('CAST(cpi_index AS DOUBLE)', 1)} AS mom_change_pct
        FROM stg_cpi WINDOW w AS ({W})) c
  WINDOW w AS ({W})""")

cte("int_labor", f"""
  SELECT {K}, period_date, period_date_key, series_code, unemployment_rate_pct, yoy_change_pct, mom_change_pct,
         rolling_3m_avg_pct, trend_direction,
         coalesce(unemployment_rate_pct < {T.healthy_unemp_rate} AND trend_direction IN ('Declining', 'Flat'), false)
           AS is_labor_market_healthy, {META}
  FROM (SELECT *, {pct('CAST(unemployment_rate_pct AS DOUBLE)', 12)} AS yoy_change_pct,
          CAST(unemployment_rate_pct AS DOUBLE) - lag(CAST(unemployment_rate_pct AS DOUBLE)) OVER w AS mom_change_pct,
          avg(CAST(unemployment_rate_pct AS DOUBLE)) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3m_avg_pct,
          CASE WHEN unemployment_rate_pct > lag(unemployment_rate_pct) OVER w THEN 'Rising'
               WHEN unemployment_rate_pct < lag(unemployment_rate_pct) OVER w THEN 'Declining' ELSE 'Flat' END
            AS trend_direction
        FROM stg_unemployment_rate WINDOW w AS ({W})) u""")

cte("fin_f", f"""
  SELECT {K}, period_date, period_date_key, fedfunds_rate_pct,
         CAST(fedfunds_rate_pct AS DOUBLE) - lag(CAST(fedfunds_rate_pct AS DOUBLE)) OVER w AS rate_change_bps,
         CASE WHEN fedfunds_rate_pct > lag(fedfunds_rate_pct) OVER w THEN 'Rising'
              WHEN fedfunds_rate_pct < lag(fedfunds_rate_pct) OVER w THEN 'Falling' ELSE 'Flat' END AS rate_direction
  FROM stg_federal_funds_rate WINDOW w AS ({W})""")
cte("fin_s", f"""
  SELECT {K}, period_date, period_date_key, sentiment_index,
         {pct('CAST(sentiment_index AS DOUBLE)', 12)} AS yoy_change_pct,
         CASE WHEN sentiment_index > {T.sentiment_pivot} THEN 'Optimistic'
              WHEN sentiment_index < {T.sentiment_pivot} THEN 'Pessimistic' ELSE 'Neutral' END AS sentiment_outlook
  FROM stg_consumer_sentiment WINDOW w AS ({W})""")
cte("int_fin", f"""
  SELECT coalesce(f.{K}, s.{K}) AS {K}, coalesce(f.period_date, s.period_date) AS period_date,
         coalesce(f.period_date_key, s.period_date_key) AS period_date_key,
         f.fedfunds_rate_pct, f.rate_change_bps, f.rate_direction, s.sentiment_index,
         s.yoy_change_pct AS sentiment_yoy_change_pct, s.sentiment_outlook,
         CASE WHEN f.rate_direction = 'Rising' AND s.sentiment_outlook = 'Pessimistic' THEN true ELSE false END
           AS is_financial_stress_elevated
  FROM fin_f f FULL OUTER JOIN fin_s s ON f.{K} = s.{K} AND f.period_date_key = s.period_date_key""")

_roll_parts = []
for _sid, _lab, _cat, _stg, _col in (("CPIAUCSL", "CPI", "Inflation", "stg_cpi", "cpi_index"),
                                     ("UNRATE", "Unemployment Rate", "Labor Market", "stg_unemployment_rate", "unemployment_rate_pct"),
                                     ("FEDFUNDS", "Federal Funds Rate", "Monetary Policy", "stg_federal_funds_rate", "fedfunds_rate_pct"),
                                     ("UMCSENT", "Consumer Sentiment", "Consumer Confidence", "stg_consumer_sentiment", "sentiment_index"),
                                     ("HOUST", "Housing Starts", "Construction Activity", "stg_housing_starts", "housing_starts_thousands")):
    _roll_parts.append(f"""
  SELECT {K}, period_date_key, '{_lab}' AS indicator_type,
         avg(CAST({_col} AS DOUBLE)) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3m_avg,
         avg(CAST({_col} AS DOUBLE)) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS rolling_6m_avg,
         avg(CAST({_col} AS DOUBLE)) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS rolling_12m_avg,
         '{_cat}' AS metric_category
  FROM {_stg} WINDOW w AS ({W})""")
cte("int_rolling", "\n  UNION ALL".join(_roll_parts))

cte("int_recession_base", f"""
  SELECT g.{K}, g.period_date_key, g.gdp_billions_usd, g.qoq_growth_pct, g.yoy_growth_pct, g.is_qoq_negative_growth,
         u.unemployment_rate_pct, u.yoy_change_pct AS unemployment_yoy_change_pct,
         i.yoy_inflation_rate_pct, i.inflation_severity_category, s.sentiment_index, s.sentiment_outlook,
         count(CASE WHEN g.is_qoq_negative_growth THEN 1 END)
           OVER (PARTITION BY g.{K} ORDER BY g.period_date_key ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)
           AS consecutive_negative_quarters
  FROM int_gdp g
  LEFT JOIN int_labor u ON g.{K} = u.{K} AND g.period_date_key = u.period_date_key
  LEFT JOIN int_cpi i ON g.{K} = i.{K} AND g.period_date_key = i.period_date_key
  LEFT JOIN int_fin s ON g.{K} = s.{K} AND g.period_date_key = s.period_date_key""")
cte("int_recession", f"""
  SELECT {K}, period_date_key, gdp_billions_usd, qoq_growth_pct, yoy_growth_pct, unemployment_rate_pct,
         unemployment_yoy_change_pct, yoy_inflation_rate_pct, inflation_severity_category, sentiment_index,
         sentiment_outlook, consecutive_negative_quarters,
         CASE WHEN consecutive_negative_quarters >= {T.consecutive_negative_quarters} THEN 'High'
              WHEN is_qoq_negative_growth AND unemployment_yoy_change_pct > {T.risk_unemp_yoy_high} THEN 'High'
              WHEN (is_qoq_negative_growth OR yoy_growth_pct < {T.risk_gdp_yoy_low}) AND sentiment_outlook = 'Pessimistic' THEN 'Moderate'
              WHEN yoy_growth_pct BETWEEN {T.risk_emerging_lo} AND {T.risk_emerging_hi}
                   AND unemployment_yoy_change_pct > {T.risk_emerging_unemp_yoy} THEN 'Emerging'
              ELSE 'Low' END AS recession_risk_level,
         CAST(CASE WHEN is_qoq_negative_growth THEN 3 ELSE 0 END
            + CASE WHEN yoy_growth_pct < {T.intensity_gdp_yoy_neg} THEN 5 WHEN yoy_growth_pct < {T.intensity_gdp_yoy_low} THEN 2 ELSE 0 END
            + CASE WHEN unemployment_rate_pct > {T.intensity_unemp_rate_hi} THEN 2 WHEN unemployment_rate_pct > {T.intensity_unemp_rate_mid} THEN 1 ELSE 0 END
            + CASE WHEN unemployment_yoy_change_pct > {T.intensity_unemp_yoy_hi} THEN 2 WHEN unemployment_yoy_change_pct > {T.intensity_unemp_yoy_mid} THEN 1 ELSE 0 END
            + CASE WHEN inflation_severity_category IN ('High', 'Severe') THEN 1 ELSE 0 END
            + CASE WHEN sentiment_outlook = 'Pessimistic' THEN 1 ELSE 0 END AS DECIMAL(5,2)) AS recession_intensity_score
  FROM int_recession_base""")

cte("q_means", f"""
  SELECT {K}, CAST(date_trunc('quarter', period_date_key) AS DATE) AS period_date_key,
         avg(unemployment_rate_pct) AS unemployment_rate_pct, avg(yoy_inflation_rate_pct) AS yoy_inflation_rate_pct,
         avg(fedfunds_rate_pct) AS fedfunds_rate_pct, avg(sentiment_index) AS sentiment_index
  FROM (SELECT {K}, period_date_key, CAST(unemployment_rate_pct AS DOUBLE) AS unemployment_rate_pct,
               NULL::DOUBLE AS yoy_inflation_rate_pct, NULL::DOUBLE AS fedfunds_rate_pct, NULL::DOUBLE AS sentiment_index FROM int_labor
        UNION ALL SELECT {K}, period_date_key, NULL, yoy_inflation_rate_pct, NULL, NULL FROM int_cpi
        UNION ALL SELECT {K}, period_date_key, NULL, NULL, CAST(fedfunds_rate_pct AS DOUBLE), NULL FROM stg_federal_funds_rate
        UNION ALL SELECT {K}, period_date_key, NULL, NULL, NULL, CAST(sentiment_index AS DOUBLE) FROM stg_consumer_sentiment) x
  GROUP BY 1, 2""")


def _corr(x: str, y: str) -> str:
    fr = "(w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"
    xx = f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN {x} END"
    yy = f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN {y} END"
    sx, sy = f"stddev_pop({xx}) OVER {fr}", f"stddev_pop({yy}) OVER {fr}"
    c = f"CASE WHEN {sx} * {sy} = 0 THEN NULL ELSE covar_pop({xx}, {yy}) OVER {fr} / ({sx} * {sy}) END"
    return f"CAST(round(CAST({c} AS DECIMAL(38,10)), 3) AS DECIMAL(18,3))"


cte("int_corr_base", f"""
  SELECT g.{K}, g.period_date_key,
         {_corr('g.gdp', 'q.unemployment_rate_pct')} AS gdp_vs_unemployment_corr,
         {_corr('q.yoy_inflation_rate_pct', 'q.fedfunds_rate_pct')} AS inflation_vs_fedfunds_corr,
         {_corr('g.gdp', 'q.sentiment_index')} AS gdp_vs_sentiment_corr,
         {_corr('q.unemployment_rate_pct', 'q.sentiment_index')} AS unemployment_vs_sentiment_corr,
         {_corr('q.yoy_inflation_rate_pct', 'q.sentiment_index')} AS inflation_vs_sentiment_corr
  FROM (SELECT {K}, period_date_key, CAST(gdp_billions_usd AS DOUBLE) AS gdp FROM int_gdp WHERE gdp_billions_usd IS NOT NULL) g
  LEFT JOIN q_means q ON g.{K} = q.{K} AND g.period_date_key = q.period_date_key
  WINDOW w AS (PARTITION BY g.{K} ORDER BY g.period_date_key)""")
cte("int_corr", f"""
  SELECT *,
    CASE WHEN gdp_vs_unemployment_corr < {T.corr_strong_inverse} THEN 'Strong Inverse'
         WHEN gdp_vs_unemployment_corr BETWEEN {T.corr_strong_inverse} AND {T.corr_moderate_inverse} THEN 'Moderate Inverse'
         WHEN gdp_vs_unemployment_corr BETWEEN {T.corr_moderate_inverse} AND {T.corr_weak} THEN 'Weak'
         ELSE 'Positive' END AS gdp_unemployment_relationship,
    CASE WHEN inflation_vs_fedfunds_corr > {T.corr_strong_positive} THEN 'Strong Positive'
         WHEN inflation_vs_fedfunds_corr > {T.corr_moderate_positive} THEN 'Moderate Positive'
         ELSE 'Weak' END AS inflation_fedfunds_relationship
  FROM int_corr_base""")

cte("spine", """
  SELECT CAST(unnest(generate_series(CAST(date_trunc('month', min(observation_date)) AS DATE),
                                     CAST(date_trunc('month', max(observation_date)) AS DATE),
                                     INTERVAL 1 MONTH)) AS DATE) AS period_date
  FROM obs""")
cte("dim_base", """
  SELECT period_date, CAST(year(period_date) AS INTEGER) AS year, CAST(quarter(period_date) AS INTEGER) AS quarter,
         CAST(month(period_date) AS INTEGER) AS month, strftime(period_date, '%B') AS month_name,
         strftime(period_date, '%b') AS month_short,
         CAST(year(period_date) AS VARCHAR) || '-Q' || CAST(quarter(period_date) AS VARCHAR) AS year_quarter,
         CAST(year(period_date) AS VARCHAR) || '-' || lpad(CAST(month(period_date) AS VARCHAR), 2, '0') AS year_month,
         CAST(weekofyear(period_date) AS INTEGER) AS week_of_year, CAST(day(period_date) AS INTEGER) AS day_of_month,
         CAST(isodow(period_date) AS INTEGER) AS day_of_week, 'Q' || CAST(quarter(period_date) AS VARCHAR) AS quarter_name
  FROM spine""")
cte("dim", """
  SELECT *,
    CASE WHEN (year = 2001 AND month >= 3) OR (year = 2001 AND month <= 11) THEN true
         WHEN (year = 2007 AND month >= 12) OR (year = 2009 AND month <= 6) THEN true
         WHEN (year = 2020 AND month >= 3) OR (year = 2020 AND month <= 4) THEN true
         ELSE false END AS is_nber_recession_period,
    CASE WHEN (year = 2001 AND month >= 3) OR (year = 2001 AND month <= 11) THEN '2001 Recession'
         WHEN (year = 2007 AND month >= 12) OR (year = 2009 AND month <= 6) THEN '2007-2009 Financial Crisis'
         WHEN (year = 2020 AND month >= 3) OR (year = 2020 AND month <= 4) THEN '2020 COVID Recession'
         ELSE NULL END AS recession_name
  FROM dim_base""")
_iv = " UNION ALL ".join(f"SELECT DATE '{a}' AS start_date, DATE '{b}' AS end_date, '{n}' AS recession_name"
                         for a, b, n in RECESSION_INTERVALS)
cte("dim_intervals", f"""
  SELECT d.*, r.recession_name IS NOT NULL AS is_nber_recession_period, r.recession_name
  FROM dim_base d LEFT JOIN ({_iv}) r ON d.period_date BETWEEN r.start_date AND r.end_date""")

cte("fct_monthly_base", f"""
  SELECT coalesce(c.{K}, u.{K}, f.{K}, s.{K}, h.{K}) AS {K},
         coalesce(c.period_date_key, u.period_date_key, f.period_date_key, s.period_date_key, h.period_date_key) AS period_date_key,
         c.cpi_index, c.yoy_inflation_rate_pct, c.inflation_severity_category, c.mom_change_pct AS cpi_mom_change_pct,
         u.unemployment_rate_pct, u.yoy_change_pct AS unemployment_yoy_change_pct, u.trend_direction AS unemployment_trend,
         u.is_labor_market_healthy, f.fedfunds_rate_pct, f.rate_direction AS fedfunds_direction,
         s.sentiment_index, s.sentiment_outlook, h.housing_starts_thousands,
         (CASE WHEN c.period_date_key IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN u.period_date_key IS NOT NULL THEN 1 ELSE 0 END
          + CASE WHEN f.period_date_key IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN s.period_date_key IS NOT NULL THEN 1 ELSE 0 END
          + CASE WHEN h.period_date_key IS NOT NULL THEN 1 ELSE 0 END) AS data_completeness_score
  FROM int_cpi c
  FULL OUTER JOIN int_labor u ON c.{K} = u.{K} AND c.period_date_key = u.period_date_key
  FULL OUTER JOIN (SELECT * FROM int_fin WHERE fedfunds_rate_pct IS NOT NULL) f
    ON coalesce(c.{K}, u.{K}) = f.{K} AND coalesce(c.period_date_key, u.period_date_key) = f.period_date_key
  FULL OUTER JOIN (SELECT * FROM int_fin WHERE sentiment_index IS NOT NULL) s
    ON coalesce(c.{K}, u.{K}, f.{K}) = s.{K} AND coalesce(c.period_date_key, u.period_date_key, f.period_date_key) = s.period_date_key
  FULL OUTER JOIN stg_housing_starts h
    ON coalesce(c.{K}, u.{K}, f.{K}, s.{K}) = h.{K}
   AND coalesce(c.period_date_key, u.period_date_key, f.period_date_key, s.period_date_key) = h.period_date_key""")
cte("fct_monthly", f"""
  SELECT {K}, period_date_key, CAST(year(period_date_key) AS INTEGER) AS year, CAST(month(period_date_key) AS INTEGER) AS month,
         CAST(year(period_date_key) AS VARCHAR) || '-' || lpad(CAST(month(period_date_key) AS VARCHAR), 2, '0') AS year_month,
         cpi_index, yoy_inflation_rate_pct, inflation_severity_category, cpi_mom_change_pct, unemployment_rate_pct,
         unemployment_yoy_change_pct, unemployment_trend, is_labor_market_healthy, fedfunds_rate_pct, fedfunds_direction,
         sentiment_index, sentiment_outlook, housing_starts_thousands, CAST(data_completeness_score AS INTEGER) AS data_completeness_score,
         data_completeness_score >= {T.complete_min_sources} AS is_data_complete
  FROM fct_monthly_base""")

cte("qa", f"""
  SELECT {K}, CAST(date_trunc('quarter', period_date_key) AS DATE) AS period_date_key,
         avg(CAST(cpi_index AS DOUBLE)) AS avg_cpi_index, avg(yoy_inflation_rate_pct) AS avg_yoy_inflation_rate_pct,
         avg(CAST(unemployment_rate_pct AS DOUBLE)) AS avg_unemployment_rate_pct,
         avg(unemployment_yoy_change_pct) AS avg_unemployment_yoy_change_pct,
         avg(CAST(fedfunds_rate_pct AS DOUBLE)) AS avg_fedfunds_rate_pct, avg(CAST(sentiment_index AS DOUBLE)) AS avg_sentiment_index,
         avg(CAST(housing_starts_thousands AS DOUBLE)) AS avg_housing_starts_thousands
  FROM fct_monthly GROUP BY 1, 2""")
cte("fct_quarterly", f"""
  SELECT coalesce(g.{K}, qa.{K}) AS {K}, coalesce(g.period_date_key, qa.period_date_key) AS period_date_key,
         coalesce(g.period_date_key, qa.period_date_key) AS period_date_quarter,
         CAST(year(coalesce(g.period_date_key, qa.period_date_key)) AS INTEGER) AS year,
         CAST(quarter(coalesce(g.period_date_key, qa.period_date_key)) AS INTEGER) AS quarter,
         CAST(year(coalesce(g.period_date_key, qa.period_date_key)) AS VARCHAR) || '-Q'
           || CAST(quarter(coalesce(g.period_date_key, qa.period_date_key)) AS VARCHAR) AS year_quarter,
         g.gdp_billions_usd, g.qoq_growth_pct, g.yoy_growth_pct, g.is_qoq_negative_growth, g.is_yoy_negative_growth,
         qa.avg_cpi_index, qa.avg_yoy_inflation_rate_pct, qa.avg_unemployment_rate_pct, qa.avg_unemployment_yoy_change_pct,
         qa.avg_fedfunds_rate_pct, qa.avg_sentiment_index, qa.avg_housing_starts_thousands,
         rs.recession_risk_level, rs.recession_intensity_score, rs.consecutive_negative_quarters
  FROM int_gdp g
  FULL OUTER JOIN qa ON g.{K} = qa.{K} AND g.period_date_key = qa.period_date_key
  LEFT JOIN int_recession rs ON g.{K} = rs.{K} AND g.period_date_key = rs.period_date_key""")

_sum = "\n".join(f"         WHEN recession_risk_level = '{a}' THEN '{b}'" for a, b in RISK_SUMMARY)
cte("fct_recession", f"""
  SELECT {K}, period_date_key, CAST(year(period_date_key) AS INTEGER) AS year,
         CAST(quarter(period_date_key) AS INTEGER) AS quarter,
         CAST(year(period_date_key) AS VARCHAR) || '-Q' || CAST(quarter(period_date_key) AS VARCHAR) AS year_quarter,
         gdp_billions_usd, qoq_growth_pct, yoy_growth_pct, unemployment_rate_pct, unemployment_yoy_change_pct,
         yoy_inflation_rate_pct, sentiment_index, recession_risk_level, recession_intensity_score,
         consecutive_negative_quarters,
         concat_ws(', ', f1, f2, f3, f4) AS recession_contributing_factors,
         CAST((f1 IS NOT NULL)::INT + (f2 IS NOT NULL)::INT + (f3 IS NOT NULL)::INT + (f4 IS NOT NULL)::INT AS INTEGER)
           AS num_contributing_factors,
         CASE
{_sum}
         ELSE '{RISK_SUMMARY_ELSE}' END AS risk_assessment_summary
  FROM (SELECT *,
          CASE WHEN qoq_growth_pct < 0 THEN '{FACTOR_LABELS[0]}' END AS f1,
          CASE WHEN unemployment_yoy_change_pct > {T.factor_unemp_yoy} THEN '{FACTOR_LABELS[1]}' END AS f2,
          CASE WHEN yoy_inflation_rate_pct > {T.factor_inflation} THEN '{FACTOR_LABELS[2]}' END AS f3,
          CASE WHEN sentiment_index < {T.factor_sentiment} THEN '{FACTOR_LABELS[3]}' END AS f4
        FROM int_recession) r""")

cte("fct_inflation", f"""
  SELECT {K}, period_date_key, year, month, year_month, cpi_index, yoy_inflation_rate_pct,
         CAST(round(CAST(yoy_inflation_rate_pct - prev_yoy AS DECIMAL(38,10)), 2) AS DECIMAL(18,2)) AS mom_inflation_change_pct,
         inflation_severity_category, cpi_mom_change_pct, fedfunds_rate_pct, fedfunds_direction,
         fed_policy_stance_to_inflation, inflation_momentum,
         CASE WHEN fed_policy_stance_to_inflation = 'Tightening Response' AND inflation_momentum = 'Decelerating' THEN 'Effective'
              WHEN fed_policy_stance_to_inflation = 'Tightening Response' AND inflation_momentum = 'Accelerating' THEN 'Insufficient'
              WHEN fed_policy_stance_to_inflation IN ('Accommodative', 'Accommodative Despite Inflation')
                   AND inflation_momentum = 'Accelerating' THEN 'Permissive'
              ELSE 'Neutral' END AS fed_policy_effectiveness
  FROM (SELECT *,
          CASE WHEN fedfunds_direction = 'Rising' AND yoy_inflation_rate_pct > {T.stance_hot} THEN 'Tightening Response'
               WHEN fedfunds_direction = 'Falling' AND yoy_inflation_rate_pct > {T.stance_hot} THEN 'Accommodative Despite Inflation'
               WHEN fedfunds_direction = 'Rising' AND yoy_inflation_rate_pct < {T.stance_cool} THEN 'Restrictive'
               WHEN fedfunds_direction = 'Flat' THEN 'Neutral' ELSE 'Accommodative' END AS fed_policy_stance_to_inflation,
          lag(yoy_inflation_rate_pct) OVER w AS prev_yoy,
          CASE WHEN yoy_inflation_rate_pct > lag(yoy_inflation_rate_pct) OVER w THEN 'Accelerating'
               WHEN yoy_inflation_rate_pct < lag(yoy_inflation_rate_pct) OVER w THEN 'Decelerating' ELSE 'Stable' END
            AS inflation_momentum
        FROM fct_monthly WINDOW w AS ({W})) m""")

cte("fct_employment", f"""
  SELECT {K}, period_date_key, year, month, year_month, unemployment_rate_pct, unemployment_yoy_change_pct,
         unemployment_trend, is_labor_market_healthy, housing_starts_thousands,
         CAST(round(CAST((CAST(housing_starts_thousands AS DOUBLE) - CAST(h6 AS DOUBLE)) / nullif(CAST(h6 AS DOUBLE), 0) * 100.0
                          AS DECIMAL(38,10)), 2) AS DECIMAL(18,2)) AS housing_starts_6m_change_pct,
         CASE WHEN housing_starts_thousands > h6 THEN 'Positive' WHEN housing_starts_thousands < h6 THEN 'Negative'
              ELSE 'Flat' END AS housing_leading_indicator,
         labor_market_health_score,
         CASE WHEN labor_market_health_score >= {T.condition_excellent} THEN 'Excellent'
              WHEN labor_market_health_score >= {T.condition_good} THEN 'Good'
              WHEN labor_market_health_score >= {T.condition_fair} THEN 'Fair' ELSE 'Weak' END AS labor_market_condition,
         CASE WHEN is_labor_market_healthy AND housing_starts_thousands > {T.score_housing_hi} THEN 'Robust Employment'
              WHEN is_labor_market_healthy AND housing_starts_thousands BETWEEN {T.assess_housing_lo} AND {T.score_housing_hi}
                THEN 'Solid Employment'
              WHEN unemployment_rate_pct < {T.assess_rate_tight} AND unemployment_trend IN ('Declining', 'Flat')
                THEN 'Tightening Labor Market'
              WHEN unemployment_yoy_change_pct > {T.assess_unemp_yoy} THEN 'Deteriorating Labor Market'
              ELSE 'Moderate Employment' END AS employment_assessment
  FROM (SELECT *,
          CAST(CASE WHEN unemployment_rate_pct < {T.score_rate_low} THEN 3 ELSE 0 END
             + CASE WHEN unemployment_rate_pct BETWEEN {T.score_rate_low} AND {T.score_rate_mid_hi} THEN 2 ELSE 0 END
             + CASE WHEN unemployment_trend = 'Declining' THEN 2 WHEN unemployment_trend = 'Flat' THEN 1 ELSE 0 END
             + CASE WHEN unemployment_yoy_change_pct < 0 THEN 2 WHEN unemployment_yoy_change_pct < {T.score_yoy_low} THEN 1 ELSE 0 END
             + CASE WHEN housing_starts_thousands > {T.score_housing_hi} THEN 2
                    WHEN housing_starts_thousands > {T.score_housing_mid} THEN 1 ELSE 0 END AS INTEGER) AS labor_market_health_score,
          lag(housing_starts_thousands, 6) OVER w AS h6
        FROM fct_monthly WINDOW w AS ({W})) m""")

cte("overview", f"""
  SELECT lm.{K}, lm.period_date_key AS latest_month, lm.year_month, lm.cpi_index, lm.yoy_inflation_rate_pct,
         lm.inflation_severity_category, lm.unemployment_rate_pct, lm.unemployment_yoy_change_pct, lm.unemployment_trend,
         lm.fedfunds_rate_pct, lm.fedfunds_direction, lm.sentiment_index, lm.sentiment_outlook, lm.housing_starts_thousands,
         lm.is_labor_market_healthy, lq.gdp_billions_usd, lq.qoq_growth_pct, lq.yoy_growth_pct,
         lr.recession_risk_level, lr.recession_intensity_score, lr.recession_contributing_factors,
         lr.num_contributing_factors, lr.risk_assessment_summary, pd.year, pd.month, pd.quarter,
         pd.is_nber_recession_period, pd.recession_name, lm.data_completeness_score, lm.is_data_complete
  FROM (SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY period_date_key DESC) AS rn FROM fct_monthly) lm
  LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY period_date_key DESC) AS rn
             FROM fct_quarterly WHERE gdp_billions_usd IS NOT NULL) lq ON lq.{K} = lm.{K} AND lq.rn = 1
  LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY period_date_key DESC) AS rn
             FROM fct_recession) lr ON lr.{K} = lm.{K} AND lr.rn = 1
  LEFT JOIN (SELECT *, row_number() OVER (ORDER BY period_date DESC) AS rn FROM dim) pd ON pd.rn = 1
  WHERE lm.rn = 1""")


MODEL_SELECT = {
    "stg_gdp": "SELECT * FROM stg_gdp",
    "stg_cpi": "SELECT * FROM stg_cpi",
    "stg_unemployment_rate": "SELECT * FROM stg_unemployment_rate",
    "stg_federal_funds_rate": "SELECT * FROM stg_federal_funds_rate",
    "stg_consumer_sentiment": "SELECT * FROM stg_consumer_sentiment",
    "stg_housing_starts": "SELECT * FROM stg_housing_starts",
    "int_gdp_with_yoy_change": "SELECT * FROM int_gdp",
    "int_cpi_inflation_rates": "SELECT * FROM int_cpi",
    "int_labor_market_metrics": "SELECT * FROM int_labor",
    "int_financial_conditions": "SELECT * FROM int_fin",
    "int_economic_rolling_averages": "SELECT * FROM int_rolling",
    "int_recession_indicators": "SELECT * FROM int_recession",
    "int_indicator_cross_correlations": "SELECT * FROM int_corr",
    "dim_economic_periods": "SELECT * FROM dim",
    "fct_economic_indicators_monthly": "SELECT * FROM fct_monthly",
    "fct_economic_indicators_quarterly": "SELECT * FROM fct_quarterly",
    "fct_recession_analysis": "SELECT * FROM fct_recession",
    "fct_inflation_analysis": "SELECT * FROM fct_inflation",
    "fct_employment_analysis": "SELECT * FROM fct_employment",
    "vw_economic_overview_dashboard": "SELECT * FROM overview",
}
