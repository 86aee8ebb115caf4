"""Operator-level registered queries with their SQL twins.

Series operators run on the many-series panels (part × month, user × event
type × day) so each key exercises the operator at panel scale; model-level
operators run on the segment panel.  Every query reads the driver tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import REFERENCE_THRESHOLDS as RT, SERIES
from ..functions import rules as R
from ..functions import series as S
from ..operators import align as A
from ..operators.panel import latest_flag, series_window
from ..sources.panels import SEGMENT, order_month_facts, line_month_facts, part_month_panel, part_quarter_panel
from ..sources.tables import read_table
from . import models as M
from .registry import driver_economy, register
from .twins import K, cte, pct

D = "period_date_key"
PK = ["l_partkey"]
WP = "PARTITION BY l_partkey ORDER BY period_date_key"


def _wp():
    return series_window(PK, D)


# ------------------------------------------------------------------ panels (SQL)
cte("pm", """
  SELECT l_partkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS period_date_key,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) AS n_lines
  FROM lineitem GROUP BY 1, 2""")
cte("pq", """
  SELECT l_partkey, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS period_date_key,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty
  FROM lineitem GROUP BY 1, 2""")
cte("pm_mom", f"""
  SELECT l_partkey, period_date_key, qty, {pct('qty', 1, 'wp')} AS mom_change_pct,
         {pct('qty', 12, 'wp')} AS yoy_change_pct
  FROM pm WINDOW wp AS ({WP})""")


def pm_mom(spark, d):
    w = _wp()
    return part_month_panel(spark, d).select("l_partkey", D, "qty", S.pct_change("qty", w, 1).alias("mom_change_pct"),
                                             S.pct_change("qty", w, 12).alias("yoy_change_pct"))


# ------------------------------------------------------------------ W1-W10
register("yoy_change", lambda s, d: part_month_panel(s, d).select(
    "l_partkey", D, "qty", S.pct_change("qty", _wp(), 12).alias("yoy_change_pct")),
    f"SELECT l_partkey, period_date_key, qty, {pct('qty', 12, 'wp')} AS yoy_change_pct FROM pm WINDOW wp AS ({WP})",
    ("qty", "yoy_change_pct"))
register("mom_change", lambda s, d: part_month_panel(s, d).select(
    "l_partkey", D, "qty", S.pct_change("qty", _wp(), 1).alias("mom_change_pct")),
    f"SELECT l_partkey, period_date_key, qty, {pct('qty', 1, 'wp')} AS mom_change_pct FROM pm WINDOW wp AS ({WP})",
    ("qty", "mom_change_pct"))
register("qoq_change", lambda s, d: part_quarter_panel(s, d).select(
    "l_partkey", D, "qty", S.pct_change("qty", _wp(), 1).alias("qoq_change_pct")),
    f"SELECT l_partkey, period_date_key, qty, {pct('qty', 1, 'wp')} AS qoq_change_pct FROM pq WINDOW wp AS ({WP})",
    ("qty", "qoq_change_pct"))
register("first_difference", lambda s, d: part_month_panel(s, d).select(
    "l_partkey", D, "qty", S.diff("qty", _wp()).alias("qty_change")),
    f"SELECT l_partkey, period_date_key, qty, qty - lag(qty) OVER wp AS qty_change FROM pm WINDOW wp AS ({WP})",
    ("qty", "qty_change"))
register("direction_label", lambda s, d: part_month_panel(s, d).select(
    "l_partkey", D, "qty", S.direction("qty", _wp()).alias("qty_direction")),
    f"""SELECT l_partkey, period_date_key, qty,
       CASE WHEN qty > lag(qty) OVER wp THEN 'Rising' WHEN qty < lag(qty) OVER wp THEN 'Falling' ELSE 'Flat' END AS qty_direction
     FROM pm WINDOW wp AS ({WP})""", ("qty",))
register("rolling_avg_3_6_12", lambda s, d: part_month_panel(s, d).select(
    "l_partkey", D, "qty", *[S.rolling_avg("qty", _wp(), n).alias(f"rolling_{n}_avg") for n in (3, 6, 12)]),
    f"""SELECT l_partkey, period_date_key, qty,
       avg(qty) OVER (wp ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3_avg,
       avg(qty) OVER (wp ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS rolling_6_avg,
       avg(qty) OVER (wp ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS rolling_12_avg
     FROM pm WINDOW wp AS ({WP})""", ("qty", "rolling_3_avg", "rolling_6_avg", "rolling_12_avg"))
register("rolling_of_change", lambda s, d: pm_mom(s, d).select(
    "l_partkey", D, "mom_change_pct", S.rolling_avg("mom_change_pct", _wp(), 3).alias("rolling_3_mom_pct")),
    f"""SELECT l_partkey, period_date_key, mom_change_pct,
       avg(mom_change_pct) OVER (wp ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3_mom_pct
     FROM pm_mom WINDOW wp AS ({WP})""", ("mom_change_pct", "rolling_3_mom_pct"))
register("rolling_flag_count", lambda s, d: pm_mom(s, d).select(
    "l_partkey", D, "mom_change_pct",
    S.rolling_count_if(F.col("mom_change_pct") < 0, _wp(), 4).alias("negatives_in_4")),
    f"""SELECT l_partkey, period_date_key, mom_change_pct,
       count(CASE WHEN mom_change_pct < 0 THEN 1 END) OVER (wp ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS negatives_in_4
     FROM pm_mom WINDOW wp AS ({WP})""", ("mom_change_pct",))


def _corr_sql(x, y, n=12, w="wp"):
    fr = f"({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    xx = f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN {x} END"
    yy = f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN {y} END"
    sx, sy = f"stddev_pop({xx}) OVER {fr}", f"stddev_pop({yy}) OVER {fr}"
    c = f"CASE WHEN {sx} * {sy} = 0 THEN NULL ELSE covar_pop({xx}, {yy}) OVER {fr} / ({sx} * {sy}) END"
    return f"CAST(round(CAST({c} AS DECIMAL(38,10)), 3) AS DECIMAL(18,3))"


register("rolling_corr", lambda s, d: part_month_panel(s, d).select(
    "l_partkey", D, "qty", "revenue",
    S.round_half_up(S.rolling_corr("qty", "revenue", _wp(), 12), 3).alias("qty_revenue_corr")),
    f"""SELECT l_partkey, period_date_key, qty, revenue, {_corr_sql('qty', 'revenue')} AS qty_revenue_corr
     FROM pm WINDOW wp AS ({WP})""", ("qty", "revenue"))


def _leading(spark, d):
    w = _wp()
    pm = part_month_panel(spark, d).select("l_partkey", D, "qty", S.lag_of("qty", w, 6).alias("qty_6m_ago"))
    q, q6 = F.col("qty"), F.col("qty_6m_ago")
    return pm.select("*", S.round_half_up(F.try_divide(q - q6, q6) * 100.0, 2).alias("qty_6m_change_pct"),
                     F.when(q > q6, "Positive").when(q < q6, "Negative").otherwise("Flat").alias("leading_indicator"))


register("leading_indicator", _leading, f"""
  SELECT *, CAST(round(CAST((qty - qty_6m_ago) / nullif(qty_6m_ago, 0) * 100.0 AS DECIMAL(38,10)), 2) AS DECIMAL(18,2))
            AS qty_6m_change_pct,
         CASE WHEN qty > qty_6m_ago THEN 'Positive' WHEN qty < qty_6m_ago THEN 'Negative' ELSE 'Flat' END AS leading_indicator
  FROM (SELECT l_partkey, period_date_key, qty, lag(qty, 6) OVER wp AS qty_6m_ago FROM pm WINDOW wp AS ({WP})) x""",
    ("qty", "qty_6m_ago"))
register("latest_per_key", lambda s, d: A.latest_per_key(part_month_panel(s, d), PK, D), """
  SELECT l_partkey, period_date_key, qty, revenue, n_lines FROM pm
  QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY period_date_key DESC) = 1""", ("qty", "revenue"))
register("last_non_null", lambda s, d: A.last_non_null(pm_mom(s, d), "mom_change_pct", PK, D, out="last_mom_change_pct"),
         """SELECT l_partkey, arg_max(mom_change_pct, period_date_key) FILTER (WHERE mom_change_pct IS NOT NULL)
                   AS last_mom_change_pct
            FROM pm_mom GROUP BY l_partkey""", ("last_mom_change_pct",))
register("is_latest", lambda s, d: latest_flag(part_month_panel(s, d), PK, D), """
  SELECT *, period_date_key = max(period_date_key) OVER (PARTITION BY l_partkey) AS is_latest FROM pm""",
    ("qty", "revenue"))

# ------------------------------------------------------------------ P3-P9
register("severity_bucket", lambda s, d: pm_mom(s, d).select(
    "l_partkey", D, "yoy_change_pct", M.inflation_severity("yoy_change_pct", RT).alias("severity")),
    f"""SELECT l_partkey, period_date_key, yoy_change_pct,
       CASE WHEN yoy_change_pct <= {RT.inflation_mild} THEN 'Mild' WHEN yoy_change_pct <= {RT.inflation_moderate} THEN 'Moderate'
            WHEN yoy_change_pct <= {RT.inflation_high} THEN 'High' ELSE 'Severe' END AS severity
     FROM pm_mom""", ("yoy_change_pct",))
register("negative_growth_flags", lambda s, d: pm_mom(s, d).select(
    "l_partkey", D, S.negative_flag("mom_change_pct").alias("is_mom_negative"),
    S.negative_flag("yoy_change_pct").alias("is_yoy_negative")),
    """SELECT l_partkey, period_date_key, coalesce(mom_change_pct < 0, false) AS is_mom_negative,
              coalesce(yoy_change_pct < 0, false) AS is_yoy_negative FROM pm_mom""")
register("sentiment_outlook", lambda s, d: M.stg_consumer_sentiment(driver_economy(s, d, share=False)).select(
    SEGMENT, D, "sentiment_index", R.outlook("sentiment_index", 100.0).alias("sentiment_outlook")),
    f"""SELECT {K}, period_date_key, sentiment_index,
       CASE WHEN sentiment_index > 100 THEN 'Optimistic' WHEN sentiment_index < 100 THEN 'Pessimistic' ELSE 'Neutral' END
         AS sentiment_outlook FROM stg_consumer_sentiment""")


def _conj(spark, d):
    ctx = driver_economy(spark, d)
    on = [SEGMENT, D]
    return A.align_full(M.int_financial_conditions(ctx).select(*on, "is_financial_stress_elevated"),
                        M.int_labor_market_metrics(ctx).select(*on, "is_labor_market_healthy"), on)


register("conjunctive_flags", _conj, f"""
  SELECT coalesce(f.{K}, l.{K}) AS {K}, coalesce(f.period_date_key, l.period_date_key) AS period_date_key,
         f.is_financial_stress_elevated, l.is_labor_market_healthy
  FROM int_fin f FULL OUTER JOIN int_labor l ON f.{K} = l.{K} AND f.period_date_key = l.period_date_key""")
register("additive_score", lambda s, d: M.int_recession_indicators(driver_economy(s, d, True)).select(
    SEGMENT, D, "recession_intensity_score"),
    f"SELECT {K}, period_date_key, recession_intensity_score FROM int_recession")
register("decision_table", lambda s, d: M.int_recession_indicators(driver_economy(s, d, True)).select(
    SEGMENT, D, "consecutive_negative_quarters", "recession_risk_level"),
    f"SELECT {K}, period_date_key, consecutive_negative_quarters, recession_risk_level FROM int_recession")
register("contributing_factors", lambda s, d: M.fct_recession_analysis(driver_economy(s, d, True)).select(
    SEGMENT, D, "recession_contributing_factors", "num_contributing_factors"),
    f"SELECT {K}, period_date_key, recession_contributing_factors, num_contributing_factors FROM fct_recession")


def _stage_long(spark, d):
    ctx = driver_economy(spark, d)
    parts = [M.stage(ctx, s.series_id).select(SEGMENT, "series_code", D, S.as_double(s.value_col).alias("value"),
                                               "indicator_type", "is_latest") for s in SERIES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


register("stage_series", _stage_long, "\n  UNION ALL ".join(
    f"SELECT {K}, series_code, period_date_key, CAST({s.value_col} AS DOUBLE) AS value, indicator_type, is_latest "
    f"FROM {n}" for s, n in zip(SERIES, ("stg_gdp", "stg_cpi", "stg_unemployment_rate", "stg_federal_funds_rate",
                                         "stg_consumer_sentiment", "stg_housing_starts"))), ("value",))
register("history_scan", lambda s, d: driver_economy(s, d).observations.where(
    F.col("observation_date") > F.lit("1999-12-31").cast("date")).select(SEGMENT, "series_id", "observation_date", "value"),
    f"SELECT {K}, series_id, observation_date, value FROM obs WHERE observation_date > DATE '1999-12-31'", ("value",))

# ------------------------------------------------------------------ joins / aggregates
register("quarterly_rollup", lambda s, d: A.rollup_period(part_month_panel(s, d), PK, ["qty", "revenue"], "quarter", D),
         """SELECT l_partkey, CAST(date_trunc('quarter', period_date_key) AS DATE) AS period_date_key,
                   avg(qty) AS avg_qty, avg(revenue) AS avg_revenue,
                   CAST(year(date_trunc('quarter', period_date_key)) AS INTEGER) AS year,
                   CAST(quarter(date_trunc('quarter', period_date_key)) AS INTEGER) AS quarter
            FROM pm GROUP BY 1, 2, 5, 6""", ("avg_qty", "avg_revenue"))


def _attach(spark, d):
    j = A.attach_stats(part_month_panel(spark, d), "qty", PK)
    return j.select("l_partkey", D, "qty", "mean_value", "std_value",
                    F.try_divide(F.col("qty") - F.col("mean_value"), F.nullif(F.col("std_value"), F.lit(0.0))).alias("z_score"))


register("attach_stats", _attach, """
  SELECT p.l_partkey, p.period_date_key, p.qty, s.mean_value, s.std_value,
         (p.qty - s.mean_value) / nullif(s.std_value, 0) AS z_score
  FROM pm p JOIN (SELECT l_partkey, avg(qty) AS mean_value, stddev_pop(qty) AS std_value FROM pm
                  WHERE qty IS NOT NULL GROUP BY 1) s ON p.l_partkey = s.l_partkey""",
    ("qty", "mean_value", "std_value", "z_score"))
register("quarter_start_join", lambda s, d: A.quarter_start_join(
    part_quarter_panel(s, d).withColumnRenamed("qty", "quarter_qty"),
    part_month_panel(s, d).select("l_partkey", D, F.col("qty").alias("first_month_qty")), PK, D),
    """SELECT q.l_partkey, q.period_date_key, q.qty AS quarter_qty, m.qty AS first_month_qty
       FROM pq q LEFT JOIN pm m ON q.l_partkey = m.l_partkey AND q.period_date_key = m.period_date_key""",
    ("quarter_qty", "first_month_qty"))
register("derived_key_join", lambda s, d: A.derived_key_join(
    part_quarter_panel(s, d).withColumnRenamed("qty", "quarter_qty"),
    part_month_panel(s, d).select("l_partkey", D, F.col("qty").alias("avg_monthly_qty")), PK, ["avg_monthly_qty"], D),
    """SELECT q.l_partkey, q.period_date_key, q.qty AS quarter_qty, m.avg_monthly_qty
       FROM pq q LEFT JOIN (SELECT l_partkey, CAST(date_trunc('quarter', period_date_key) AS DATE) AS period_date_key,
                                   avg(qty) AS avg_monthly_qty FROM pm GROUP BY 1, 2) m
         ON q.l_partkey = m.l_partkey AND q.period_date_key = m.period_date_key""", ("quarter_qty", "avg_monthly_qty"))
register("one_row_per_key", lambda s, d: A.one_row_per_key(
    read_table(s, d, "events", "user_id", "event_type", "event_id", "ts", "value"), ["user_id", "event_type"],
    ["ts", "event_id"]),
    """SELECT user_id, event_type, event_id, ts, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""", ("value",))
register("full_outer_align", lambda s, d: A.align_full(
    order_month_facts(s, d).select(SEGMENT, F.col("m").alias(D), "n_orders"),
    line_month_facts(s, d).select(SEGMENT, F.col("m").alias(D), "n_lines"), [SEGMENT, D]),
    f"""SELECT coalesce(o.{K}, l.{K}) AS {K}, coalesce(o.m, l.m) AS period_date_key, o.n_orders, l.n_lines
        FROM om o FULL OUTER JOIN lm l ON o.{K} = l.{K} AND o.m = l.m""")

EVENT_TYPES = ("click", "view", "purchase", "signup", "error")


def _align_five(spark, d):
    e = read_table(spark, d, "events", "user_id", "event_type", "ts")
    day = F.col("ts").cast("date").alias(D)
    frames = [(t, e.where(F.col("event_type") == t).groupBy("user_id", day).agg(F.count(F.lit(1)).alias(f"n_{t}")))
              for t in EVENT_TYPES]
    m = A.align_many(frames, ["user_id", D])
    score = R.additive_score([F.col(f"_has_{t}") for t in EVENT_TYPES]).cast("int")
    return m.select("user_id", D, *[f"n_{t}" for t in EVENT_TYPES], score.alias("completeness_score"))


register("align_five", _align_five, f"""
  SELECT user_id, CAST(ts AS DATE) AS period_date_key,
         {', '.join(f"CASE WHEN count(*) FILTER (WHERE event_type = '{t}') > 0 THEN count(*) FILTER (WHERE event_type = '{t}') END AS n_{t}" for t in EVENT_TYPES)},
         CAST({' + '.join(f"(count(*) FILTER (WHERE event_type = '{t}') > 0)::INT" for t in EVENT_TYPES)} AS INTEGER) AS completeness_score
  FROM events WHERE event_type IN ({', '.join(repr(t) for t in EVENT_TYPES)}) GROUP BY 1, 2""")
register("interval_tag", lambda s, d: M.dim_economic_periods(driver_economy(s, d), "intervals"),
         "SELECT * FROM dim_intervals")


def _union_streams(spark, d):
    """U1 as the reference writes it: five windowed streams, UNION ALL."""
    ctx = driver_economy(spark, d)
    w = ctx.window()
    parts = []
    for stg, col, lab, cat in ((M.stg_cpi, "cpi_index", "CPI", "Inflation"),
                               (M.stg_unemployment_rate, "unemployment_rate_pct", "Unemployment Rate", "Labor Market"),
                               (M.stg_federal_funds_rate, "fedfunds_rate_pct", "Federal Funds Rate", "Monetary Policy"),
                               (M.stg_consumer_sentiment, "sentiment_index", "Consumer Sentiment", "Consumer Confidence"),
                               (M.stg_housing_starts, "housing_starts_thousands", "Housing Starts", "Construction Activity")):
        x = S.as_double(col)
        parts.append(stg(ctx).select(SEGMENT, D, F.lit(lab).alias("indicator_type"),
                                     *[S.rolling_avg(x, w, n).alias(f"rolling_{n}m_avg") for n in (3, 6, 12)],
                                     F.lit(cat).alias("metric_category")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


register("union_all_streams", _union_streams, "SELECT * FROM int_rolling",
         ("rolling_3m_avg", "rolling_6m_avg", "rolling_12m_avg"))


def _yoy_calendar(spark, d):
    pm = part_month_panel(spark, d).select("l_partkey", D, "qty")
    j = A.calendar_lag(pm, PK, "qty", 12, "qty_12m_ago", D)
    return j.select("l_partkey", D, "qty", "qty_12m_ago",
                    (F.try_divide(F.col("qty") - F.col("qty_12m_ago"), F.col("qty_12m_ago")) * 100.0)
                    .alias("yoy_change_pct"))


register("yoy_change_calendar", _yoy_calendar, """
  SELECT c.l_partkey, c.period_date_key, c.qty, p.qty AS qty_12m_ago,
         (c.qty - p.qty) / nullif(p.qty, 0) * 100 AS yoy_change_pct
  FROM pm c LEFT JOIN pm p ON p.l_partkey = c.l_partkey
                          AND p.period_date_key = CAST(c.period_date_key - INTERVAL 12 MONTH AS DATE)""",
    ("qty", "qty_12m_ago", "yoy_change_pct"))
