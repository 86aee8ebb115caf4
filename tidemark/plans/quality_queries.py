"""Registered load, quality and report queries with their SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ACCEPTED, SERIES, VERDICTS, VERDICT_UNKNOWN, DRIVER_PANEL_THRESHOLDS as T
from ..operators import quality as Q
from ..sources import observations as O
from ..sources.panels import SEGMENT, event_day_panel, part_month_panel, user_day_panel
from ..sources.tables import read_table
from . import models as M
from . import reports as RP
from .registry import driver_economy, register
from .twins import K, cte

D = "period_date_key"
AS_OF = "2001-12-01"          # as-of date of the segment panel (data ends 2001-11)
EVENT_AS_OF = "2024-02-01"    # as-of date of the daily event panel (FIXTURES §4)
EVENT_CUTOFF = "2024-01-16"   # first load of the event observations; later events arrive after it
EVENT_TYPES_ACCEPTED = ("click", "view", "purchase", "signup")


def _obs(spark, d):
    return driver_economy(spark, d).observations


# ------------------------------------------------------------------ S2-S8 on the segment panel
register("scan_raw", lambda s, d: M.scan_raw(driver_economy(s, d, share=False), "CPIAUCSL"),
         f"SELECT {K}, observation_date, series_id, value, CAST(ingested_at AS TIMESTAMP) AS ingested_at FROM obs "
         f"WHERE series_id = 'CPIAUCSL'", ("value",))
register("row_counts", lambda s, d: Q.row_counts(_obs(s, d), [SEGMENT, "series_id"]),
         f"SELECT {K}, series_id, count(*) AS row_count FROM obs GROUP BY 1, 2")
register("high_water_mark", lambda s, d: O.high_water_mark(_obs(s, d), [SEGMENT, "series_id"]),
         f"SELECT {K}, series_id, max(observation_date) AS latest_date FROM obs GROUP BY 1, 2")
register("table_stats", lambda s, d: O.table_stats(_obs(s, d), [SEGMENT, "series_id"]),
         f"SELECT {K}, series_id, count(*) AS row_count, max(observation_date) AS latest_date FROM obs GROUP BY 1, 2")
register("backfill_slice", lambda s, d: O.backfill_slice(_obs(s, d), "2000-01-01").select(
    SEGMENT, "series_id", "observation_date", "value"),
    f"SELECT {K}, series_id, observation_date, value FROM obs WHERE observation_date >= DATE '2000-01-01'", ("value",))


def _incremental(spark, d):
    obs = _obs(spark, d).select(SEGMENT, "series_id", "observation_date", "value")
    # already-loaded target: history before 2001, without the housing series (never loaded)
    target = obs.where((F.col("observation_date") < F.lit("2001-01-01").cast("date")) & (F.col("series_id") != "HOUST"))
    return O.incremental_slice(obs, target, "2001-06-30", [SEGMENT, "series_id"], lookback_days=90)


register("incremental_slice", _incremental, f"""
  SELECT s.{K}, s.series_id, s.observation_date, s.value
  FROM obs s LEFT JOIN (SELECT {K}, series_id, max(observation_date) AS hwm FROM obs
                        WHERE observation_date < DATE '2001-01-01' AND series_id <> 'HOUST' GROUP BY 1, 2) t
    ON s.{K} = t.{K} AND s.series_id = t.series_id
  WHERE s.observation_date >= coalesce(t.hwm + 1, DATE '2001-06-30' - 90) AND s.observation_date <= DATE '2001-06-30'""",
    ("value",))

# ------------------------------------------------------------------ S1, S1b, S8, X2 on event payloads
cte("ev_raw", """
  SELECT event_type AS series_id, event_id,
         CASE WHEN event_id % 29 = 0 THEN '2024-13-01' ELSE strftime(CAST(ts AS DATE), '%Y-%m-%d') END AS date_str,
         CASE WHEN event_id % 23 = 0 THEN '.' WHEN event_id % 17 = 0 THEN NULL
              WHEN event_id % 19 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS value_str,
         CAST(ts AS DATE) AS d, value
  FROM events""")
cte("ev_parsed", """
  SELECT series_id, event_id, CAST(0 AS INTEGER) AS pos, d AS observation_date,
         CASE WHEN value_str = '.' OR value_str IS NULL THEN NULL ELSE value END AS value, value_str
  FROM ev_raw WHERE date_str <> '2024-13-01' AND NOT coalesce(value_str = 'n/a', false)""")


def event_payloads(spark: SparkSession, d: str) -> DataFrame:
    """API-shaped payloads built from events: one ``{"observations": [...]}`` document per event.

    Malformed input is made by expression (FIXTURES §4): ``"."`` and null
    values, an unparseable value and an impossible date.
    """
    e = read_table(spark, d, "events", "event_id", "ts", "event_type", "value")
    eid = F.col("event_id")
    date_str = F.when(eid % 29 == 0, F.lit("2024-13-01")).otherwise(F.date_format(F.col("ts").cast("date"), "yyyy-MM-dd"))
    value_str = (F.when(eid % 23 == 0, F.lit(".")).when(eid % 17 == 0, F.lit(None).cast("string"))
                 .when(eid % 19 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")))
    payload = F.to_json(F.struct(F.array(F.struct(date_str.alias("date"), value_str.alias("value"))).alias("observations")))
    return e.select(F.col("event_type").alias("series_id"), "event_id", payload.alias("payload"),
                    date_str.alias("date_str"), value_str.alias("value_str"))


def _parsed(spark, d, drop=False):
    parsed, quarantine = O.parse_observations(event_payloads(spark, d), "payload", ["series_id", "event_id"], drop)
    return parsed, quarantine


register("parse_observations", lambda s, d: _parsed(s, d)[0].drop("raw_json"),
         "SELECT series_id, event_id, pos, observation_date, value FROM ev_parsed", ("value",))
register("parse_observations_drop", lambda s, d: _parsed(s, d, True)[0].drop("raw_json"),
         "SELECT series_id, event_id, pos, observation_date, value FROM ev_parsed "
         "WHERE value_str IS NOT NULL AND value_str <> '.'", ("value",))
register("load_summary", lambda s, d: O.load_summary(*_parsed(s, d)), """
  SELECT series_id, count(*) AS fetched,
         count(*) FILTER (WHERE date_str <> '2024-13-01' AND NOT coalesce(value_str = 'n/a', false)) AS upserted,
         count(*) FILTER (WHERE date_str = '2024-13-01' OR coalesce(value_str = 'n/a', false)) AS failed,
         CASE WHEN count(*) = 0 THEN 'no_data'
              WHEN count(*) FILTER (WHERE date_str = '2024-13-01' OR coalesce(value_str = 'n/a', false)) = 0 THEN 'success'
              WHEN count(*) FILTER (WHERE date_str <> '2024-13-01' AND NOT coalesce(value_str = 'n/a', false)) = 0 THEN 'failed'
              ELSE 'partial' END AS status
  FROM ev_raw GROUP BY 1""")


def _validate(spark, d):
    p = event_payloads(spark, d).select("series_id", F.col("event_id").alias("pos"), "date_str", "value_str")
    v = Q.validate_observations(p, EVENT_AS_OF, ["series_id"], "date_str", "value_str", "pos")
    return v.select("series_id", "pos", F.array_join("reasons", ",").alias("reasons"), "is_valid")


def _validate_counts(spark, d):
    p = event_payloads(spark, d).select("series_id", F.col("event_id").alias("pos"), "date_str", "value_str")
    return Q.validation_counts(Q.validate_observations(p, EVENT_AS_OF, ["series_id"], "date_str", "value_str", "pos"))


register("validation_counts", _validate_counts, f"""
  SELECT series_id, count(*) AS total, count(*) FILTER (WHERE ok) AS valid, count(*) FILTER (WHERE NOT ok) AS invalid
  FROM (SELECT series_id,
          (date_str IS NOT NULL AND value_str IS NOT NULL) AND dd IS NOT NULL
          AND NOT (value_str <> '.' AND TRY_CAST(value_str AS DOUBLE) IS NULL)
          AND NOT coalesce(dd > DATE '{EVENT_AS_OF}', false) AND NOT coalesce(dd < DATE '1900-01-01', false)
          AND NOT coalesce(count(*) OVER (PARTITION BY series_id, dd) > 1, false)
          AND NOT coalesce(dd < lag(dd) OVER (PARTITION BY series_id ORDER BY event_id), false) AS ok
        FROM (SELECT *, TRY_CAST(date_str AS DATE) AS dd FROM ev_raw) x) y
  GROUP BY 1""")
register("validate_observations", _validate, f"""
  SELECT series_id, pos, array_to_string(r, ',') AS reasons, len(r) = 0 AS is_valid
  FROM (SELECT series_id, event_id AS pos,
          list_filter([
            CASE WHEN date_str IS NULL OR value_str IS NULL THEN 'missing_field' END,
            CASE WHEN date_str IS NOT NULL AND dd IS NULL THEN 'bad_date' END,
            CASE WHEN value_str IS NOT NULL AND value_str <> '.' AND TRY_CAST(value_str AS DOUBLE) IS NULL THEN 'not_numeric' END,
            CASE WHEN dd > DATE '{EVENT_AS_OF}' THEN 'future_date' END,
            CASE WHEN dd < DATE '1900-01-01' THEN 'before_1900' END,
            CASE WHEN dd IS NOT NULL AND count(*) OVER (PARTITION BY series_id, dd) > 1 THEN 'duplicate_date' END,
            CASE WHEN dd < lag(dd) OVER (PARTITION BY series_id ORDER BY event_id) THEN 'out_of_order' END], lambda x: x IS NOT NULL) AS r
        FROM (SELECT *, TRY_CAST(date_str AS DATE) AS dd FROM ev_raw) x) y""")

# ------------------------------------------------------------------ S3 upsert
cte("ev_keyed", """
  SELECT user_id, event_type, CAST(ts AS DATE) AS observation_date, event_id, value, ts FROM events""")


def _upsert(spark, d):
    e = read_table(spark, d, "events", "user_id", "event_type", "ts", "event_id", "value").select(
        "user_id", "event_type", F.col("ts").cast("date").alias("observation_date"), "event_id", "value", "ts")
    cut = F.lit(EVENT_CUTOFF).cast("timestamp_ntz")
    target = O.upsert(None, e.where(F.col("ts") < cut), ["user_id", "event_type", "observation_date"], "event_id")
    updates = e.where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    return O.upsert(target, updates, ["user_id", "event_type", "observation_date"], "event_id")


register("upsert_latest_wins", _upsert, """
  SELECT user_id, event_type, observation_date, event_id, value, ts FROM ev_keyed
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type, observation_date ORDER BY event_id DESC) = 1""",
    ("value",))

# ------------------------------------------------------------------ Q1-Q9, X4, X5
_MONTHLY_COLS = ("cpi_index", "yoy_inflation_rate_pct", "inflation_severity_category", "cpi_mom_change_pct",
                 "unemployment_rate_pct", "unemployment_yoy_change_pct", "unemployment_trend",
                 "is_labor_market_healthy", "fedfunds_rate_pct", "fedfunds_direction", "sentiment_index",
                 "sentiment_outlook", "housing_starts_thousands")
register("chk_not_null", lambda s, d: Q.null_counts(M.fct_economic_indicators_monthly(driver_economy(s, d, True)),
                                                     list(_MONTHLY_COLS)),
         "\nUNION ALL ".join(f"SELECT count(*) AS row_count, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count "
                             f"FROM fct_monthly" for c in _MONTHLY_COLS))
register("chk_unique", lambda s, d: Q.unique(
    read_table(s, d, "events", "user_id", "event_type", "ts").select(
        "user_id", "event_type", F.col("ts").cast("date").alias("observation_date")),
    ["user_id", "event_type", "observation_date"]),
    "SELECT user_id, event_type, observation_date, count(*) AS n_rows FROM ev_keyed GROUP BY 1, 2, 3 HAVING count(*) > 1")
register("chk_accepted_values", lambda s, d: Q.accepted_values(
    read_table(s, d, "events", "event_id", "event_type"), "event_type", EVENT_TYPES_ACCEPTED),
    f"SELECT event_id, event_type FROM events WHERE event_type IS NOT NULL AND event_type NOT IN "
    f"({', '.join(repr(v) for v in EVENT_TYPES_ACCEPTED)})")
register("chk_accepted_labels", lambda s, d: _accepted_labels(s, d), f"""
  SELECT {K}, period_date_key, 'inflation_severity_category' AS column_name, inflation_severity_category AS value FROM fct_monthly
  WHERE inflation_severity_category IS NOT NULL AND inflation_severity_category NOT IN ({', '.join(repr(v) for v in ACCEPTED['inflation_severity_category'])})
  UNION ALL
  SELECT {K}, period_date_key, 'unemployment_trend', unemployment_trend FROM fct_monthly
  WHERE unemployment_trend IS NOT NULL AND unemployment_trend NOT IN ({', '.join(repr(v) for v in ACCEPTED['trend_direction'])})""")


def _accepted_labels(spark, d):
    m = M.fct_economic_indicators_monthly(driver_economy(spark, d, True))
    a = Q.accepted_values(m, "inflation_severity_category", ACCEPTED["inflation_severity_category"]).select(
        SEGMENT, D, F.lit("inflation_severity_category").alias("column_name"),
        F.col("inflation_severity_category").alias("value"))
    b = Q.accepted_values(m, "unemployment_trend", ACCEPTED["trend_direction"]).select(
        SEGMENT, D, F.lit("unemployment_trend").alias("column_name"), F.col("unemployment_trend").alias("value"))
    return a.unionByName(b)


def _pm_yoy(spark, d):
    from .operator_queries import pm_mom
    return pm_mom(spark, d)


register("chk_between", lambda s, d: Q.between(_pm_yoy(s, d), "yoy_change_pct", -50.0, 50.0),
         "SELECT * FROM pm_mom WHERE yoy_change_pct IS NOT NULL AND (yoy_change_pct < -50.0 OR yoy_change_pct > 50.0)",
         ("qty", "mom_change_pct", "yoy_change_pct"))

_ranges_sql = " UNION ALL ".join(f"SELECT '{s.series_id}' AS series_id, CAST({s.test_range[0]} AS DOUBLE) AS range_min, "
                                 f"CAST({s.test_range[1]} AS DOUBLE) AS range_max" for s in SERIES)


def series_ranges(spark: SparkSession) -> DataFrame:
    """The registry's test ranges as a 6-row table (fixed values)."""
    return spark.createDataFrame([(s.series_id, float(s.test_range[0]), float(s.test_range[1])) for s in SERIES],
                                 "series_id string, range_min double, range_max double")


def _valid_range(spark, d):
    obs = _obs(spark, d).select(SEGMENT, "series_id", "observation_date", "value")
    return Q.valid_range_by_series(obs, "value", series_ranges(spark)).select(
        SEGMENT, "series_id", "observation_date", "value", "range_min", "range_max")


register("chk_valid_range", _valid_range, f"""
  SELECT o.{K}, o.series_id, o.observation_date, o.value, r.range_min, r.range_max
  FROM obs o JOIN ({_ranges_sql}) r ON o.series_id = r.series_id
  WHERE o.value IS NOT NULL AND (o.value < r.range_min OR o.value > r.range_max)""", ("value", "range_min", "range_max"))

cte("ev_day", """
  SELECT event_type, CAST(ts AS DATE) AS observation_date, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value,
         count(*) AS n_events, max(ts) AS ingested_at
  FROM events GROUP BY 1, 2""")
register("chk_spike", lambda s, d: Q.spike(event_day_panel(s, d), "value", 25.0, ["event_type"], "observation_date").select(
    "event_type", "observation_date", "value", "prev_value", "change_pct"), """
  SELECT * FROM (SELECT event_type, observation_date, value, lag(value) OVER w AS prev_value,
                        abs((value - lag(value) OVER w) / nullif(lag(value) OVER w, 0) * 100.0) AS change_pct
                 FROM ev_day WHERE value IS NOT NULL WINDOW w AS (PARTITION BY event_type ORDER BY observation_date)) x
  WHERE prev_value IS NOT NULL AND change_pct > 25.0""", ("value", "prev_value", "change_pct"))
register("chk_outlier", lambda s, d: Q.outlier(read_table(s, d, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice"),
                                               "l_extendedprice", 2.5).select("l_orderkey", "l_linenumber", "l_extendedprice", "z_score"),
         """SELECT l_orderkey, l_linenumber, l_extendedprice, z_score FROM (
              SELECT l.*, abs((l.l_extendedprice - s.mean_value) / nullif(s.std_value, 0)) AS z_score
              FROM lineitem l CROSS JOIN (SELECT avg(l_extendedprice) AS mean_value, stddev_pop(l_extendedprice) AS std_value
                                          FROM lineitem WHERE l_extendedprice IS NOT NULL) s
              WHERE l.l_extendedprice IS NOT NULL) x WHERE z_score > 2.5""", ("l_extendedprice", "z_score"))
register("chk_future_dates", lambda s, d: Q.future_dates(_obs(s, d), "2001-09-30").select(
    SEGMENT, "series_id", "observation_date"),
    f"SELECT {K}, series_id, observation_date FROM obs WHERE observation_date > DATE '2001-09-30'")

# ------------------------------------------------------------------ Q10-Q15, X1, X6, X9, X10


def freshness_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s.series_id, s.fresh_warn_days, s.fresh_error_days) for s in SERIES],
                                 "series_id string, warn_days int, error_days int")


def staleness_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s.series_id, s.stale_days) for s in SERIES], "series_id string, window_days int")


_fresh_sql = " UNION ALL ".join(f"SELECT '{s.series_id}' AS series_id, {s.fresh_warn_days} AS warn_days, "
                                f"{s.fresh_error_days} AS error_days" for s in SERIES)
_stale_sql = " UNION ALL ".join(f"SELECT '{s.series_id}' AS series_id, {s.stale_days} AS window_days" for s in SERIES)

register("chk_source_freshness", lambda s, d: Q.source_freshness(_obs(s, d), freshness_table(s), AS_OF,
                                                                  [SEGMENT, "series_id"]), f"""
  SELECT l.{K}, l.series_id, l.max_loaded_at,
         CAST(date_diff('day', CAST(l.max_loaded_at AS DATE), DATE '{AS_OF}') AS INTEGER) AS age_days,
         t.warn_days, t.error_days,
         CASE WHEN date_diff('day', CAST(l.max_loaded_at AS DATE), DATE '{AS_OF}') > t.error_days THEN 'error'
              WHEN date_diff('day', CAST(l.max_loaded_at AS DATE), DATE '{AS_OF}') > t.warn_days THEN 'warn' ELSE 'pass' END
           AS freshness_status
  FROM (SELECT {K}, series_id, CAST(max(ingested_at) AS TIMESTAMP) AS max_loaded_at FROM obs GROUP BY 1, 2) l
  JOIN ({_fresh_sql}) t ON l.series_id = t.series_id""")
cte("zscore", f"""
  SELECT event_type, n_points, latest_value, mean, stddev,
         CASE WHEN stddev > 0 THEN (latest_value - mean) / stddev ELSE 0.0 END AS zscore
  FROM (SELECT event_type, count(value) AS n_points, avg(value) AS mean, stddev_pop(value) AS stddev,
               arg_max(value, observation_date) AS latest_value
        FROM ev_day WHERE observation_date >= DATE '{EVENT_AS_OF}' - 730 AND value IS NOT NULL GROUP BY 1) s
  WHERE n_points >= 2""")
register("chk_latest_zscore", lambda s, d: Q.latest_zscore(event_day_panel(s, d), "value", EVENT_AS_OF, ["event_type"]),
         "SELECT *, abs(zscore) > 3.0 AS anomaly_detected FROM zscore", ("latest_value", "mean", "stddev", "zscore"))


def _expected(spark, d):
    seg = read_table(spark, d, "customer", SEGMENT).distinct()
    return seg.crossJoin(F.broadcast(staleness_table(spark)))  # registry: 6 rows, bounded


cte("stale", f"""
  SELECT e.{K}, e.series_id, l.latest_date, CAST(date_diff('day', l.latest_date, DATE '{AS_OF}') AS INTEGER) AS days_old,
         e.window_days,
         CASE WHEN l.latest_date IS NULL THEN 'no_data' WHEN date_diff('day', l.latest_date, DATE '{AS_OF}') > e.window_days
              THEN 'stale' ELSE 'fresh' END AS status
  FROM (SELECT DISTINCT c.{K}, t.series_id, t.window_days FROM customer c CROSS JOIN ({_stale_sql}) t) e
  LEFT JOIN (SELECT {K}, series_id, max(observation_date) AS latest_date FROM obs GROUP BY 1, 2) l
    ON e.{K} = l.{K} AND e.series_id = l.series_id""")
register("chk_staleness", lambda s, d: Q.staleness(_obs(s, d), _expected(s, d), AS_OF, [SEGMENT, "series_id"]),
         "SELECT * FROM stale")


def _counts(spark, d, before=True):
    e = read_table(spark, d, "events", "event_type", "ts")
    if before:
        e = e.where(F.col("ts") < F.lit(EVENT_CUTOFF).cast("timestamp_ntz"))
    return Q.row_counts(e, ["event_type"])


register("chk_row_growth", lambda s, d: Q.row_count_growth(_counts(s, d, True), _counts(s, d, False), ["event_type"]),
         f"""SELECT coalesce(b.event_type, a.event_type) AS event_type, coalesce(b.n, 0) AS pre_ingestion,
                    coalesce(a.n, 0) AS post_ingestion, coalesce(a.n, 0) - coalesce(b.n, 0) AS new_rows,
                    CASE WHEN coalesce(a.n, 0) - coalesce(b.n, 0) > 0 THEN 'growth' ELSE 'no_growth' END AS status
             FROM (SELECT event_type, count(*) AS n FROM events WHERE ts < TIMESTAMP '{EVENT_CUTOFF}' GROUP BY 1) b
             FULL OUTER JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY 1) a ON a.event_type = b.event_type""")


def _drop(spark, d):
    e = read_table(spark, d, "events", "event_type", "ts")
    before = Q.row_counts(e, ["event_type"])
    after = Q.row_counts(e.where(F.col("ts") >= F.lit("2024-01-05").cast("timestamp_ntz")), ["event_type"])
    return Q.row_drop(before, after, ["event_type"], 0.10)


register("chk_row_drop", _drop, """
  SELECT * FROM (SELECT coalesce(b.event_type, a.event_type) AS event_type, coalesce(b.n, 0) AS pre_ingestion,
                        coalesce(a.n, 0) AS post_ingestion, coalesce(a.n, 0) - coalesce(b.n, 0) AS new_rows,
                        CASE WHEN coalesce(a.n, 0) - coalesce(b.n, 0) > 0 THEN 'growth' ELSE 'no_growth' END AS status,
                        (coalesce(b.n, 0) - coalesce(a.n, 0)) / nullif(CAST(coalesce(b.n, 0) AS DOUBLE), 0) AS drop_ratio
                 FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1) b
                 FULL OUTER JOIN (SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-05' GROUP BY 1) a
                   ON a.event_type = b.event_type) x WHERE drop_ratio > 0.1""", ("drop_ratio",))


def _baseline_sql(as_of: str, days: int) -> str:
    return f"""SELECT event_type, {days} AS lookback_days, count(*) AS row_count, avg(value) AS mean_value,
                      stddev_pop(value) AS std_dev, min(value) AS min_value, max(value) AS max_value,
                      quantile_disc(value, 0.25) AS p25, quantile_disc(value, 0.75) AS p75,
                      avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) * 100.0 AS null_pct
               FROM ev_day WHERE observation_date > DATE '{as_of}' - {days} AND observation_date <= DATE '{as_of}'
               GROUP BY 1"""


_BASE_D = ("mean_value", "std_dev", "min_value", "max_value", "p25", "p75", "null_pct")
register("series_baselines", lambda s, d: Q.baselines(event_day_panel(s, d), "value", "2024-01-31", 14, ["event_type"]),
         _baseline_sql("2024-01-31", 14), _BASE_D)


def _drift(spark, d):
    p = event_day_panel(spark, d)
    cur = Q.baselines(p, "value", "2024-01-30", 14, ["event_type"])
    prev = Q.baselines(p, "value", "2024-01-16", 14, ["event_type"])
    return Q.baseline_drift(cur, prev, ["event_type"])


_st = ["row_count", "mean_value", "std_dev", "min_value", "max_value", "p25", "p75", "null_pct"]
register("baseline_drift", _drift, f"""
  SELECT coalesce(c.event_type, p.event_type) AS event_type,
         {', '.join(f'c.{s} AS cur_{s}' for s in _st)}, {', '.join(f'p.{s} AS prev_{s}' for s in _st)},
         {', '.join(f'c.{s} - p.{s} AS delta_{s}' for s in _st)},
         (c.mean_value - p.mean_value) / nullif(abs(p.mean_value), 0) * 100.0 AS mean_change_pct
  FROM ({_baseline_sql('2024-01-30', 14)}) c FULL OUTER JOIN ({_baseline_sql('2024-01-16', 14)}) p
    ON c.event_type = p.event_type""",
    tuple(f"{p}_{s}" for p in ("cur", "prev", "delta") for s in _st if s != "row_count") + ("mean_change_pct",))
register("completeness_pct", lambda s, d: Q.completeness(M.fct_economic_indicators_monthly(driver_economy(s, d, True)),
                                                         list(_MONTHLY_COLS)),
         "SELECT *, CASE WHEN completeness_pct < 90.0 THEN 'warning' ELSE 'passed' END AS check_status FROM (\n"
         + "\nUNION ALL ".join(f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NOT NULL THEN 1.0 ELSE 0.0 END) * 100.0 "
                               f"AS completeness_pct FROM fct_monthly" for c in _MONTHLY_COLS) + ") x",
         ("completeness_pct",))
register("missing_periods", lambda s, d: Q.missing_periods(part_month_panel(s, d), ["l_partkey"], D, "month"), """
  SELECT s.l_partkey, s.missing_period FROM (
    SELECT l_partkey, CAST(unnest(generate_series(min(period_date_key), max(period_date_key), INTERVAL 1 MONTH)) AS DATE)
           AS missing_period
    FROM pm GROUP BY 1) s
  ANTI JOIN pm p ON s.l_partkey = p.l_partkey AND s.missing_period = p.period_date_key""")


# ------------------------------------------------------------------ X8 pairwise correlation, long
#: what the twin of pairwise_corr_long holds; pairwise_corr_all has every series of the registry
PAIR_SERIES = ("CPIAUCSL", "FEDFUNDS", "HOUST", "UMCSENT", "UNRATE")
ALL_SERIES = ("CPIAUCSL", "FEDFUNDS", "GDPC1", "HOUST", "UMCSENT", "UNRATE")


def pairwise_corr_long(obs: DataFrame, keys, series=ALL_SERIES, frame: int = 12) -> DataFrame:
    """Long table (series_a, series_b, coefficient) of rolling correlations for the configured series.

    The configured series are pivoted to columns in one shuffle (a fixed
    value list, so the pivot is bounded), the rolling correlation of each
    configured pair is a window column, and ``stack`` turns them back into
    rows.  No self-join: the pairs come from the registry, not from the data.
    """
    from ..functions import series as S
    from ..operators.panel import series_window
    wide = obs.where(F.col("series_id").isin(*series)).groupBy(*keys, F.col("observation_date").alias(D)) \
        .pivot("series_id", list(series)).agg(F.first("value"))
    w = series_window(list(keys), D)
    pairs = [(a, b) for i, a in enumerate(series) for b in series[i + 1:]]
    cols = [S.round_half_up(S.rolling_corr(a, b, w, frame), 3).alias(f"{a}__{b}") for a, b in pairs]
    c = wide.select(*keys, D, *cols)
    st = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs)
    return c.select(*keys, D, F.expr(f"stack({len(pairs)}, {st}) AS (series_a, series_b, coefficient)"))


for _name, _series in (("pair_wide", PAIR_SERIES), ("pair_wide_all", ALL_SERIES)):
    cte(_name, f"""
  SELECT {K}, observation_date AS period_date_key,
         {', '.join(f"max(value) FILTER (WHERE series_id = '{s}') AS {s}" for s in _series)}
  FROM obs GROUP BY 1, 2""")


def _pairs_sql(series=PAIR_SERIES, wide="pair_wide"):
    from .operator_queries import _corr_sql
    return "\nUNION ALL ".join(
        f"SELECT {K}, period_date_key, '{a}' AS series_a, '{b}' AS series_b, {_corr_sql(a, b, 12, 'w')} AS coefficient "
        f"FROM {wide} WINDOW w AS (PARTITION BY {K} ORDER BY period_date_key)" for i, a in enumerate(series) for b in series[i + 1:])


register("pairwise_corr_long", lambda s, d: pairwise_corr_long(_obs(s, d), [SEGMENT], PAIR_SERIES), _pairs_sql())
register("pairwise_corr_all", lambda s, d: pairwise_corr_long(_obs(s, d), [SEGMENT]), _pairs_sql(ALL_SERIES, "pair_wide_all"))


# ------------------------------------------------------------------ check log
RUN_ID = f"run-{AS_OF}"
CHECKS = (  # check_type, resource, description, fail status, fail severity
    ("freshness", "economic_series", "Data freshness check - verify recent observations exist", "warning", "warning"),
    ("anomaly", "economic_series", "Z-score anomaly detection on latest values", "warning", "warning"),
    ("schema", "observations", "Natural key is unique", "failed", "critical"),
    ("source_freshness", "raw_tables", "Source freshness of load times", "failed", "critical"),
    ("row_count", "raw_tables", "Post-ingestion row count comparison", "warning", "warning"),
)


def check_log(spark: SparkSession, d: str) -> DataFrame:
    """Run the post-load checks over the segment panel and shape them as check-log rows."""
    obs = driver_economy(spark, d, True).observations  # five checks re-read the panel: cut once
    keys = [SEGMENT, "series_id"]
    stale = Q.staleness(obs, _expected(spark, d), AS_OF, keys)
    z = Q.latest_zscore(obs, "value", AS_OF, keys)
    dup = Q.unique(obs, keys + ["observation_date"])
    fresh = Q.source_freshness(obs, freshness_table(spark), AS_OF, keys)
    loaded_before = obs.where(F.col("ingested_at") < F.lit("2001-06-01").cast("timestamp_ntz"))
    growth = Q.row_count_growth(Q.row_counts(loaded_before, keys), Q.row_counts(obs, keys), keys)
    counts = [
        stale.agg(F.count_if(F.col("status") != "fresh").alias("n")),
        z.agg(F.count_if(F.col("anomaly_detected")).alias("n")),
        dup.agg(F.count(F.lit(1)).alias("n")),
        fresh.agg(F.count_if(F.col("freshness_status") == "error").alias("n")),
        growth.agg(F.when(F.sum("new_rows") == 0, 1).otherwise(0).alias("n")),
    ]
    rows = None
    for c, (ctype, res, desc, st, sev) in zip(counts, CHECKS):
        r = c.select(*Q.check_row(F.col("n"), ctype, res, desc, st, sev))
        rows = r if rows is None else rows.unionByName(r)
    run = F.lit(RUN_ID)
    return rows.select(F.sha2(F.concat_ws("|", run, F.col("check_type"), F.col("resource_name")), 256).alias("check_id"),
                       F.lit(AS_OF).cast("timestamp_ntz").alias("check_timestamp"), run.alias("pipeline_run_id"),
                       "check_type", "resource_name", "check_status", "severity", "metric_value", "threshold_value",
                       "description")


cte("chk_counts", f"""
  SELECT 'freshness' AS check_type, count(*) FILTER (WHERE status <> 'fresh') AS n FROM stale
  UNION ALL SELECT 'anomaly', count(*) FILTER (WHERE abs(zscore) > 3.0) FROM (
    SELECT CASE WHEN sd > 0 THEN (lv - mu) / sd ELSE 0.0 END AS zscore FROM (
      SELECT count(value) AS n, avg(value) AS mu, stddev_pop(value) AS sd, arg_max(value, observation_date) AS lv
      FROM obs WHERE observation_date >= DATE '{AS_OF}' - 730 AND value IS NOT NULL GROUP BY {K}, series_id) a
    WHERE n >= 2) z
  UNION ALL SELECT 'schema', count(*) FROM (SELECT 1 FROM obs GROUP BY {K}, series_id, observation_date HAVING count(*) > 1) u
  UNION ALL SELECT 'source_freshness', count(*) FILTER (WHERE age > error_days) FROM (
    SELECT date_diff('day', CAST(max(o.ingested_at) AS DATE), DATE '{AS_OF}') AS age, any_value(t.error_days) AS error_days
    FROM obs o JOIN ({_fresh_sql}) t ON o.series_id = t.series_id GROUP BY o.{K}, o.series_id) f
  UNION ALL SELECT 'row_count', CASE WHEN sum(post - pre) = 0 THEN 1 ELSE 0 END FROM (
    SELECT count(*) AS post, count(*) FILTER (WHERE ingested_at < TIMESTAMP '2001-06-01') AS pre FROM obs GROUP BY {K}, series_id) g""")
_checks_sql = " UNION ALL ".join(
    f"SELECT '{c}' AS check_type, '{r}' AS resource_name, '{desc}' AS description, '{st}' AS fst, '{sev}' AS fsev"
    for c, r, desc, st, sev in CHECKS)
cte("check_log", f"""
  SELECT sha256('{RUN_ID}' || '|' || c.check_type || '|' || c.resource_name) AS check_id,
         CAST(TIMESTAMP '{AS_OF}' AS TIMESTAMP) AS check_timestamp, '{RUN_ID}' AS pipeline_run_id,
         c.check_type, c.resource_name, CASE WHEN n.n > 0 THEN c.fst ELSE 'passed' END AS check_status,
         CASE WHEN n.n > 0 THEN c.fsev ELSE 'info' END AS severity, CAST(n.n AS DOUBLE) AS metric_value,
         CAST(NULL AS DOUBLE) AS threshold_value, c.description
  FROM ({_checks_sql}) c JOIN chk_counts n ON c.check_type = n.check_type""")

register("check_log", check_log, "SELECT * FROM check_log", ("metric_value", "threshold_value"))
register("check_summary", lambda s, d: Q.check_summary(check_log(s, d)), """
  SELECT pipeline_run_id, count(*) AS total_checks, count(*) FILTER (WHERE check_status = 'passed') AS passed,
         count(*) FILTER (WHERE check_status = 'failed') AS failed, count(*) FILTER (WHERE check_status = 'warning') AS warnings
  FROM check_log GROUP BY 1""")
register("critical_failures", lambda s, d: Q.critical_failures(check_log(s, d)),
         "SELECT * FROM check_log WHERE severity = 'critical' AND check_status = 'failed'", ("metric_value", "threshold_value"))
register("failure_digest", lambda s, d: Q.failure_digest(check_log(s, d)), """
  SELECT pipeline_run_id, failed, warnings, digest FROM (
    SELECT pipeline_run_id, count(*) FILTER (WHERE check_status = 'failed') AS failed,
           count(*) FILTER (WHERE check_status = 'warning') AS warnings,
           coalesce(array_to_string(list_sort(list('• ' || upper(check_type) || ' (' || resource_name || '): ' || description
                    || ' [_' || upper(severity) || '_]') FILTER (WHERE check_status IN ('failed', 'warning'))), chr(10)), '') AS digest
    FROM check_log GROUP BY 1) x WHERE failed > 0""")
register("daily_digest", lambda s, d: Q.daily_digest(check_log(s, d)), """
  SELECT pipeline_run_id, CASE WHEN failed > 0 THEN 'danger' WHEN warnings > 0 THEN 'warning' ELSE 'good' END AS color,
         total_checks, passed, warnings, failed, CAST(passed AS VARCHAR) || '/' || CAST(total_checks AS VARCHAR) AS passed_of_total,
         details FROM (
    SELECT pipeline_run_id, count(*) AS total_checks, count(*) FILTER (WHERE check_status = 'passed') AS passed,
           count(*) FILTER (WHERE check_status = 'failed') AS failed, count(*) FILTER (WHERE check_status = 'warning') AS warnings,
           array_to_string(list_sort(list(CASE WHEN check_status = 'passed' THEN 'OK' WHEN check_status = 'warning' THEN 'WARN'
                ELSE 'FAIL' END || ' ' || check_type || ': ' || description || ' (' || resource_name || ')')), chr(10)) AS details
    FROM check_log GROUP BY 1) x""")
register("recent_failures", lambda s, d: Q.recent_non_pass(check_log(s, d), AS_OF, 7), f"""
  SELECT * FROM check_log WHERE check_status <> 'passed' AND CAST(check_timestamp AS DATE) >= DATE '{AS_OF}' - 7""",
    ("metric_value", "threshold_value"))
register("check_log_monitor", lambda s, d: Q.check_log_monitor(check_log(s, d))[0], """
  SELECT CAST(check_timestamp AS DATE) AS check_date, count(*) AS n_checks,
         avg(CASE WHEN check_status = 'passed' THEN 1.0 ELSE 0.0 END) * 100.0 AS pass_rate_pct
  FROM check_log GROUP BY 1""", ("pass_rate_pct",))
register("check_log_last_status", lambda s, d: Q.check_log_monitor(check_log(s, d))[1], """
  SELECT resource_name, arg_max(check_status, (check_timestamp, check_id)) AS last_status FROM check_log GROUP BY 1""")
register("check_log_top_failing", lambda s, d: Q.check_log_monitor(check_log(s, d))[2], """
  SELECT check_type, resource_name, count(*) AS n_failures FROM check_log WHERE check_status <> 'passed'
  GROUP BY 1, 2 ORDER BY n_failures DESC, check_type, resource_name LIMIT 5""")


def run_results_summary(spark: SparkSession, d: str) -> DataFrame:
    """Write the check results as a test-run JSON document and read it back."""
    from ..session import shared_path
    path = shared_path(spark, f"run_results/{RUN_ID}-{uuid.uuid4().hex}")  # one document per call
    _write_run_results(spark, d, path)
    return O.run_results_summary(O.read_run_results(spark, path))


def _write_run_results(spark: SparkSession, d: str, path: str) -> None:
    """Write the check results as one test-run JSON document (``results`` array)."""
    log = check_log(spark, d)
    doc = log.agg(F.sort_array(F.collect_list(F.struct(  # one entry per check: bounded by the suite
        F.lit("test").alias("resource_type"),
        F.when(F.col("check_status") == "passed", "pass").otherwise("fail").alias("status"),
        F.col("check_type").alias("name"), F.col("check_id").alias("unique_id"),
        F.col("description").alias("message")))).alias("results"))
    doc.write.mode("overwrite").json(path)


def run_results_failed(spark: SparkSession, d: str) -> DataFrame:
    """The failed tests of a run-results document, one row each (S11: name, node id, status, message)."""
    from ..session import shared_path
    path = shared_path(spark, f"run_results/{RUN_ID}-{uuid.uuid4().hex}")  # one document per call
    _write_run_results(spark, d, path)
    r = O.read_run_results(spark, path)
    return r.where(F.col("status") == "fail").select(F.col("name").alias("test_name"),
                                                      F.col("unique_id").alias("node_id"), "status", "message")


register("run_results_failed", run_results_failed, """
  SELECT check_type AS test_name, check_id AS node_id, 'fail' AS status, description AS message
  FROM check_log WHERE check_status <> 'passed'""")
register("run_results_summary", run_results_summary, """
  SELECT 'schema' AS check_type, 'dbt_tests' AS resource_name,
         CASE WHEN count(*) FILTER (WHERE check_status <> 'passed') > 0 THEN 'failed' ELSE 'passed' END AS check_status,
         CASE WHEN count(*) FILTER (WHERE check_status <> 'passed') > 0 THEN 'critical' ELSE 'info' END AS severity,
         CAST(count(*) FILTER (WHERE check_status <> 'passed') AS DOUBLE) AS metric_value,
         count(*) FILTER (WHERE check_status <> 'passed') AS failed_tests,
         count(*) FILTER (WHERE check_status = 'passed') AS passed_tests
  FROM check_log""", ("metric_value",))

# ------------------------------------------------------------------ reports
register("overview", lambda s, d: RP.overview(driver_economy(s, d, True)), "SELECT * FROM overview",
         ("yoy_inflation_rate_pct", "unemployment_yoy_change_pct", "qoq_growth_pct", "yoy_growth_pct"))
register("inflation_history", lambda s, d: RP.inflation_history(driver_economy(s, d, True)), f"""
  SELECT {K}, period_date_key, year_month, yoy_inflation_rate_pct, mom_inflation_change_pct, inflation_severity_category,
         fedfunds_rate_pct, fed_policy_stance_to_inflation FROM fct_inflation WHERE period_date_key > DATE '1999-12-31'""",
    ("yoy_inflation_rate_pct",))
register("recession_history", lambda s, d: RP.recession_history(driver_economy(s, d, True)), f"""
  SELECT {K}, period_date_key, year_quarter, gdp_billions_usd, qoq_growth_pct, unemployment_rate_pct, yoy_inflation_rate_pct,
         recession_risk_level, recession_intensity_score, consecutive_negative_quarters
  FROM fct_recession WHERE period_date_key > DATE '1999-12-31'""", ("qoq_growth_pct", "yoy_inflation_rate_pct"))
register("employment_history", lambda s, d: RP.employment_history(driver_economy(s, d, True)), f"""
  SELECT {K}, period_date_key, year_month, unemployment_rate_pct, unemployment_yoy_change_pct, unemployment_trend,
         housing_starts_thousands, labor_market_health_score, labor_market_condition
  FROM fct_employment WHERE period_date_key > DATE '1999-12-31'""", ("unemployment_yoy_change_pct",))
cte("latest_qoq", f"""
  SELECT o.{K}, o.qoq_growth_pct AS overview_qoq, l.last_qoq, coalesce(o.qoq_growth_pct, l.last_qoq) AS gdp_qoq_growth_pct
  FROM overview o LEFT JOIN (SELECT {K}, arg_max(qoq_growth_pct, period_date_key) FILTER (WHERE qoq_growth_pct IS NOT NULL)
                                    AS last_qoq FROM fct_recession GROUP BY 1) l ON o.{K} = l.{K}""")
register("latest_qoq_fallback", lambda s, d: RP.latest_qoq(driver_economy(s, d, True)), "SELECT * FROM latest_qoq",
         ("overview_qoq", "last_qoq", "gdp_qoq_growth_pct"))
register("kpi_class", lambda s, d: RP.kpi_class(driver_economy(s, d, True)), f"""
  SELECT o.{K}, CASE WHEN coalesce(q.gdp_qoq_growth_pct, 0.0) >= 0 THEN '' ELSE 'c-red' END AS gdp_class,
         CASE WHEN coalesce(o.unemployment_yoy_change_pct, 0.0) > {T.kpi_unemp_red} THEN 'c-red'
              WHEN coalesce(o.unemployment_yoy_change_pct, 0.0) > {T.kpi_unemp_yellow} THEN 'c-yellow' ELSE '' END
           AS unemployment_class,
         CASE o.recession_risk_level WHEN 'Low' THEN 'c-green' WHEN 'Emerging' THEN 'c-yellow' WHEN 'Moderate' THEN 'c-orange'
              WHEN 'High' THEN 'c-red' ELSE '' END AS risk_class
  FROM overview o LEFT JOIN latest_qoq q ON o.{K} = q.{K}""")
register("top_k_recent", lambda s, d: RP.top_k_recent(driver_economy(s, d, True), 40), f"""
  SELECT {K}, year_quarter, gdp_billions_usd, qoq_growth_pct, unemployment_rate_pct, yoy_inflation_rate_pct,
         recession_risk_level, recession_intensity_score FROM fct_recession
  QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY year_quarter DESC) <= 40""",
    ("qoq_growth_pct", "yoy_inflation_rate_pct"))


def _f1(x: str) -> str:
    return f"CAST(CAST(round(CAST({x} AS DECIMAL(38,10)), 1) AS DECIMAL(18,1)) AS VARCHAR)"


def _sq(s: str) -> str:
    return s.replace("'", "''")


_A = f"(u < {T.snap_unemp_low} AND uc < {T.snap_unemp_yoy_low})"
_vmap = {i: "CASE r " + " ".join(f"WHEN '{v[0]}' THEN '{_sq(v[i])}'" for v in VERDICTS)
         + f" ELSE '{_sq(VERDICT_UNKNOWN[i - 1])}' END" for i in (1, 2, 3)}
register("economy_snapshot", lambda s, d: RP.economy_snapshot(driver_economy(s, d, True)), f"""
  SELECT {K}, r AS recession_risk_level,
    array_to_string(list_filter([
      CASE WHEN g > {T.snap_gdp_growing} THEN 'GDP is growing (+' || {_f1('g')} || '% QoQ)' END,
      CASE WHEN {_A} THEN 'unemployment near historical lows (' || {_f1('u')} || '%)' END,
      CASE WHEN NOT {_A} AND uc <= 0 THEN 'unemployment stable at ' || {_f1('u')} || '%' END,
      CASE WHEN inf <= {T.inflation_mild} THEN 'inflation near the Fed''s 2% target (' || {_f1('inf')} || '% YoY)' END],
      lambda x: x IS NOT NULL), ' | ') AS positives,
    array_to_string(list_filter([
      CASE WHEN g <= 0 THEN 'GDP contracted this quarter (' || {_f1('g')} || '% QoQ)' END,
      CASE WHEN NOT {_A} AND uc > {T.snap_unemp_yoy_fast} THEN 'unemployment rising fast (+' || {_f1('uc')} || '% YoY) — a classic early-recession signal' END,
      CASE WHEN inf > {T.inflation_moderate} THEN 'inflation running hot at ' || {_f1('inf')} || '% — above the 2% target' END,
      CASE WHEN fd = 'Rising' THEN 'Fed raising rates (' || {_f1('fed')} || '%) — tightening credit conditions' END],
      lambda x: x IS NOT NULL), ' | ') AS concerns,
    array_to_string(list_filter([
      CASE WHEN g > 0 AND g <= {T.snap_gdp_growing} THEN 'GDP growth is modest but positive (+' || {_f1('g')} || '% QoQ)' END,
      CASE WHEN NOT {_A} AND uc <= {T.snap_unemp_yoy_fast} AND uc > 0 THEN 'unemployment ticking up (' || {_f1('u')} || '%, +' || {_f1('uc')} || '% YoY) — worth watching' END,
      CASE WHEN inf > {T.inflation_mild} AND inf <= {T.inflation_moderate} THEN 'inflation is moderating but still elevated (' || {_f1('inf')} || '% YoY)' END,
      CASE WHEN fd = 'Falling' THEN 'Fed cutting rates (' || {_f1('fed')} || '%) — easing financial conditions' END,
      CASE WHEN fd <> 'Falling' AND fd <> 'Rising' THEN 'Fed holding rates steady at ' || {_f1('fed')} || '%' END],
      lambda x: x IS NOT NULL), ' | ') AS signals,
    {_vmap[1]} AS headline, {_vmap[2]} AS detail, {_vmap[3]} AS action
  FROM (SELECT o.{K}, coalesce(o.recession_risk_level, 'Unknown') AS r, coalesce(q.gdp_qoq_growth_pct, 0.0) AS g,
               coalesce(CAST(o.unemployment_rate_pct AS DOUBLE), 0.0) AS u, coalesce(o.unemployment_yoy_change_pct, 0.0) AS uc,
               coalesce(o.yoy_inflation_rate_pct, 0.0) AS inf, coalesce(CAST(o.fedfunds_rate_pct AS DOUBLE), 0.0) AS fed,
               coalesce(o.fedfunds_direction, '') AS fd
        FROM overview o LEFT JOIN latest_qoq q ON o.{K} = q.{K}) x""")

register("newest_months", lambda s, d: RP.newest_months(driver_economy(s, d, True), 10), f"""
  SELECT {K}, period_date_key, year_month, cpi_index, yoy_inflation_rate_pct, unemployment_rate_pct, fedfunds_rate_pct,
         sentiment_index, housing_starts_thousands FROM fct_monthly
  QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY period_date_key DESC) <= 10""", ("yoy_inflation_rate_pct",))
register("last_year", lambda s, d: RP.last_year(driver_economy(s, d, True)), f"""
  SELECT {K}, period_date_key, year_month, yoy_inflation_rate_pct, unemployment_rate_pct, fedfunds_rate_pct
  FROM (SELECT *, max(period_date_key) OVER (PARTITION BY {K}) AS newest FROM fct_monthly) m
  WHERE period_date_key > newest - INTERVAL 12 MONTH""", ("yoy_inflation_rate_pct",))


# ------------------------------------------------------------------ many-series daily panel (user × event type × day)
cte("ud", """
  SELECT user_id, event_type, CAST(ts AS DATE) AS observation_date,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value, count(*) AS n_events, max(ts) AS ingested_at
  FROM events GROUP BY 1, 2, 3""")
register("user_day_zscore", lambda s, d: Q.latest_zscore(user_day_panel(s, d), "value", EVENT_AS_OF,
                                                          ["user_id", "event_type"]), f"""
  SELECT user_id, event_type, n_points, latest_value, mean, stddev,
         CASE WHEN stddev > 0 THEN (latest_value - mean) / stddev ELSE 0.0 END AS zscore,
         abs(CASE WHEN stddev > 0 THEN (latest_value - mean) / stddev ELSE 0.0 END) > 3.0 AS anomaly_detected
  FROM (SELECT user_id, event_type, count(value) AS n_points, avg(value) AS mean, stddev_pop(value) AS stddev,
               arg_max(value, observation_date) AS latest_value
        FROM ud WHERE observation_date >= DATE '{EVENT_AS_OF}' - 730 AND value IS NOT NULL GROUP BY 1, 2) s
  WHERE n_points >= 2""", ("latest_value", "mean", "stddev", "zscore"))
register("user_missing_days", lambda s, d: Q.missing_periods(user_day_panel(s, d), ["user_id", "event_type"],
                                                             "observation_date", "day"), """
  SELECT s.user_id, s.event_type, s.missing_period FROM (
    SELECT user_id, event_type,
           CAST(unnest(generate_series(min(observation_date), max(observation_date), INTERVAL 1 DAY)) AS DATE) AS missing_period
    FROM ud GROUP BY 1, 2) s
  ANTI JOIN ud u ON s.user_id = u.user_id AND s.event_type = u.event_type AND s.missing_period = u.observation_date""")
register("recent_checks", lambda s, d: Q.recent_checks(check_log(s, d), 50), """
  SELECT * FROM check_log ORDER BY check_timestamp DESC, check_id DESC LIMIT 50""", ("metric_value", "threshold_value"))
