"""Registered queries: registry-driven load rules, a check log of many runs, long series and spread quantiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SERIES
from ..operators import load_rules as L
from ..operators import quality as Q
from ..operators import spread
from ..operators.intervals import interval_join
from ..operators.payload import payload_verdict
from ..sources import observations as O
from ..sources.panels import SEGMENT
from ..sources.tables import read_table
from .quality_queries import AS_OF, event_payloads
from .registry import driver_economy, register
from .twins import K

# ------------------------------------------------------------------ S8: the registry first
NEVER = ("chargeback", "refund")   # registered series without events


def _report(spark: SparkSession, d: str) -> DataFrame:
    parsed, bad = O.parse_observations(event_payloads(spark, d), "payload", ["series_id", "event_id"])
    types = read_table(spark, d, "events", "event_type").distinct().select(F.col("event_type").alias("series_id"))
    registry = types.unionByName(spark.createDataFrame([(n,) for n in NEVER], "series_id string"))
    return L.load_report(parsed, bad, registry)


_report_sql = f"""
  SELECT series_id, count(event_id) AS fetched, count(*) FILTER (WHERE ok) AS upserted, count(*) FILTER (WHERE NOT ok) AS failed,
         CASE WHEN count(event_id) = 0 THEN 'no_data' WHEN count(*) FILTER (WHERE ok) > 0 THEN 'success' ELSE 'partial' END AS status
  FROM (SELECT series_id, event_id, date_str <> '2024-13-01' AND NOT coalesce(value_str = 'n/a', false) AS ok FROM ev_raw
        {' '.join(f"UNION ALL SELECT '{n}', NULL, NULL" for n in NEVER)}) x GROUP BY 1"""
register("load_report", _report, _report_sql)
register("load_report_totals", lambda s, d: L.load_report_totals(_report(s, d)), f"""
  SELECT count(*) AS series, count(*) FILTER (WHERE status = 'success') AS series_success,
         count(*) FILTER (WHERE status = 'partial') AS series_partial, count(*) FILTER (WHERE status = 'no_data') AS series_no_data,
         CAST(sum(fetched) AS BIGINT) AS total_fetched, CAST(sum(upserted) AS BIGINT) AS total_upserted, CAST(sum(failed) AS BIGINT) AS total_failed
  FROM ({_report_sql}) r""")
register("parse_quarantine", lambda s, d: O.parse_observations(event_payloads(s, d), "payload", ["series_id", "event_id"])[1]
         .select("series_id", "event_id", "pos", "reason"), """
  SELECT series_id, event_id, CAST(0 AS INTEGER) AS pos, CASE WHEN date_str = '2024-13-01' THEN 'bad_date' ELSE 'bad_value' END AS reason
  FROM ev_raw WHERE date_str = '2024-13-01' OR coalesce(value_str = 'n/a', false)""")
register("parse_raw_json", lambda s, d: O.parse_observations(event_payloads(s, d), "payload", ["series_id", "event_id"])[0]
         .select("series_id", "event_id", F.get_json_object("raw_json", "$.date").alias("raw_date"), F.get_json_object("raw_json", "$.value").alias("raw_value")), """
  SELECT series_id, event_id, date_str AS raw_date, value_str AS raw_value
  FROM (SELECT *, date_str <> '2024-13-01' AND NOT coalesce(value_str = 'n/a', false) AS ok FROM ev_raw) x WHERE ok""")


# ------------------------------------------------------------------ Q10, Q13, Q14
def _without_housing(spark, d):
    return driver_economy(spark, d).observations.where("series_id <> 'HOUST'")


def _expected(spark, d):
    each = F.explode(F.array(*[F.struct(F.lit(x.series_id).alias("series_id"), F.lit(x.fresh_warn_days).alias("warn_days"),
                                        F.lit(x.fresh_error_days).alias("error_days")) for x in SERIES]))
    return read_table(spark, d, "customer", SEGMENT).distinct().select(SEGMENT, each.alias("e")).select(SEGMENT, "e.*")


_limits = " UNION ALL ".join(f"SELECT '{x.series_id}' AS series_id, {x.fresh_warn_days} AS warn_days, {x.fresh_error_days} AS error_days" for x in SERIES)
register("freshness_registry", lambda s, d: L.freshness(_without_housing(s, d), _expected(s, d), AS_OF, [SEGMENT, "series_id"]), f"""
  SELECT *, CASE WHEN max_loaded_at IS NULL OR age_days > error_days THEN 'error' WHEN age_days > warn_days THEN 'warn' ELSE 'pass' END AS freshness_status
  FROM (SELECT e.{K}, t.series_id, l.max_loaded_at, CAST(date_diff('day', CAST(l.max_loaded_at AS DATE), DATE '{AS_OF}') AS INTEGER) AS age_days,
               t.warn_days, t.error_days
        FROM (SELECT DISTINCT {K} FROM customer) e CROSS JOIN ({_limits}) t
        LEFT JOIN (SELECT {K}, series_id, CAST(max(ingested_at) AS TIMESTAMP) AS max_loaded_at FROM obs WHERE series_id <> 'HOUST' GROUP BY 1, 2) l
          ON l.{K} = e.{K} AND l.series_id = t.series_id) x""")
register("row_count_snapshot", lambda s, d: L.row_count_snapshot(driver_economy(s, d).observations), """
  SELECT series_id AS table_name, count(*) AS row_count FROM obs GROUP BY 1 UNION ALL SELECT 'total', count(*) FROM obs""")


def _growth(spark, d):
    """Before: all events but those of the last type by name; after: all events before 20 January."""
    e = read_table(spark, d, "events", "event_type", "ts")
    before = Q.row_counts(e.where("event_type <> 'signup'"), ["event_type"])
    after = Q.row_counts(e.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")), ["event_type"])
    return L.growth_verdict(Q.row_count_growth(before, after, ["event_type"]), "event_type")


register("row_growth_verdict", _growth, """
  SELECT 'row_count' AS check_type, 'raw_tables' AS resource_name, CASE WHEN total_new_rows = 0 THEN 'warning' ELSE 'passed' END AS check_status,
         CASE WHEN total_new_rows = 0 THEN 'warning' ELSE 'info' END AS severity, total_new_rows, tables_with_no_growth
  FROM (SELECT CAST(coalesce(sum(greatest(n, 0)), 0) AS BIGINT) AS total_new_rows,
               coalesce(string_agg(event_type, ',' ORDER BY event_type) FILTER (WHERE n <= 0), '') AS tables_with_no_growth
        FROM (SELECT event_type, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-20') - count(*) FILTER (WHERE event_type <> 'signup') AS n
              FROM events GROUP BY 1) g) t""")


# ------------------------------------------------------------------ S10, R11, X11: a log of many runs
def run_log(spark: SparkSession, d: str) -> DataFrame:
    """Check rows of daily runs: rows and mean value per event type and day against the type's own mean over all days."""
    e = read_table(spark, d, "events", "event_id", "event_type", "ts", "value")
    day = e.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(20,4)")).alias("v"))
    typical = day.groupBy("event_type").agg(F.sum("n").alias("all_n"), F.sum("v").alias("all_v"), F.count(F.lit(1)).alias("days"))
    j = day.join(typical, "event_type")
    # whole numbers and decimals only: no engine's rounding decides
    rows = F.when(F.col("n") * F.col("days") * 100 < F.col("all_n") * 95, "failed").when(F.col("n") * F.col("days") < F.col("all_n"), "warning").otherwise("passed")
    value = F.when(F.col("v") * F.col("all_n") > F.col("all_v") * F.col("n"), "passed").otherwise("warning")
    checks = F.explode(F.array(F.struct(F.lit("row_count").alias("check_type"), rows.alias("check_status")),
                               F.struct(F.lit("mean_value").alias("check_type"), value.alias("check_status"))))
    return j.select(F.concat_ws("-", F.lit("run"), "day").alias("pipeline_run_id"), F.col("day").cast("timestamp_ntz").alias("check_timestamp"),
                    F.concat_ws("-", "event_type", "day").alias("check_id"), F.col("event_type").alias("resource_name"), checks.alias("c")) \
        .select("pipeline_run_id", "check_timestamp", F.concat_ws("-", "check_id", "c.check_type").alias("check_id"), "c.check_type", "resource_name", "c.check_status")


_log_sql = """
  SELECT 'run-' || day AS pipeline_run_id, CAST(day AS TIMESTAMP) AS check_timestamp, event_type || '-' || day || '-' || check_type AS check_id,
         check_type, event_type AS resource_name, check_status
  FROM (SELECT day, event_type, unnest(['row_count', 'mean_value']) AS check_type,
               unnest([CASE WHEN n * days * 100 < all_n * 95 THEN 'failed' WHEN n * days < all_n THEN 'warning' ELSE 'passed' END,
                       CASE WHEN v * all_n > all_v * n THEN 'passed' ELSE 'warning' END]) AS check_status
        FROM (SELECT *, sum(n) OVER t AS all_n, sum(v) OVER t AS all_v, count(*) OVER t AS days
              FROM (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, sum(CAST(value AS DECIMAL(20,4))) AS v FROM events GROUP BY 1, 2) g
              WINDOW t AS (PARTITION BY event_type)) h) x"""
register("run_log", run_log, _log_sql)
register("runs_pass_rate", lambda s, d: Q.check_log_monitor(run_log(s, d))[0], f"""
  SELECT CAST(check_timestamp AS DATE) AS check_date, count(*) AS n_checks,
         avg(CASE WHEN check_status = 'passed' THEN 1.0 ELSE 0.0 END) * 100.0 AS pass_rate_pct FROM ({_log_sql}) l GROUP BY 1""", ("pass_rate_pct",))
register("runs_last_status", lambda s, d: Q.check_log_monitor(run_log(s, d))[1],
         f"SELECT resource_name, arg_max(check_status, (check_timestamp, check_id)) AS last_status FROM ({_log_sql}) l GROUP BY 1")
register("runs_top_failing", lambda s, d: Q.check_log_monitor(run_log(s, d))[2], f"""
  SELECT check_type, resource_name, count(*) AS n_failures FROM ({_log_sql}) l WHERE check_status <> 'passed'
  GROUP BY 1, 2 ORDER BY n_failures DESC, check_type, resource_name LIMIT 10""")

# ------------------------------------------------------------------ W5, W10, A7 on series too long for one task
EVENTS = ("event_id", "event_type", "ts", "value")
register("rolling_long", lambda s, d: spread.rolling_avg(read_table(s, d, "events", *EVENTS).withColumn("cents", F.col("value").cast("decimal(18,4)")), "cents", 12,
                                                         ["ts", "event_id"], block=1000, name="rolling_12").select("event_id", F.col("rolling_12").cast("double")), """
  SELECT event_id, CAST(avg(CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE)) OVER (ORDER BY ts, event_id ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS DOUBLE) AS rolling_12
  FROM events""", ("rolling_12",))
register("spike_long", lambda s, d: spread.spike(read_table(s, d, "events", *EVENTS), "value", 500.0, ["ts", "event_id"], block=1000)
         .select("event_id", "event_type", "value", "prev_value"), """
  SELECT event_id, event_type, value, prev_value
  FROM (SELECT *, lag(value) OVER (ORDER BY ts, event_id) AS prev_value FROM events WHERE value IS NOT NULL) x
  WHERE abs((value - prev_value) / nullif(prev_value, 0) * 100.0) > 500.0""")
register("event_quantiles", lambda s, d: spread.quantiles(read_table(s, d, "events", "event_type", "value"), "value",
                                                         {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}, ["event_type"]), """
  SELECT event_type, quantile_disc(value, 0.25) AS p25, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.75) AS p75,
         quantile_disc(value, 0.99) AS p99 FROM events WHERE value IS NOT NULL GROUP BY 1""")


# ------------------------------------------------------------------ X2: verdict over whole payloads; J8: intervals
def grouped_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Payloads of many observations: the events of a type in 200 slices by id, in the order of their ids; every seventh is broken."""
    one = event_payloads(spark, d).select("series_id", "event_id", (F.col("event_id") % 200).alias("part"), "date_str", "value_str")
    rows = one.groupBy("series_id", "part").agg(F.sort_array(F.collect_list(F.struct("event_id", F.col("date_str").alias("date"), F.col("value_str").alias("value")))).alias("o"))
    text = F.to_json(F.struct(F.transform("o", lambda x: F.struct(x["date"].alias("date"), x["value"].alias("value"))).alias("observations")))
    # a lone observation can be as short as 40 characters: at least the last one goes, so that the rest is no JSON
    broken = F.substring("text", F.lit(1), F.least(F.lit(40), F.length("text") - 1))
    return rows.withColumn("text", text).select("series_id", "part", F.when(F.col("part") % 7 == 0, broken).otherwise(F.col("text")).alias("payload"))


def _verdicts(spark: SparkSession, d: str) -> DataFrame:
    v = payload_verdict(grouped_payloads(spark, d), "2024-01-25", ["series_id", "part"])
    n = lambda reason: F.coalesce(F.get(F.filter("issues", lambda i: i["reason"] == reason), F.lit(0))["n"], F.lit(0))
    return v.select("series_id", "part", "passed", "rejected", "rejected_for", "total", "valid", "invalid", *[
        n(x).alias(f"n_{x}") for x in ("missing_field", "bad_date", "not_numeric", "future_date", "duplicate_date", "out_of_order")])


register("payload_verdict", _verdicts, """
  SELECT series_id, part, rejected_for IS NULL AND invalid = 0 AS passed, rejected_for IS NOT NULL AS rejected, rejected_for, total,
         CAST(total - invalid AS INTEGER) AS valid, invalid, n_missing_field, n_bad_date, n_not_numeric, n_future_date, n_duplicate_date, n_out_of_order
  FROM (SELECT *, CASE WHEN part % 7 = 0 THEN 'bad_payload' WHEN invalid > total * 0.5 THEN 'too_many_invalid' END AS rejected_for
        FROM (SELECT series_id, part, CAST(CASE WHEN part % 7 = 0 THEN 0 ELSE count(*) END AS INTEGER) AS total,
                     CAST(count(*) FILTER (WHERE part % 7 <> 0 AND (missing OR bad OR nonnum OR fut OR dup)) AS INTEGER) AS invalid,
                     CAST(count(*) FILTER (WHERE part % 7 <> 0 AND missing) AS INTEGER) AS n_missing_field,
                     CAST(count(*) FILTER (WHERE part % 7 <> 0 AND bad) AS INTEGER) AS n_bad_date,
                     CAST(count(*) FILTER (WHERE part % 7 <> 0 AND nonnum) AS INTEGER) AS n_not_numeric,
                     CAST(count(*) FILTER (WHERE part % 7 <> 0 AND fut) AS INTEGER) AS n_future_date,
                     CAST(count(*) FILTER (WHERE part % 7 <> 0 AND dup) AS INTEGER) AS n_duplicate_date,
                     CAST(count(*) FILTER (WHERE part % 7 <> 0 AND back) AS INTEGER) AS n_out_of_order
              FROM (SELECT *, value_str IS NULL AS missing, dd IS NULL AS bad, coalesce(value_str = 'n/a', false) AS nonnum,
                           coalesce(dd > DATE '2024-01-25', false) AS fut, dd IS NOT NULL AND count(*) OVER (PARTITION BY series_id, part, dd) > 1 AS dup,
                           coalesce(dd < max(dd) OVER (PARTITION BY series_id, part ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS back
                    FROM (SELECT *, event_id % 200 AS part, CASE WHEN date_str <> '2024-13-01' THEN d END AS dd FROM ev_raw) a) b
              GROUP BY 1, 2) c) e""")


def _shipping_days(spark: SparkSession, d: str) -> DataFrame:
    """Per order day: its orders, and the large shipments on their way that day (two weeks from shipping)."""
    days = read_table(spark, d, "orders", "o_orderdate").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    ways = read_table(spark, d, "lineitem", "l_orderkey", "l_quantity", "l_shipdate").where("l_quantity >= 45").select(
        F.col("l_shipdate").cast("date").alias("first"), F.date_add(F.col("l_shipdate").cast("date"), 13).alias("last"), "l_quantity")
    j = interval_join(days, ways, "day", "first", "last", bin_days=14, how="left")
    return j.groupBy("day", "orders").agg(F.count("first").alias("on_their_way"), F.coalesce(F.sum(F.col("l_quantity").cast("decimal(12,2)")), F.lit(0)).cast("double").alias("quantity"))


register("interval_join", _shipping_days, """
  SELECT o.day, o.orders, count(l.first) AS on_their_way, CAST(coalesce(sum(CAST(l.l_quantity AS DECIMAL(12,2))), 0) AS DOUBLE) AS quantity
  FROM (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1) o
  LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS first, CAST(l_shipdate AS DATE) + 13 AS last, l_quantity FROM lineitem WHERE l_quantity >= 45) l
    ON o.day BETWEEN l.first AND l.last
  GROUP BY 1, 2""", ("quantity",))
