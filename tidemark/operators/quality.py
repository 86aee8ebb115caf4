"""Data-quality operators.

Each check is a cluster-side aggregation.  Column checks return the failing
rows; run-level checks return rows shaped like the check log
(check_type, resource_name, check_status, severity, description,
metric_value, threshold_value, details_json).  Several column checks of one
table run in ONE aggregation (``count_if`` per check), not one query each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_STALE_DAYS
from ..functions.calendar import month_start
from . import align as A
from .panel import lag_by_position


def _k(keys: Sequence[str]) -> list[Column]:
    return [F.col(k) for k in keys]


# --------------------------------------------------------------------------
# Column checks -> failing rows
# --------------------------------------------------------------------------

def not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is null (Q1)."""
    return df.where(F.col(col).isNull())


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count and row count of many columns in one pass, one row per column (Q1 bulk)."""
    cols = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.select(F.col("_n").alias("row_count"),
                      F.expr(f"stack({len(cols)}, {pairs}) AS (column_name, null_count)"))


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their count."""
    return df.groupBy(*_k(keys)).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def accepted_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Rows whose non-null value is outside the list (Q3)."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(*values))


def of_type(df: DataFrame, col: str, type_names: Sequence[str]) -> bool:
    """Declared type of ``col`` is one of ``type_names`` (Q4, Q5): a schema check, no job."""
    return df.schema[col].dataType.simpleString() in set(type_names)


def between(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Rows whose non-null value is outside the closed range."""
    c = F.col(col)
    return df.where(c.isNotNull() & ((c < lo) | (c > hi)))


def valid_range_by_series(df: DataFrame, value: str, ranges: DataFrame, series_col: str = "series_id") -> DataFrame:
    """Rows outside their own series' range (Q7 over a long panel).

    ``ranges`` is the series registry (one row per configured series), so the
    broadcast is bounded by the registry size.
    """
    j = df.join(F.broadcast(ranges), on=series_col, how="inner")
    c = F.col(value)
    return j.where(c.isNotNull() & ((c < F.col("range_min")) | (c > F.col("range_max"))))


def spike(df: DataFrame, col: str, pct: float, keys: Sequence[str] = (), date: str = "period_date_key") -> DataFrame:
    """Rows whose change against the previous non-null row exceeds ``pct`` percent."""
    w = Window.partitionBy(*_k(keys)).orderBy(F.col(date)) if keys else Window.orderBy(F.col(date))
    x = F.col(col).cast("double")
    s = df.where(F.col(col).isNotNull()).withColumn("prev_value", F.lag(x).over(w))
    change = F.abs(F.try_divide(x - F.col("prev_value"), F.col("prev_value")) * 100.0)
    return s.withColumn("change_pct", change).where(F.col("prev_value").isNotNull() & (F.col("change_pct") > pct))


def outlier(df: DataFrame, col: str, k: float, keys: Sequence[str] = ()) -> DataFrame:
    """Rows with |z| > k against the column's mean and population σ (Q9 via A2 + J6).

    σ = 0 gives a null z (never flagged).  Global stats are one row
    (broadcast is size-bounded); per-key stats are an equi join.
    """
    base = df.where(F.col(col).isNotNull())
    withs = A.attach_stats(base, col, keys)
    z = F.abs(F.try_divide(F.col(col).cast("double") - F.col("mean_value"), F.nullif(F.col("std_value"), F.lit(0.0))))
    return withs.withColumn("z_score", z).where(F.col("z_score") > k)


def future_dates(df: DataFrame, as_of: str, date: str = "observation_date") -> DataFrame:
    """Rows dated after ``as_of``."""
    return df.where(F.col(date) > F.lit(as_of).cast("date"))


# --------------------------------------------------------------------------
# Series-level checks
# --------------------------------------------------------------------------

def source_freshness(df: DataFrame, thresholds: DataFrame, as_of: str, keys: Sequence[str] = ("series_id",),
                     loaded_at: str = "ingested_at", series_col: str = "series_id") -> DataFrame:
    """Age of the newest load time against warn/error days (Q10).

    ``thresholds``: the registry (series_id, warn_days, error_days); how it is
    joined is left to the planner, which sees its size.
    """
    latest = df.groupBy(*_k(keys)).agg(F.max(loaded_at).alias("max_loaded_at"))
    j = latest.join(thresholds, on=series_col, how="inner")
    age = F.datediff(F.lit(as_of).cast("date"), F.col("max_loaded_at").cast("date"))
    status = F.when(age > F.col("error_days"), "error").when(age > F.col("warn_days"), "warn").otherwise("pass")
    return j.select(*_k(keys), "max_loaded_at", age.alias("age_days"), "warn_days", "error_days",
                    status.alias("freshness_status"))


def latest_zscore(df: DataFrame, value: str, as_of: str, keys: Sequence[str] = ("series_id",),
                  date: str = "observation_date", lookback_days: int = 730, limit: float = 3.0,
                  min_points: int = 2, exclude_latest: bool = False) -> DataFrame:
    """Population z of each series' newest value within the lookback (Q11).

    One grouped aggregate (mean, σ, newest value by ``max_by``, count) for
    all series at once; series with fewer than ``min_points`` values are
    skipped; σ = 0 gives z = 0; ``anomaly`` when |z| > ``limit``.  With
    ``exclude_latest`` the mean and σ come from the other points only, so the
    newest value is not part of its own sample (ledger #15: inside its sample
    |z| is at most √(n−1)).  The sums for that are taken in the same pass.
    """
    lo = F.date_sub(F.lit(as_of).cast("date"), lookback_days)
    v = F.col(value).cast("double")
    w = df.where((F.col(date) >= lo) & F.col(value).isNotNull())
    if exclude_latest:
        s = w.groupBy(*_k(keys)).agg(F.count(v).alias("_n"), F.sum(v).alias("_s"), F.sum(v * v).alias("_ss"),
                                     F.max_by(v, F.col(date)).alias("latest_value"))
        n1 = F.col("_n") - 1
        mean = F.try_divide(F.col("_s") - F.col("latest_value"), n1)
        var = F.try_divide(F.col("_ss") - F.col("latest_value") * F.col("latest_value"), n1) - mean * mean
        s = s.select(*_k(keys), n1.alias("n_points"), "latest_value", mean.alias("mean"),
                     F.sqrt(F.greatest(var, F.lit(0.0))).alias("stddev"))
    else:
        s = w.groupBy(*_k(keys)).agg(F.count(v).alias("n_points"), F.avg(v).alias("mean"),
                                     F.stddev_pop(v).alias("stddev"), F.max_by(v, F.col(date)).alias("latest_value"))
    z = F.when(F.col("stddev") > 0, (F.col("latest_value") - F.col("mean")) / F.col("stddev")).otherwise(F.lit(0.0))
    return s.where(F.col("n_points") >= min_points).select(
        *_k(keys), "n_points", "latest_value", "mean", "stddev", z.alias("zscore"),
        (F.abs(z) > limit).alias("anomaly_detected"))


def staleness(df: DataFrame, expected: DataFrame, as_of: str, keys: Sequence[str] = ("series_id",),
              date: str = "observation_date") -> DataFrame:
    """Age of the newest observation against the series' window (Q12).

    ``expected`` lists every series that should exist (with ``window_days``);
    it drives the join, so a series with no rows reports ``no_data``.
    """
    latest = df.groupBy(*_k(keys)).agg(F.max(date).alias("latest_date"))
    j = expected.join(latest, on=list(keys), how="left")
    days = F.datediff(F.lit(as_of).cast("date"), F.col("latest_date"))
    window = F.coalesce(F.col("window_days"), F.lit(DEFAULT_STALE_DAYS))
    status = F.when(F.col("latest_date").isNull(), "no_data").when(days > window, "stale").otherwise("fresh")
    return j.select(*_k(keys), "latest_date", days.alias("days_old"), "window_days", status.alias("status"))


def row_counts(df: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Exact row count per table/series (Q13, A3)."""
    return df.groupBy(*_k(keys)).agg(F.count(F.lit(1)).alias("row_count"))


def row_count_growth(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """new = after − coalesce(before, 0) per table; growth / no_growth (Q14).

    ``before``/``after`` are count frames (keys, row_count); a full join so a
    table missing on either side still appears.
    """
    b = before.withColumnRenamed("row_count", "pre_ingestion")
    a = after.withColumnRenamed("row_count", "post_ingestion")
    j = b.join(a, on=list(keys), how="full")
    pre, post = F.coalesce("pre_ingestion", F.lit(0)), F.coalesce("post_ingestion", F.lit(0))
    new = post - pre
    return j.select(*_k(keys), pre.alias("pre_ingestion"), post.alias("post_ingestion"), new.alias("new_rows"),
                    F.when(new > 0, "growth").otherwise("no_growth").alias("status"))


def row_drop(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("series_id",), max_drop: float = 0.10) -> DataFrame:
    """Tables whose row count fell by more than ``max_drop`` against the previous run."""
    g = row_count_growth(before, after, keys)
    ratio = F.try_divide(F.col("pre_ingestion") - F.col("post_ingestion"), F.col("pre_ingestion").cast("double"))
    return g.withColumn("drop_ratio", ratio).where(F.col("drop_ratio") > max_drop)


def baselines(df: DataFrame, value: str, as_of: str, lookback_days: int, keys: Sequence[str] = ("series_id",),
              date: str = "observation_date") -> DataFrame:
    """Per-series profile over the lookback: count, mean, σ, min, max, p25, p75, null %.

    Quantiles are exact at any size (the lower order statistic): values are
    counted map-side per key and value, and a running sum over a key's
    distinct values, sorted and never buffered, picks the rank.
    """
    hi = F.lit(as_of).cast("date")
    w = df.where((F.col(date) > F.date_sub(hi, lookback_days)) & (F.col(date) <= hi))
    v = F.col(value).cast("double")
    per = w.where(v.isNotNull()).groupBy(*_k(keys), v.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    run = Window.partitionBy(*_k(keys)).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = [f"_q{i}" for i in range(len(keys))]
    n = per.groupBy(*_k(keys)).agg(F.sum("_c").alias("_n")).select(*[F.col(k).alias(q) for k, q in zip(keys, names, strict=True)], "_n")
    same = [F.col(k).eqNullSafe(F.col(q)) for k, q in zip(keys, names, strict=True)]
    ranked = per.withColumn("_to", F.sum("_c").over(run)).join(n, same)
    at = {p: F.min(F.when(F.col("_to") >= F.col("_n") * q, F.col("_v"))).alias(p) for p, q in (("p25", 0.25), ("p75", 0.75))}
    quant = ranked.groupBy(*names).agg(*at.values())
    stats = w.groupBy(*_k(keys)).agg(
        F.lit(lookback_days).alias("lookback_days"),
        F.count(F.lit(1)).alias("row_count"), F.avg(v).alias("mean_value"), F.stddev_pop(v).alias("std_dev"),
        F.min(v).alias("min_value"), F.max(v).alias("max_value"),
        (F.avg(F.when(F.col(value).isNull(), 1.0).otherwise(0.0)) * 100.0).alias("null_pct"))
    return stats.join(quant, same, "left").select(*_k(keys), "lookback_days", "row_count", "mean_value", "std_dev",
                                                  "min_value", "max_value", "p25", "p75", "null_pct")


def baseline_drift(current: DataFrame, previous: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Profile now against the previous baseline, with deltas."""
    stats = ["row_count", "mean_value", "std_dev", "min_value", "max_value", "p25", "p75", "null_pct"]
    c = current.select(*_k(keys), *[F.col(s).alias(f"cur_{s}") for s in stats])
    p = previous.select(*_k(keys), *[F.col(s).alias(f"prev_{s}") for s in stats])
    j = c.join(p, on=list(keys), how="full")
    return j.select("*", *[(F.col(f"cur_{s}") - F.col(f"prev_{s}")).alias(f"delta_{s}") for s in stats],
                    (F.try_divide(F.col("cur_mean_value") - F.col("prev_mean_value"),
                                  F.abs(F.col("prev_mean_value"))) * 100.0).alias("mean_change_pct"))


def completeness(df: DataFrame, cols: Sequence[str], warn_below: float = 90.0) -> DataFrame:
    """% non-null per column in one pass, unpivoted; warn under ``warn_below``."""
    cols = list(cols)
    agg = df.agg(*[(F.avg(F.when(F.col(c).isNotNull(), 1.0).otherwise(0.0)) * 100.0).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    out = agg.select(F.expr(f"stack({len(cols)}, {pairs}) AS (column_name, completeness_pct)"))
    return out.withColumn("check_status", F.when(F.col("completeness_pct") < warn_below, "warning").otherwise("passed"))


def missing_periods(df: DataFrame, keys: Sequence[str], date: str = "period_date_key", grain: str = "month") -> DataFrame:
    """Calendar periods absent between each series' first and last period.

    Each series' spine is bounded by its own calendar span; the anti join is
    an equi join on (keys, period).
    """
    step = F.expr("INTERVAL 1 MONTH") if grain == "month" else F.expr("INTERVAL 1 DAY")
    norm = month_start(date) if grain == "month" else F.col(date).cast("date")
    have = df.select(*_k(keys), norm.alias("_p")).distinct()
    span = have.groupBy(*_k(keys)).agg(F.min("_p").alias("_lo"), F.max("_p").alias("_hi"))
    spine = span.select(*_k(keys), F.explode(F.sequence("_lo", "_hi", step)).alias("_p"))
    return spine.join(have, on=list(keys) + ["_p"], how="left_anti").withColumnRenamed("_p", "missing_period")


def validate_observations(parsed_raw: DataFrame, as_of: str, keys: Sequence[str] = ("series_id",),
                          date_str: str = "date_str", value_str: str = "value_str", pos: str = "pos",
                          bucket_size: int = 1_000_000) -> DataFrame:
    """Payload validation (X2): every reason an observation is invalid, and counts per series.

    Reasons: missing field, date not ISO, value not numeric, date in the
    future or before 1900, duplicate date in the series, out of order.
    """
    d = F.try_to_date(F.col(date_str), "yyyy-MM-dd")
    num = F.expr(f"try_cast({value_str} AS DOUBLE)")
    r = parsed_raw.select(*_k(keys), pos, date_str, value_str, d.alias("_d"), num.alias("_v"))
    # duplicates: an aggregate (partial, so a hot date combines map-side) joined back
    dups = r.where(F.col("_d").isNotNull()).groupBy(*_k(keys), "_d").agg(F.count(F.lit(1)).alias("_dups"))
    r = r.join(dups, on=list(keys) + ["_d"], how="left")
    # order: each observation against the previous one of its series by position,
    # computed in position buckets so a huge series is not sorted in one task
    r = lag_by_position(r, keys, pos, "_d", "_prev", bucket_size)
    reasons = F.array_compact(F.array(
        F.when(F.col(date_str).isNull() | F.col(value_str).isNull(), F.lit("missing_field")),
        F.when(F.col(date_str).isNotNull() & F.col("_d").isNull(), F.lit("bad_date")),
        F.when(F.col(value_str).isNotNull() & (F.col(value_str) != ".") & F.col("_v").isNull(), F.lit("not_numeric")),
        F.when(F.col("_d") > F.lit(as_of).cast("date"), F.lit("future_date")),
        F.when(F.col("_d") < F.lit("1900-01-01").cast("date"), F.lit("before_1900")),
        F.when(F.col("_dups") > 1, F.lit("duplicate_date")),
        F.when(F.col("_d") < F.col("_prev"), F.lit("out_of_order"))))
    return r.select(*_k(keys), pos, date_str, value_str, reasons.alias("reasons"),
                    (F.size(reasons) == 0).alias("is_valid"))


def validation_counts(validated: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    return validated.groupBy(*_k(keys)).agg(F.count(F.lit(1)).alias("total"),
                                            F.count_if(F.col("is_valid")).alias("valid"),
                                            F.count_if(~F.col("is_valid")).alias("invalid"))


# --------------------------------------------------------------------------
# Check-log rows and run-level summaries
# --------------------------------------------------------------------------

def check_row(failing_count: Column, check_type: str, resource: str, description: str,
              fail_status: str = "warning", fail_severity: str = "warning",
              threshold: float | None = None) -> list[Column]:
    """Columns of one check-log row from a count of failing items."""
    failed = failing_count > 0
    return [F.lit(check_type).alias("check_type"), F.lit(resource).alias("resource_name"),
            F.when(failed, F.lit(fail_status)).otherwise(F.lit("passed")).alias("check_status"),
            F.when(failed, F.lit(fail_severity)).otherwise(F.lit("info")).alias("severity"),
            F.lit(description).alias("description"), failing_count.cast("double").alias("metric_value"),
            F.lit(threshold).cast("double").alias("threshold_value")]


def check_summary(checks: DataFrame, keys: Sequence[str] = ("pipeline_run_id",)) -> DataFrame:
    """Totals of passed / failed / warning per run (Q16, A4)."""
    return checks.groupBy(*_k(keys)).agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("check_status") == "passed").alias("passed"),
        F.count_if(F.col("check_status") == "failed").alias("failed"),
        F.count_if(F.col("check_status") == "warning").alias("warnings"))


def critical_failures(checks: DataFrame) -> DataFrame:
    """Rows that are critical and failed; any such row fails the run (Q17)."""
    return checks.where((F.col("severity") == "critical") & (F.col("check_status") == "failed"))


def failure_digest(checks: DataFrame, keys: Sequence[str] = ("pipeline_run_id",)) -> DataFrame:
    """One text line per failed or warning check, per run with failures (Q18).

    The lines of one run are bounded by the size of the check suite.
    """
    bad = checks.where(F.col("check_status").isin("failed", "warning"))
    line = F.concat(F.lit("• "), F.upper(F.col("check_type")), F.lit(" ("), F.col("resource_name"), F.lit("): "),
                    F.col("description"), F.lit(" [_"), F.upper(F.col("severity")), F.lit("_]"))
    lines = bad.groupBy(*_k(keys)).agg(F.sort_array(F.collect_list(line)).alias("_l"))
    summary = check_summary(checks, keys).where(F.col("failed") > 0)
    return summary.join(lines, on=list(keys), how="left").select(
        *_k(keys), "failed", "warnings", F.array_join(F.coalesce("_l", F.array()), "\n").alias("digest"))


def daily_digest(checks: DataFrame, keys: Sequence[str] = ("pipeline_run_id",)) -> DataFrame:
    """Colour by worst status, counts, and one line per check (Q19)."""
    icon = F.when(F.col("check_status") == "passed", "OK").when(F.col("check_status") == "warning", "WARN").otherwise("FAIL")
    line = F.concat(icon, F.lit(" "), F.col("check_type"), F.lit(": "), F.col("description"), F.lit(" ("),
                    F.col("resource_name"), F.lit(")"))
    lines = checks.groupBy(*_k(keys)).agg(F.sort_array(F.collect_list(line)).alias("_l"))
    s = check_summary(checks, keys)
    color = F.when(F.col("failed") > 0, "danger").when(F.col("warnings") > 0, "warning").otherwise("good")
    return s.join(lines, on=list(keys), how="left").select(
        *_k(keys), color.alias("color"), "total_checks", "passed", "warnings", "failed",
        F.concat(F.col("passed").cast("string"), F.lit("/"), F.col("total_checks").cast("string")).alias("passed_of_total"),
        F.array_join("_l", "\n").alias("details"))


def recent_checks(checks: DataFrame, n: int = 50) -> DataFrame:
    """Newest ``n`` check rows (R11, top-k by time is the feature)."""
    return checks.orderBy(F.col("check_timestamp").desc(), F.col("check_id").desc()).limit(n)


def recent_non_pass(checks: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Non-passing checks in the last ``days`` days."""
    lo = F.date_sub(F.lit(as_of).cast("date"), days)
    return checks.where((F.col("check_status") != "passed") & (F.col("check_timestamp").cast("date") >= lo))


def check_log_monitor(checks: DataFrame, top: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pass rate per day, last status per resource, most frequent failing checks (X11)."""
    day = F.col("check_timestamp").cast("date")
    rate = checks.groupBy(day.alias("check_date")).agg(
        F.count(F.lit(1)).alias("n_checks"),
        (F.avg(F.when(F.col("check_status") == "passed", 1.0).otherwise(0.0)) * 100.0).alias("pass_rate_pct"))
    last = checks.groupBy("resource_name").agg(
        F.max_by(F.col("check_status"), F.struct("check_timestamp", "check_id")).alias("last_status"))
    failing = checks.where(F.col("check_status") != "passed").groupBy("check_type", "resource_name").agg(
        F.count(F.lit(1)).alias("n_failures"))
    topf = failing.orderBy(F.col("n_failures").desc(), F.col("check_type"), F.col("resource_name")).limit(top)
    return rate, last, topf
