"""Panel conventions: one long DataFrame holds many series; ``keys`` name a
series and ``date`` orders it.  Every window is partitioned by ``keys`` so the
work spreads over the cluster, one series per window partition (SURVEY §1.4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def series_window(keys: Sequence[str], date: str = "period_date_key") -> WindowSpec:
    if not keys:
        # A single global series: only safe after aggregation to period grain,
        # where the row count is bounded by the calendar.
        return Window.orderBy(F.col(date))
    return Window.partitionBy(*[F.col(k) for k in keys]).orderBy(F.col(date))


def latest_flag(df: DataFrame, keys: Sequence[str], date: str = "period_date_key",
                name: str = "is_latest") -> DataFrame:
    """``row_number() over (partition by keys order by date desc) = 1``.

    Dates are unique per series, so ``date = max(date)`` over the whole series
    is the same flag.  The frame uses the same partition and order as the
    series windows, so the planner evaluates it in the same Window operator
    and sort as the lags that usually follow.
    """
    w = series_window(keys, date).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn(name, F.col(date) == F.max(F.col(date)).over(w))


def aggregate_to_period(df: DataFrame, keys: Sequence[str], date_col: str, value_aggs: dict,
                        grain: str = "month", out: str = "period_date_key") -> DataFrame:
    """Aggregate raw rows to one row per (keys, period) before any window.

    ``value_aggs`` maps output name -> aggregate Column.  The hash aggregate is
    partial+final, so a hot key is combined map-side before the shuffle.
    """
    period = F.trunc(F.col(date_col).cast("date"), grain).alias(out)
    return df.groupBy(*[F.col(k) for k in keys], period).agg(
        *[agg.alias(name) for name, agg in value_aggs.items()])


def lag_by_position(df: DataFrame, keys: Sequence[str], pos: str, value: str, out: str,
                    bucket_size: int = 1_000_000) -> DataFrame:
    """``lag(value) over (partition by keys order by pos)`` without one task per series.

    A plain window puts every row of a series in one task; a series holding a
    third of all rows would be sorted there.  Here rows are cut into position
    buckets of at most ``bucket_size`` rows (positions are unique per series):

    1. inside (keys, bucket) the previous row is a windowed ``lag`` - groups
       are bounded by the bucket size;
    2. each bucket's last value is a ``max_by`` aggregate (partial, so small);
    3. the first row of a bucket takes the last value of the nearest earlier
       bucket of its series: a window over the per-bucket rows, whose groups
       are bounded by positions / bucket_size;
    4. an equi join on (keys, bucket) brings that value back.
    """
    k = [F.col(c) for c in keys]
    b = F.floor(F.col(pos) / F.lit(bucket_size)).alias("_bucket")
    r = df.withColumn("_bucket", b)
    w_in = Window.partitionBy(*k, F.col("_bucket")).orderBy(F.col(pos))
    r = r.withColumn("_lag_in", F.lag(F.col(value)).over(w_in)) \
         .withColumn("_first", F.row_number().over(w_in) == 1)
    last = r.groupBy(*k, "_bucket").agg(F.max_by(F.col(value), F.col(pos)).alias("_last"))
    w_b = Window.partitionBy(*k).orderBy(F.col("_bucket"))
    carry = last.select(*k, "_bucket", F.lag(F.col("_last")).over(w_b).alias("_carry"))
    j = r.join(carry, on=list(keys) + ["_bucket"], how="left")
    return j.withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_lag_in"))) \
            .drop("_bucket", "_lag_in", "_first", "_carry")
