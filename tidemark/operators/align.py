"""Alignment, joins and keyed aggregates.

Broadcast is used only for tables whose size is bounded by construction
(recession intervals, a series registry, one stats row per panel key is left
to AQE).  Everything else is an equi join that the planner sizes itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import month_start, quarter_start


def _cols(keys: Sequence[str]) -> list[Column]:
    return [F.col(k) for k in keys]


def align_full(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer equi join; USING coalesces the key columns."""
    return a.join(b, on=list(on), how="full")


def align_many(frames: Sequence[tuple[str, DataFrame]], on: Sequence[str],
               presence_prefix: str = "_has_") -> DataFrame:
    """Align several sources on a shared key in ONE shuffle.

    Instead of a chain of full outer joins (one shuffle each), the sources are
    unioned by name (columns a source lacks are null) and grouped by the key.
    Each source has at most one row per key, so ``max`` of a column is that
    source's value.  ``_has_<name>`` is 1 when the source has the key, else 0.
    The aggregate is partial+final, so it also survives a hot key.
    """
    on = list(on)
    value_cols: list[str] = []
    parts = []
    for name, df in frames:
        cols = [c for c in df.columns if c not in on]
        value_cols += cols
        parts.append(df.select(*on, *cols, F.lit(1).alias(presence_prefix + name)))
    unioned = parts[0]
    for p in parts[1:]:
        unioned = unioned.unionByName(p, allowMissingColumns=True)
    aggs = [F.max(c).alias(c) for c in value_cols]
    aggs += [F.coalesce(F.max(presence_prefix + n), F.lit(0)).alias(presence_prefix + n) for n, _ in frames]
    return unioned.groupBy(*on).agg(*aggs)


def quarter_start_join(quarterly: DataFrame, monthly: DataFrame, keys: Sequence[str],
                       date: str = "period_date_key") -> DataFrame:
    """Left join a quarterly frame to the month that starts each quarter.

    Quarter keys are quarter starts, so the equi join on the date picks the
    first month of the quarter, as the reference does.
    """
    return quarterly.join(monthly, on=list(keys) + [date], how="left")


def to_quarter_means(monthly: DataFrame, keys: Sequence[str], value_cols: Sequence[str],
                     date: str = "period_date_key") -> DataFrame:
    """Pre-aggregate monthly rows to quarter means before a derived-key join."""
    return monthly.groupBy(*_cols(keys), quarter_start(date).alias(date)).agg(
        *[F.avg(F.col(c).cast("double")).alias(c) for c in value_cols])


def derived_key_join(quarterly: DataFrame, monthly: DataFrame, keys: Sequence[str], value_cols: Sequence[str],
                     date: str = "period_date_key") -> DataFrame:
    """``q.date = date_trunc('quarter', m.date)`` without the 3x fan-out (J5, ledger #2)."""
    return quarterly.join(to_quarter_means(monthly, keys, value_cols, date), on=list(keys) + [date], how="left")


def rollup_period(df: DataFrame, keys: Sequence[str], value_cols: Sequence[str], grain: str = "quarter",
                  date: str = "period_date_key", prefix: str = "avg_") -> DataFrame:
    """Means of measures by period with year and period number (A1)."""
    start = quarter_start(date) if grain == "quarter" else month_start(date)
    out = df.groupBy(*_cols(keys), start.alias(date)).agg(
        *[F.avg(F.col(c).cast("double")).alias(prefix + c) for c in value_cols])
    part = F.quarter(F.col(date)) if grain == "quarter" else F.month(F.col(date))
    return out.withColumn("year", F.year(F.col(date))).withColumn(grain, part)


def column_stats(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean and population σ over non-null values, per key or global (A2)."""
    v = F.col(value).cast("double")
    aggs = [F.avg(v).alias("mean_value"), F.stddev_pop(v).alias("std_value")]
    filtered = df.where(F.col(value).isNotNull())
    return filtered.groupBy(*_cols(keys)).agg(*aggs) if keys else filtered.agg(*aggs)


def attach_stats(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Attach mean/σ to every row.

    Global: the stats are one row, so the broadcast is size-bounded.  Panel: an
    equi join on the keys (one stats row per series), sized by the planner.
    """
    stats = column_stats(df, value, keys)
    if keys:
        return df.join(stats, on=list(keys), how="inner")
    return df.crossJoin(F.broadcast(stats))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str = "period_date_key",
                   tie_break: Sequence[str] = ()) -> DataFrame:
    """Newest row per key (W8).  Plans as WindowGroupLimit (rank pushed below the shuffle)."""
    w = Window.partitionBy(*_cols(keys)).orderBy(F.col(order).desc(), *[F.col(t).desc() for t in tie_break])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def one_row_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """``distinct on (keys)`` with a full, deterministic tie-break.

    ``max_by(struct(row), struct(order_by))`` is an aggregate: partial
    aggregation collapses duplicates map-side, so a key holding a third of all
    rows is never sorted inside one task.
    """
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in order_by])
    picked = df.groupBy(*_cols(keys)).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("_r"))
    return picked.select(*_cols(keys), *[F.col(f"_r.{c}").alias(c) for c in rest])


def last_non_null(df: DataFrame, value: str, keys: Sequence[str] = (), date: str = "period_date_key",
                  out: str | None = None) -> DataFrame:
    """Value at the newest date where it is not null (T5)."""
    v = F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(date)))
    name = out or value
    return df.groupBy(*_cols(keys)).agg(v.alias(name)) if keys else df.agg(v.alias(name))


def interval_tag(periods: DataFrame, intervals: DataFrame, date: str = "period_date",
                 start: str = "start_date", end: str = "end_date", label: str = "interval_name") -> DataFrame:
    """Tag months lying inside named intervals (J8) as an equi join.

    Each interval is exploded to its month starts (bounded by its length), then
    joined on the month.  A BETWEEN join would plan a nested loop; this stays a
    hash join whatever the number of periods.  The exploded interval table is a
    handful of rows per interval, so broadcasting it is size-bounded.
    """
    months = intervals.select(
        F.explode(F.sequence(month_start(start), month_start(end), F.expr("INTERVAL 1 MONTH"))).alias("_m"),
        F.col(label))
    tagged = periods.join(F.broadcast(months), month_start(date) == F.col("_m"), "left").drop("_m")
    return tagged


def calendar_lag(df: DataFrame, keys: Sequence[str], value: str, months: int, out: str,
                 date: str = "period_date_key") -> DataFrame:
    """Value of the same series ``months`` calendar months earlier (ledger #1, ``calendar=True``).

    A row lag counts rows, so a missing month shifts it; this is an equi join
    of the panel with itself moved forward by ``months`` (each row matches at
    most one row), so a gap gives null instead.
    """
    prev = df.select(*_cols(keys), F.add_months(F.col(date), months).alias(date), F.col(value).alias(out))
    return df.join(prev, on=list(keys) + [date], how="left")
