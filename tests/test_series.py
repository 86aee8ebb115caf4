"""Series operators on hand-made frames (FIXTURES §5)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import series as S
from tidemark.operators.panel import series_window, latest_flag
from tidemark.operators import align as A
from tidemark.operators import quality as Q

D = "period_date_key"


def months(n, start=(2000, 1)):
    y, m = start
    out = []
    for _ in range(n):
        out.append(dt.date(y, m, 1))
        m += 1
        if m > 12:
            y, m = y + 1, 1
    return out


def frame(spark, rows, schema="k string, period_date_key date, x double, y double"):
    return spark.createDataFrame(rows, schema)


def test_constant_series(spark):
    rows = [("a", d, 5.0, 5.0) for d in months(15)]
    w = series_window(["k"], D)
    out = frame(spark, rows).select(D, S.rolling_avg("x", w, 3).alias("r"), S.rolling_corr("x", "y", w, 12).alias("c"),
                                     S.pct_change("x", w, 12).alias("yoy")).orderBy(D).collect()
    assert all(r.r == 5.0 for r in out)
    assert all(r.c is None for r in out)          # zero variance -> null, never an error
    assert [r.yoy for r in out[12:]] == [0.0, 0.0, 0.0]
    assert all(r.yoy is None for r in out[:12])


def test_row_lag_vs_missing_month(spark):
    ds = months(14)
    rows = [("a", d, float(i + 1), None) for i, d in enumerate(ds) if i != 5]  # month 6 missing
    df = frame(spark, rows)
    w = series_window(["k"], D)
    out = df.select(D, S.lag_of("x", w, 12).alias("l")).orderBy(D).collect()
    # 13 rows: the row lag of the last row is 12 rows back = month 1 (value 1.0), not month 2
    assert out[-1].l == 1.0
    gaps = Q.missing_periods(df, ["k"], D).collect()
    assert [g.missing_period for g in gaps] == [ds[5]]


def test_zero_denominator_gives_null(spark):
    rows = [("a", d, v, None) for d, v in zip(months(3), [0.0, 2.0, 2.0])]
    w = series_window(["k"], D)
    out = frame(spark, rows).select(D, S.pct_change("x", w, 1).alias("p")).orderBy(D).collect()
    assert out[1].p is None and out[2].p == 0.0


def test_rolling_corr_known_value(spark):
    xs = [1.0, 2.0, 3.0, 4.0]
    ys = [2.0, 4.0, 6.0, 9.0]
    rows = [("a", d, x, y) for d, x, y in zip(months(4), xs, ys)]
    w = series_window(["k"], D)
    out = frame(spark, rows).select(D, S.rolling_corr("x", "y", w, 12).alias("c")).orderBy(D).collect()
    import numpy as np
    assert out[0].c is None
    assert out[-1].c == pytest.approx(np.corrcoef(xs, ys)[0, 1], rel=1e-12)


def test_panel_equals_per_series_and_shuffle_invariant(spark):
    rnd = random.Random(7)
    rows = [(k, d, float(rnd.randint(1, 100)), float(rnd.randint(1, 100))) for k in ("a", "b") for d in months(30)]
    rnd.shuffle(rows)
    w = series_window(["k"], D)

    def run(df):
        return sorted(tuple(r) for r in df.select("k", D, S.pct_change("x", w, 12).alias("p"),
                                                   S.rolling_avg("x", w, 6).alias("m"),
                                                   S.rolling_corr("x", "y", w, 12).alias("c")).collect())
    both = run(frame(spark, rows).repartition(5))
    sep = run(frame(spark, [r for r in rows if r[0] == "a"])) + run(frame(spark, [r for r in rows if r[0] == "b"]))
    assert both == sorted(sep)


def test_latest_flag_and_last_non_null(spark):
    rows = [("a", d, v, None) for d, v in zip(months(4), [1.0, 2.0, None, None])]
    df = frame(spark, rows)
    flags = {r[D]: r.is_latest for r in latest_flag(df, ["k"], D).collect()}
    assert sum(flags.values()) == 1 and flags[months(4)[-1]]
    last = A.last_non_null(df, "x", ["k"], D).collect()[0]
    assert last.x == 2.0


def test_rolling_count_if(spark):
    rows = [("a", d, v, None) for d, v in zip(months(6), [-1.0, 1.0, -1.0, -1.0, 1.0, 1.0])]
    w = series_window(["k"], D)
    out = frame(spark, rows).select(D, S.rolling_count_if(F.col("x") < 0, w, 4).alias("n")).orderBy(D).collect()
    assert [r.n for r in out] == [1, 1, 2, 3, 2, 2]


def test_calendar_lag_sees_gaps(spark):
    ds = months(14)
    rows = [("a", d, float(i + 1), None) for i, d in enumerate(ds) if i != 1]  # month 2 missing
    out = {r[D]: r.prev for r in A.calendar_lag(frame(spark, rows), ["k"], "x", 12, "prev").collect()}
    assert out[ds[12]] == 1.0 and out[ds[13]] is None  # month 14's year-ago month is the gap


def test_zscore_exclude_latest(spark):
    rows = [("a", d, v, None) for d, v in zip(months(9), [10.0] * 8 + [1000.0])]
    df = frame(spark, rows).withColumnRenamed(D, "observation_date")
    inside = Q.latest_zscore(df, "x", "2001-01-01", ["k"]).collect()[0]
    outside = Q.latest_zscore(df, "x", "2001-01-01", ["k"], exclude_latest=True).collect()[0]
    assert abs(inside.zscore) <= 8 ** 0.5 + 1e-9 and not inside.anomaly_detected
    assert outside.stddev == 0.0 and outside.zscore == 0.0  # the other eight points are constant
