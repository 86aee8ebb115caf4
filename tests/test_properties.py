"""Property tests: window operators against a brute-force pandas computation on random panels."""

import datetime as dt
import math
import random

import pandas as pd
import pytest
from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from tidemark.functions import series as S
from tidemark.operators.panel import series_window
from tidemark.sources import observations as O

D = "period_date_key"


def _months(n):
    out, y, m = [], 2000, 1
    for _ in range(n):
        out.append(dt.date(y, m, 1))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


value = st.one_of(st.none(), st.just(0.0), st.integers(-50, 50).map(float))
panel = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.lists(value, min_size=1, max_size=30)),
                 min_size=1, max_size=3, unique_by=lambda t: t[0])


def brute(rows, n_lag, n_avg):
    df = pd.DataFrame(rows, columns=["k", D, "x"]).sort_values(["k", D])
    out = {}
    for k, g in df.groupby("k"):
        xs = list(g["x"])
        for i, d in enumerate(g[D]):
            prev = xs[i - n_lag] if i >= n_lag else None
            pct = None
            if prev is not None and xs[i] is not None and not math.isnan(prev) and not math.isnan(xs[i]) and prev != 0:
                pct = (xs[i] - prev) / prev * 100.0
            frame = [v for v in xs[max(0, i - n_avg + 1): i + 1] if v is not None and not math.isnan(v)]
            avg = sum(frame) / len(frame) if frame else None
            out[(k, d)] = (pct, avg)
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(panel, st.integers(1, 12), st.integers(1, 12), st.randoms())
def test_pct_change_and_rolling_avg_match_brute_force(spark, data, n_lag, n_avg, rnd):
    rows = [(k, d, v) for k, vals in data for d, v in zip(_months(len(vals)), vals)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, period_date_key date, x double").repartition(3)
    w = series_window(["k"], D)
    got = {(r.k, r[D]): (r.p, r.a) for r in df.select("k", D, S.pct_change("x", w, n_lag).alias("p"),
                                                        S.rolling_avg("x", w, n_avg).alias("a")).collect()}
    exp = brute(rows, n_lag, n_avg)
    assert got.keys() == exp.keys()
    for key, (p, a) in exp.items():
        gp, ga = got[key]
        assert (gp is None) == (p is None) and (p is None or gp == pytest.approx(p, rel=1e-12, abs=1e-12)), key
        assert (ga is None) == (a is None) and (a is None or ga == pytest.approx(a, rel=1e-12, abs=1e-12)), key


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 10_000)), min_size=1, max_size=60,
                unique_by=lambda t: t[2]))
def test_upsert_matches_brute_force_and_is_order_free(spark, rows):
    # (key, day, seq): the highest seq per (key, day) wins
    df = spark.createDataFrame([(k, d, s, float(s)) for k, d, s in rows], "k int, d int, seq long, v double")
    got = sorted(tuple(r) for r in O.upsert(None, df, ["k", "d"], "seq").collect())
    best = {}
    for k, d, s in rows:
        if (k, d) not in best or s > best[(k, d)]:
            best[(k, d)] = s
    assert got == sorted((k, d, s, float(s)) for (k, d), s in best.items())
    again = O.upsert(O.upsert(None, df, ["k", "d"], "seq"), df.orderBy("seq", ascending=False), ["k", "d"], "seq")
    assert sorted(tuple(r) for r in again.collect()) == got


def test_upsert_with_a_hot_key(spark):
    """One key holds a third of all rows: partial aggregation collapses it before the shuffle."""
    rnd = random.Random(3)
    hot = [(0, 0, i, float(i)) for i in range(3000)]
    cold = [(rnd.randint(1, 500), rnd.randint(0, 30), 10_000 + i, 1.0) for i in range(6000)]
    df = spark.createDataFrame(hot + cold, "k int, d int, seq long, v double").repartition(8)
    out = O.upsert(None, df, ["k", "d"], "seq")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    row = out.where("k = 0 AND d = 0").collect()
    assert len(row) == 1 and row[0].seq == 2999
    assert out.count() == len({(k, d) for k, d, _, _ in hot + cold})


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 200), st.one_of(st.none(), st.integers(0, 9))),
                min_size=1, max_size=80, unique_by=lambda t: (t[0], t[1])), st.integers(1, 7))
def test_lag_by_position_equals_window_lag(spark, rows, bucket):
    from pyspark.sql import Window, functions as F
    from tidemark.operators.panel import lag_by_position
    df = spark.createDataFrame(rows, "k string, pos long, v int")
    got = {(r.k, r.pos): r.p for r in lag_by_position(df, ["k"], "pos", "v", "p", bucket).collect()}
    exp = {(r.k, r.pos): r.p for r in df.select("k", "pos", F.lag("v").over(Window.partitionBy("k").orderBy("pos")).alias("p")).collect()}
    assert got == exp
