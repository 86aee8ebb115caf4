"""Payload verdicts by hand, the binned interval join against all pairs, sketches against exact distributions."""

import bisect
import datetime as dt
import json
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import sketches as K
from tidemark.operators.intervals import interval_join
from tidemark.operators.payload import PayloadRules, payload_verdict
from tidemark.plans.catalog import QUERIES


def obs(*pairs):
    return json.dumps({"observations": [{"date": d, "value": v} for d, v in pairs]})


CASES = {
    "good": (obs(("2020-01-01", "1"), ("2020-02-01", ".")), (True, None, 2, 2, {})),
    "empty": ('{"observations": []}', (True, None, 0, 0, {})),
    "no json": ("{", (False, "bad_payload", 0, 0, {"bad_payload": 1})),
    "null": (None, (False, "bad_payload", 0, 0, {"bad_payload": 1})),
    "no list": ('{"other": 1}', (False, "bad_observations", 0, 0, {"bad_observations": 1})),
    "one bad of three": (obs(("2020-01-01", "1"), ("2020-02-01", "x"), ("2020-03-01", "3")), (False, None, 3, 2, {"not_numeric": 1})),
    "rejected": (obs(("2020-13-01", "1"), ("1850-01-01", "2"), ("2020-03-01", "3")), (False, "too_many_invalid", 3, 1, {"too_many_invalid": 1, "bad_date": 1, "before_1900": 1})),
    "order": (obs(("2020-02-01", "1"), ("2020-01-01", "2"), ("2020-03-01", "2")), (True, None, 3, 3, {"out_of_order": 1})),
    "twice": (obs(("2020-01-01", "1"), ("2020-01-01", "2"), ("2020-03-01", "1"), ("2020-04-01", "1"), ("2020-05-01", "1")), (False, None, 5, 3, {"duplicate_date": 2})),
    "odd": (json.dumps({"observations": [1, None, {"date": "2020-01-01"}, {"date": "2099-01-01", "value": "1"}]}),
            (False, "too_many_invalid", 4, 0, {"too_many_invalid": 1, "bad_element": 2, "missing_field": 1, "future_date": 1})),
}


def test_payload_verdicts(spark):
    t = spark.createDataFrame([(k, v[0]) for k, v in CASES.items()], "series_id string, payload string")
    out = payload_verdict(t, "2021-01-01")
    got = {r.series_id: (r.passed, r.rejected_for, r.total, r.valid, {i.reason: i.n for i in r.issues}) for r in out.collect()}
    assert got == {k: v[1] for k, v in CASES.items()}
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    strict = {r.series_id for r in payload_verdict(t, "2021-01-01", rules=PayloadRules(most_invalid=0.0)).where("rejected").collect()}
    assert "one bad of three" in strict and "good" not in strict


def test_long_payloads_are_judged_in_the_time_of_their_length(spark):
    """20,000 observations a payload against a plain loop; work with the square of that takes minutes."""
    rng, rows, want = random.Random(8), [], {}
    for k in range(4):
        o = [(rng.choice([None, "2024-13-01"]) if rng.random() < 0.1 else str(dt.date(1890, 1, 1) + dt.timedelta(days=rng.randrange(50_000))),
              rng.choice([None, ".", "x", "1.5", "2"])) for _ in range(20_000)]
        rows.append((str(k), obs(*o)))
        days = [dt.date.fromisoformat(d) if d and d != "2024-13-01" else None for d, _ in o]
        often, top, n, invalid = Counter(days), None, Counter(), 0
        for (date, value), d in zip(o, days, strict=True):
            found = {"missing_field": date is None or value is None, "bad_date": date is not None and d is None, "not_numeric": value == "x",
                     "future_date": d is not None and d > dt.date(2021, 1, 1), "before_1900": d is not None and d < dt.date(1900, 1, 1),
                     "duplicate_date": d is not None and often[d] > 1}
            invalid += any(found.values())
            n.update(x for x, y in found.items() if y)
            n["out_of_order"] += d is not None and top is not None and d < top
            top = max((x for x in (d, top) if x is not None), default=None)
        want[str(k)] = (20_000, invalid, dict(n) | ({"too_many_invalid": 1} if invalid > 10_000 else {}))
    t0 = time.monotonic()
    out = payload_verdict(spark.createDataFrame(rows, "series_id string, payload string"), "2021-01-01").collect()
    assert {r.series_id: (r.total, r.invalid, {i.reason: i.n for i in r.issues}) for r in out} == want
    assert time.monotonic() - t0 < 60


def test_every_seventh_payload_is_broken_however_short(spark, scratch):
    """A lone observation without a value makes a text of 40 characters: event 3,400 is one of slice 0."""
    spark.createDataFrame([(3400, dt.datetime(2024, 1, 2), "a", 1.0)], "event_id long, ts timestamp_ntz, event_type string, value double") \
        .write.parquet(f"{scratch}/events.parquet")
    assert [r.rejected_for for r in QUERIES["payload_verdict"](spark, scratch).collect()] == ["bad_payload"]


@pytest.mark.parametrize("bin_days, how", [(1, "inner"), (32, "inner"), (1000, "left")])
def test_interval_join_equals_all_pairs(spark, bin_days, how):
    rng = random.Random(2)
    day = lambda: dt.date(1969, 11, 1) + dt.timedelta(days=rng.randrange(200))  # noqa: E731  (bins before 1970 too)
    rows = [(i, rng.choice("ab"), day()) for i in range(120)] + [(200, "a", None), (201, None, dt.date(1970, 1, 1))]
    ivs = []
    for i in range(60):
        s = day()
        ivs.append((i, rng.choice("ab"), s, s + dt.timedelta(days=rng.randrange(-3, 40))))
    ivs += [(100, "a", None, dt.date(1970, 1, 1)), (101, "a", dt.date(1970, 1, 1), None)]
    r = spark.createDataFrame(rows, "id int, k string, d date")
    v = spark.createDataFrame(ivs, "iv int, k string, s date, e date")
    out = interval_join(r, v, "d", "s", "e", ["k"], bin_days, how)
    got = sorted(((x.id, x.iv) for x in out.collect()), key=repr)
    want = [(i, j) for i, k, d in rows for j, k2, s, e in ivs if k is not None and k == k2 and d and s and e and s <= d <= e]
    if how == "left":
        hit = {i for i, _ in want}
        want += [(i, None) for i, *_ in rows if i not in hit]
    assert got == sorted(want, key=repr)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_drift_with_equal_mean_and_deviation_is_seen(spark):
    rng = random.Random(4)
    rows = []
    for d in range(10):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=d)
        for _ in range(400):
            rows.append(("same", day, rng.gauss(0, 1)))
            rows.append(("shape", day, rng.gauss(0, 1) if d < 5 else rng.choice([-1.0, 1.0])))  # mean 0, deviation 1 as before
            rows.append(("moved", day, rng.gauss(0, 1) + (d >= 5)))
    rows += [("gone", dt.date(2024, 1, 2), 1.0), ("new", dt.date(2024, 1, 9), 1.0), ("same", dt.date(2024, 1, 9), None)]
    t = spark.createDataFrame(rows, "series_id string, observation_date date, value double").repartition(4)
    s = K.daily_sketches(t, "value")
    a, b = K.lookback(s, "2024-01-06", "2024-01-10"), K.lookback(s, "2024-01-01", "2024-01-05")
    got = {r.series_id: r for r in K.distribution_drift(a, b).collect()}
    assert {k: r.status for k, r in got.items()} == {"same": "stable", "shape": "drift", "moved": "drift", "gone": "missing", "new": "missing"}
    for name in ("same", "shape", "moved"):
        x, y = ([v for k, d, v in rows if k == name and v is not None and (d >= dt.date(2024, 1, 6)) == late] for late in (True, False))
        x.sort(), y.sort()
        exact = max(abs(bisect.bisect_right(x, p) / len(x) - bisect.bisect_right(y, p) / len(y)) for p in x + y)
        assert abs(got[name].distance - exact) < 0.05 and (got[name].n, got[name].n_previous) == (len(x), len(y))


def test_empty(spark):
    none = spark.createDataFrame([], "series_id string, observation_date date, value double")
    s = K.daily_sketches(none, "value")
    assert K.distribution_drift(K.lookback(s, "2024-01-01", "2024-01-02"), K.lookback(s, "2024-01-01", "2024-01-02")).count() == 0
    assert interval_join(none.withColumnRenamed("observation_date", "d"), none.selectExpr("observation_date s", "observation_date e"), "d", "s", "e").count() == 0
    assert payload_verdict(spark.createDataFrame([], "series_id string, payload string"), "2021-01-01").count() == 0
    assert none.select(F.count("*")).first()[0] == 0
