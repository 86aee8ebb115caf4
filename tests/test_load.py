"""Load operators: upsert, parse, slices, stream."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tidemark.sources import observations as O
from tidemark.streaming.incremental import load_stream

SCHEMA = "series_id string, observation_date date, value double, seq long"


def test_upsert_last_wins_and_idempotent(spark):
    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 2, 1)
    batch = spark.createDataFrame([("A", d1, 1.0, 1), ("A", d1, 2.0, 3), ("A", d2, 5.0, 2), ("B", d1, 7.0, 4)], SCHEMA)
    once = O.upsert(None, batch, ["series_id", "observation_date"], "seq")
    twice = O.upsert(once, batch, ["series_id", "observation_date"], "seq")
    got = sorted(tuple(r) for r in once.collect())
    assert got == [("A", d1, 2.0, 3), ("A", d2, 5.0, 2), ("B", d1, 7.0, 4)]
    assert sorted(tuple(r) for r in twice.collect()) == got


def test_parse_observations(spark):
    payloads = spark.createDataFrame([
        ("A", json.dumps({"observations": [{"date": "2020-01-01", "value": "1.5"}, {"date": "2020-02-01", "value": "."},
                                           {"date": "2020-03-01", "value": "abc"}, {"date": "20-1", "value": "2"}]})),
        ("B", json.dumps({"error": "no key"}))], "series_id string, payload string")
    parsed, bad = O.parse_observations(payloads)
    p = sorted((r.series_id, str(r.observation_date), r.value) for r in parsed.collect())
    assert p == [("A", "2020-01-01", 1.5), ("A", "2020-02-01", None)]
    assert sorted(r.reason for r in bad.collect()) == ["bad_date", "bad_value"]
    dropped, _ = O.parse_observations(payloads, drop_missing=True)
    assert dropped.count() == 1


def test_incremental_slice(spark):
    src = spark.createDataFrame([("A", dt.date(2020, 1, d), float(d)) for d in range(1, 31)] +
                                [("B", dt.date(2020, 1, d), float(d)) for d in range(1, 31)],
                                "series_id string, observation_date date, value double")
    tgt = src.where((F.col("series_id") == "A") & (F.col("observation_date") <= dt.date(2020, 1, 20)))
    out = O.incremental_slice(src, tgt, "2020-01-25", ["series_id"], lookback_days=3)
    got = sorted((r.series_id, r.observation_date.day) for r in out.collect())
    assert got == [("A", d) for d in range(21, 26)] + [("B", d) for d in range(22, 26)]


def test_stream_upsert_idempotent(spark, scratch):
    src, tgt, ck = (os.path.join(scratch, x) for x in ("src", "target", "ckpt"))
    os.makedirs(src)

    def drop(name, rows):
        with open(os.path.join(src, name), "w") as f:
            for sid, seq, obs in rows:
                f.write(json.dumps({"series_id": sid, "seq": seq, "payload": json.dumps({"observations": obs})}) + "\n")

    drop("a.json", [("A", 1, [{"date": "2020-01-01", "value": "1"}, {"date": "2020-02-01", "value": "2"}]),
                    ("B", 2, [{"date": "2020-01-01", "value": "9"}])])
    load_stream(spark, src, tgt, ck)
    drop("b.json", [("A", 3, [{"date": "2020-02-01", "value": "20"}, {"date": "2020-03-01", "value": "3"}])])
    load_stream(spark, src, tgt, ck)
    load_stream(spark, src, tgt, ck)  # nothing new: no change
    got = sorted((r.series_id, str(r.observation_date), r.value) for r in spark.read.parquet(tgt).collect())
    assert got == [("A", "2020-01-01", 1.0), ("A", "2020-02-01", 20.0), ("A", "2020-03-01", 3.0), ("B", "2020-01-01", 9.0)]


def test_pipeline_run_writes_tables_and_log(spark, scratch):
    import os as _os
    from tidemark.plans.pipeline import run_pipeline
    from tidemark.plans.quality_queries import check_log, RUN_ID
    from tidemark.plans.registry import driver_economy
    from tidemark.operators import quality as Q
    from tidemark.plans import models as M
    sf = "/root/testdata/sf0.001"
    ctx = driver_economy(spark, sf)
    fails = {"spike": Q.spike(M.stg_cpi(ctx), "cpi_index", 10.0, list(ctx.keys))}
    summary = run_pipeline(spark, ctx, scratch, check_log(spark, sf), RUN_ID, fails).collect()
    assert summary[0].total_checks == 5
    assert _os.path.isdir(_os.path.join(scratch, "fct_economic_indicators_monthly"))
    assert spark.read.parquet(_os.path.join(scratch, "fct_recession_analysis")).count() == M.fct_recession_analysis(ctx).count()
    assert _os.path.isdir(_os.path.join(scratch, "failures", "spike"))


def test_of_type_checks(spark):
    from tidemark.operators import quality as Q
    from tidemark.plans import models as M
    from tidemark.plans.registry import driver_economy
    ctx = driver_economy(spark, "/root/testdata/sf0.001")
    assert Q.of_type(M.stg_gdp(ctx), "gdp_billions_usd", ["decimal(18,2)"])
    assert Q.of_type(M.stg_cpi(ctx), "period_date_key", ["date", "timestamp"])
    assert not Q.of_type(M.stg_cpi(ctx), "cpi_index", ["double"])


def test_dashboard_from_tables_equals_direct(spark, scratch):
    from tidemark.plans.pipeline import write_models
    from tidemark.plans.registry import driver_economy
    from tidemark.plans import reports as RP
    ctx = driver_economy(spark, "/root/testdata/sf0.001", True)
    write_models(ctx, scratch, ["fct_inflation_analysis", "fct_recession_analysis", "fct_employment_analysis",
                                "vw_economic_overview_dashboard"])
    dash = RP.dashboard_from_tables(spark, scratch, ctx.keys)
    direct = {"inflation": RP.inflation_history(ctx), "recession": RP.recession_history(ctx),
              "employment": RP.employment_history(ctx), "overview": RP.overview(ctx)}
    for name, df in dash.items():
        cols = sorted(df.columns)
        a = sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
        b = sorted((tuple(r) for r in direct[name].select(*cols).collect()), key=repr)
        assert a == b, name


def test_stored_panel_prunes_series_partitions(spark, scratch):
    """The raw table is partitioned by series: a staged series reads one directory, filters reach the scan."""
    import os as _os
    from pyspark.sql import functions as F
    from tidemark.config import DRIVER_PANEL_THRESHOLDS
    from tidemark.plans import models as M
    from tidemark.sources.panels import SEGMENT, segment_observations
    path = _os.path.join(scratch, "observations")
    O.write_observations(segment_observations(spark, "/root/testdata/sf0.001"), path, [SEGMENT])
    ctx = M.Economy(O.read_observations(spark, path), keys=(SEGMENT,), thresholds=DRIVER_PANEL_THRESHOLDS)
    stg = M.stg_cpi(ctx)
    plan = stg._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(series_id" in plan and "CPIAUCSL" in plan
    hist = O.backfill_slice(ctx.observations, "2000-01-01")
    assert "GreaterThanOrEqual(observation_date,2000-01-01)" in hist._jdf.queryExecution().executedPlan().toString()
    # same results as the in-memory panel
    direct = M.stg_cpi(M.Economy(segment_observations(spark, "/root/testdata/sf0.001"), keys=(SEGMENT,),
                                 thresholds=DRIVER_PANEL_THRESHOLDS))
    cols = [SEGMENT, "period_date_key", "cpi_index", "is_latest"]
    assert sorted(map(tuple, stg.select(*cols).collect())) == sorted(map(tuple, direct.select(*cols).collect()))


def test_upsert_rewrites_only_touched_series(spark, scratch):
    import glob as _glob
    import os as _os
    path = _os.path.join(scratch, "obs")
    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 2, 1)
    first = spark.createDataFrame([("A", d1, 1.0, 1), ("B", d1, 2.0, 2)], SCHEMA)
    O.write_upsert(spark, first, path, ["series_id", "observation_date"], "seq", "series_id")
    b_files = sorted(_glob.glob(_os.path.join(path, "series_id=B", "*.parquet")))
    second = spark.createDataFrame([("A", d1, 10.0, 3), ("A", d2, 11.0, 4)], SCHEMA)
    out = O.write_upsert(spark, second, path, ["series_id", "observation_date"], "seq", "series_id")
    assert sorted(_glob.glob(_os.path.join(path, "series_id=B", "*.parquet"))) == b_files  # untouched
    got = sorted((r.series_id, str(r.observation_date), r.value) for r in out.collect())
    assert got == [("A", "2020-01-01", 10.0), ("A", "2020-02-01", 11.0), ("B", "2020-01-01", 2.0)]


def test_unreadable_table_raises_and_keeps_rows(spark, scratch):
    import pytest
    from tidemark.sources.observations import write_upsert
    path = f"{scratch}/table"
    kind = "series_id string, observation_date string, value double, seq long"
    first = spark.createDataFrame([("A", f"2024-01-0{i}", 1.0, 1) for i in (1, 2, 3)], kind)
    write_upsert(spark, first, path, ("series_id", "observation_date"), "seq", "series_id")
    bad = f"{path}/series_id=A/part-broken.parquet"
    with open(bad, "wb") as f:
        f.write(b"not parquet at all")
    with pytest.raises(Exception):
        write_upsert(spark, first.limit(1), path, ("series_id", "observation_date"), "seq", "series_id")
    os.remove(bad)
    assert spark.read.parquet(path).count() == 3


def test_malformed_payloads_are_kept_by_the_stream(spark, scratch):
    import json
    from tidemark.streaming.incremental import load_stream
    os.makedirs(f"{scratch}/in")
    good = json.dumps({"observations": [{"date": "2024-01-01", "value": "1"}, {"date": "2024-01-01", "value": "2"}, {"date": "x", "value": "3"}]})
    rows = [("A", 1, good), ("A", 1, "{broken"), ("B", 1, json.dumps({"other": 1}))]
    with open(f"{scratch}/in/a.json", "w") as f:
        f.writelines(json.dumps(dict(zip(("series_id", "seq", "payload"), r))) + "\n" for r in rows)
    load_stream(spark, f"{scratch}/in", f"{scratch}/t", f"{scratch}/c")
    assert [(r.series_id, r.value) for r in spark.read.parquet(f"{scratch}/t").collect()] == [("A", 2.0)]  # last by place
    q = spark.read.parquet(f"{scratch}/t_quarantine").collect()
    assert sorted(r.reason for r in q) == ["bad_date", "bad_payload"]
