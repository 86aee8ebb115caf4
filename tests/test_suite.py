"""The declared check suite and the publish gate."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.declared import Check, checks
from tidemark.operators import suite
from tidemark.plans import models as M
from tidemark.plans import publish as P
from tidemark.plans.registry import driver_economy
from tidemark.sources.store import SeriesStore

SF = "/root/testdata/sf0.001"
DAY = [dt.date(2020, m, 1) for m in range(1, 5)]
ROWS = [("a", DAY[0], "x", 1.0, 1), ("a", DAY[0], "y", None, 2), ("b", DAY[0], None, 50.0, 3), ("b", DAY[1], "z", -1.0, None), ("b", None, "x", 10.0, 4),
        ("b", None, "x", 0.0, 4)]
SPEC = [Check("m", "period_date_key", "not_null"), Check("m", "period_date_key", "unique"), Check("m", "label", "accepted_values", ("x", "y"), "warn"),
        Check("m", "value", "between", (0, 10)), Check("m", "value", "of_type", ("numeric",)), Check("m", "label", "of_type", ("numeric",)),
        Check("m", "n", "not_null", (), "warn"), Check("m", "nowhere", "not_null")]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS, "k string, period_date_key date, label string, value double, n int")


def test_counts_by_hand(frame):
    got = {(r.column_name, r.check_name): (r.row_count, r.failures, r.status) for r in suite.check_model(frame, SPEC, ["k"]).collect()}
    assert got == {("period_date_key", "not_null"): (6, 2, "fail"), ("period_date_key", "unique"): (6, 1, "fail"), ("label", "accepted_values"): (6, 1, "warn"),
                   ("value", "between"): (6, 2, "fail"), ("value", "of_type"): (6, 0, "pass"), ("label", "of_type"): (6, 1, "fail"),
                   ("n", "not_null"): (6, 1, "warn"), ("nowhere", "not_null"): (6, None, "missing")}
    two = [Check("m", "period_date_key", "unique"), Check("m", "n", "unique")]
    assert [r.failures for r in suite.check_model(frame, two, ["k"]).collect()] == [1, 1]


def test_empty_model(frame):
    got = suite.check_model(frame.limit(0), SPEC, ["k"]).collect()
    assert {(r.row_count, r.failures) for r in got if r.column_name not in ("nowhere",) and r.check_name != "of_type"} == {(0, 0)}


def test_failing_rows_and_details(spark, frame):
    bad = suite.failing_rows(frame, SPEC, ["k"])
    rows = sorted(((r.column_name, r.check_name, json.loads(r.economy)["k"], str(r.period), r.found) for r in bad.collect()), key=repr)
    assert rows == sorted([("period_date_key", "not_null", "b", "None", None)] * 2 + [
        ("label", "accepted_values", "b", "2020-02-01", "z"), ("value", "between", "b", "2020-01-01", "50.0"),
        ("value", "between", "b", "2020-02-01", "-1.0"), ("n", "not_null", "b", "2020-02-01", None),
        ("period_date_key", "unique", "a", "2020-01-01", "2")], key=repr)
    d = {(r.column_name, r.check_name): json.loads(r.details_json) for r in suite.failure_details(bad, 1).collect()}
    assert d["value", "between"] == {"economies": 1, "rows": 2, "worst": [{"economy": '{"k":"b"}', "rows": 2, "first": "2020-01-01", "last": "2020-02-01"}]}


def test_one_scan_per_model(frame):
    plan = suite.check_model(frame, SPEC, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LocalRelation") + plan.count("LogicalRDD") == 1


def test_declared():
    cs = checks()
    assert len(cs) == len({c.name for c in cs}) == 277 and {c.model for c in cs} == set(M.MODELS) - {"vw_economic_overview_dashboard"}


def bounds_off(cs):
    """The driver's panel runs in units of its own: level bounds of staging don't hold there."""
    return [c for c in cs if not (c.kind == "between" and c.model.startswith("stg_"))]


def test_gate_keeps_the_last_good_run(spark, scratch):
    ctx = driver_economy(spark, SF)
    good = P.publish(ctx.materialize(), scratch, "run1", "2001-12-01 00:00:00", bounds_off(checks()))
    assert good.published, good.failed
    before = sorted(map(tuple, P.read_model(spark, scratch, "fct_inflation_analysis").drop("dbt_loaded_at").collect()), key=repr)
    # a repeated observation repeats a month in every model built on it
    obs = ctx.observations
    twice = M.Economy(obs.unionByName(obs.where("series_id = 'CPIAUCSL'").limit(1)), keys=ctx.keys, thresholds=ctx.thresholds)
    bad = P.publish(twice, scratch, "run2", "2001-12-02 00:00:00", bounds_off(checks()))
    assert not bad.published and "int_cpi_inflation_rates.period_date_key.unique" in bad.failed
    assert P.published_run(spark, scratch) == "run1"
    after = sorted(map(tuple, P.read_model(spark, scratch, "fct_inflation_analysis").drop("dbt_loaded_at").collect()), key=repr)
    assert after == before
    log = spark.read.parquet(f"{scratch}/quality_checks")
    assert log.count() == 2 * len(bounds_off(checks())) and {r[0] for r in log.select("pipeline_run_id").distinct().collect()} == {"run1", "run2"}
    row = log.where((F.col("pipeline_run_id") == "run2") & (F.col("resource_name") == "int_cpi_inflation_rates.period_date_key")
                    & (F.col("description") == "unique")).first()
    assert row.check_status == "failed" and row.severity == "critical" and json.loads(row.details_json)["economies"] == 1
    assert spark.read.parquet(f"{scratch}/runs/run2/_failures").where("check_name = 'unique'").count() >= 1
    P.drop_runs(spark, scratch, ["run1", "run2"])
    assert P.read_model(spark, scratch, "dim_economic_periods").count() > 0


def test_load_and_publish(spark, scratch):
    obs = driver_economy(spark, SF).observations
    seg = "c_mktsegment"
    one = obs.where(F.col(seg) == "BUILDING").drop(seg)
    docs = (one.groupBy("series_id").agg(F.collect_list(F.struct(F.col("observation_date").cast("string").alias("date"), F.col("value").cast("string").alias("value")))
            .alias("observations")).select("series_id", F.lit(1).cast("long").alias("seq"), F.to_json(F.struct("observations")).alias("payload")))
    odd = spark.createDataFrame([("CPIAUCSL", 1, "[1]"), ("NONE", 1, '{"observations": []}')], docs.schema)
    registry = spark.createDataFrame([("NONE",), ("HOUST",)], "series_id string")
    store = SeriesStore(f"{scratch}/raw", buckets=4)

    def economy(rows):
        return M.Economy(rows.withColumn("ingested_at", F.lit("2001-12-01").cast("timestamp_ntz")), thresholds=driver_economy(spark, SF).thresholds)
    summary, pub = P.load_and_publish(docs.unionByName(odd), store, scratch, "d1", "2001-12-01 00:00:00", economy, registry, bounds_off(checks()))
    assert pub.published, pub.failed
    st = {r.series_id: (r.fetched, r.failed, r.status) for r in summary.collect()}
    assert st["NONE"] == (0, 0, "no_data") and st["CPIAUCSL"][1] == 1 and st["HOUST"][2] == "success"
    assert store.read(spark).count() == one.count()
    _, again = P.load_and_publish(docs, store, scratch, "d2", "2001-12-02 00:00:00", economy, registry, bounds_off(checks()))
    assert again.published and P.published_run(spark, scratch) == "d2" and store.read(spark).count() == one.count()
