"""Quality operators on hand-made frames: edge cases the driver data does not reach."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import quality as Q


def test_outlier_zero_sigma_never_flags(spark):
    df = spark.createDataFrame([(i, 5.0) for i in range(10)], "id int, v double")
    assert Q.outlier(df, "v", 0.0).count() == 0
    df2 = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 1, 1, 1, 1, 1, 1, 1, 1, 100])], "id int, v double")
    assert [r.id for r in Q.outlier(df2, "v", 2.5).collect()] == [9]


def test_staleness_reports_no_data(spark):
    obs = spark.createDataFrame([("A", dt.date(2024, 1, 1)), ("A", dt.date(2024, 1, 20))], "series_id string, observation_date date")
    expected = spark.createDataFrame([("A", 15), ("B", 45)], "series_id string, window_days int")
    got = {r.series_id: (r.status, r.days_old) for r in Q.staleness(obs, expected, "2024-02-10").collect()}
    assert got == {"A": ("stale", 21), "B": ("no_data", None)}


def test_source_freshness_levels(spark):
    obs = spark.createDataFrame([("A", dt.datetime(2024, 1, 1, 12)), ("B", dt.datetime(2024, 1, 25)),
                                 ("C", dt.datetime(2024, 1, 31))], "series_id string, ingested_at timestamp_ntz")
    th = spark.createDataFrame([(s, 5, 20) for s in "ABC"], "series_id string, warn_days int, error_days int")
    got = {r.series_id: r.freshness_status for r in Q.source_freshness(obs, th, "2024-02-01").collect()}
    assert got == {"A": "error", "B": "warn", "C": "pass"}


def test_row_growth_full_join(spark):
    before = spark.createDataFrame([("a", 5), ("b", 3)], "series_id string, row_count long")
    after = spark.createDataFrame([("a", 7), ("c", 1)], "series_id string, row_count long")
    got = {r.series_id: (r.new_rows, r.status) for r in Q.row_count_growth(before, after).collect()}
    assert got == {"a": (2, "growth"), "b": (-3, "no_growth"), "c": (1, "growth")}
    drop = {r.series_id for r in Q.row_drop(before, after).collect()}
    assert drop == {"b"}


def test_digest_only_when_failed(spark):
    rows = [("r1", "anomaly", "s", "warning", "warning", "d1"), ("r1", "schema", "t", "passed", "info", "d2"),
            ("r2", "schema", "t", "failed", "critical", "d3"), ("r2", "row_count", "raw", "warning", "warning", "d4")]
    checks = spark.createDataFrame(rows, "pipeline_run_id string, check_type string, resource_name string, "
                                         "check_status string, severity string, description string")
    d = {r.pipeline_run_id: r for r in Q.failure_digest(checks).collect()}
    assert set(d) == {"r2"} and d["r2"].failed == 1 and d["r2"].digest.count("\n") == 1
    daily = {r.pipeline_run_id: r.color for r in Q.daily_digest(checks).collect()}
    assert daily == {"r1": "warning", "r2": "danger"}
    assert Q.critical_failures(checks).count() == 1


def test_null_counts_and_completeness_one_pass(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (3, "y"), (4, None)], "a int, b string")
    nc = {r.column_name: (r.row_count, r.null_count) for r in Q.null_counts(df).collect()}
    assert nc == {"a": (4, 1), "b": (4, 2)}
    comp = {r.column_name: (r.completeness_pct, r.check_status) for r in Q.completeness(df, ["a", "b"], 90.0).collect()}
    assert comp == {"a": (75.0, "warning"), "b": (50.0, "warning")}


def test_baselines_quantiles_are_order_statistics(spark):
    rows = [("s", dt.date(2024, 1, d), float(v)) for d, v in zip(range(1, 9), [1, 2, 3, 4, 5, 6, 7, 8])]
    df = spark.createDataFrame(rows, "series_id string, observation_date date, value double")
    b = Q.baselines(df, "value", "2024-01-31", 60).collect()[0]
    assert (b.row_count, b.min_value, b.max_value, b.p25, b.p75, b.null_pct) == (8, 1.0, 8.0, 2.0, 6.0, 0.0)


def test_baselines_quantiles_are_exact_past_any_sketch(spark):
    """300,000 distinct values of one series: the lower order statistics, and a group whose key is null."""
    df = spark.range(300_000).selectExpr("'s' as series_id", "date'2024-01-10' as observation_date",
                                         "cast(pow((id * 7919) % 300000, 1.5) as double) as value")
    df = df.unionByName(spark.sql("select cast(null as string) series_id, date'2024-01-10' observation_date, cast(3 as double) value"))
    got = {r.series_id: (r.p25, r.p75) for r in Q.baselines(df, "value", "2024-01-31", 60).collect()}
    assert got[None] == (3.0, 3.0)
    assert [round(x ** (2 / 3)) for x in got["s"]] == [74_999, 224_999]


def test_check_log_monitor_keeps_ten_failures(spark):
    rows = [(f"t{i:02}", "r", "failed", dt.datetime(2024, 1, 1), str(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "check_type string, resource_name string, check_status string, check_timestamp timestamp, check_id string")
    assert [r.check_type for r in Q.check_log_monitor(df)[2].collect()] == [f"t{i:02}" for i in range(10)]


def test_load_summary_keeps_series_without_rows(spark):
    from tidemark.sources import observations as O
    frame = lambda ids: spark.createDataFrame([(i,) for i in ids], "series_id string")
    s = O.load_summary(frame(["a", "a", "b"]), frame(["b", "c"]), registry=frame(["a", "b", "c", "d"]))
    assert {r.series_id: (r.fetched, r.upserted, r.failed, r.status) for r in s.collect()} == {
        "a": (2, 2, 0, "success"), "b": (2, 1, 1, "partial"), "c": (1, 0, 1, "failed"), "d": (0, 0, 0, "no_data")}
    t = O.load_totals(s).collect()[0]
    assert (t.series, t.series_no_data, t.fetched, t.upserted, t.failed) == (4, 1, 5, 3, 2)


def test_pairwise_correlations_hold_gdp():
    from tidemark.config import SERIES
    from tidemark.plans import quality_queries as QQ
    assert set(QQ.ALL_SERIES) == {s.series_id for s in SERIES}
