"""Rule tables with hand-computed cases, including all-null inputs (falls to ELSE)."""

from pyspark.sql import functions as F

from tidemark.config import REFERENCE_THRESHOLDS as T
from tidemark.plans import models as M


def one(spark, schema, row, col):
    return spark.createDataFrame([row], schema).select(col.alias("v")).collect()[0].v


def test_severity(spark):
    sev = lambda x: one(spark, "y double", (x,), M.inflation_severity("y", T))
    assert [sev(2.5), sev(2.51), sev(4.0), sev(5.0), sev(5.01), sev(None)] == \
        ["Mild", "Moderate", "Moderate", "High", "Severe", "Severe"]


RISK_SCHEMA = ("consecutive_negative_quarters long, is_qoq_negative_growth boolean, unemployment_yoy_change_pct double, "
               "yoy_growth_pct double, sentiment_outlook string, unemployment_rate_pct double, "
               "inflation_severity_category string")


def test_risk_level(spark):
    r = lambda *row: one(spark, RISK_SCHEMA, row, M.recession_risk(T))
    assert r(2, False, None, None, None, None, None) == "High"
    assert r(1, True, 0.6, None, None, None, None) == "High"
    assert r(1, True, 0.4, 3.0, "Pessimistic", None, None) == "Moderate"
    assert r(0, False, 0.1, 2.2, "Optimistic", None, None) == "Emerging"
    assert r(0, False, None, None, None, None, None) == "Low"


def test_intensity_max_is_14(spark):
    s = one(spark, RISK_SCHEMA, (0, True, 2.0, -1.0, "Pessimistic", 6.0, "Severe"), M.recession_intensity(T))
    assert float(s) == 14.0
    assert float(one(spark, RISK_SCHEMA, (0, None, None, None, None, None, None), M.recession_intensity(T))) == 0.0


def test_labor_score_and_stance(spark):
    schema = "unemployment_rate_pct double, unemployment_trend string, unemployment_yoy_change_pct double, housing_starts_thousands double"
    assert one(spark, schema, (3.5, "Declining", -0.1, 1600.0), M.labor_health_score(T)) == 9
    assert one(spark, schema, (4.0, "Flat", 0.2, 1300.0), M.labor_health_score(T)) == 5
    assert one(spark, schema, (None, None, None, None), M.labor_health_score(T)) == 0
    st = "fedfunds_direction string, yoy_inflation_rate_pct double"
    assert one(spark, st, ("Rising", 3.5), M.fed_stance(T)) == "Tightening Response"
    assert one(spark, st, ("Falling", 3.5), M.fed_stance(T)) == "Accommodative Despite Inflation"
    assert one(spark, st, ("Rising", 1.5), M.fed_stance(T)) == "Restrictive"
    assert one(spark, st, ("Flat", 9.0), M.fed_stance(T)) == "Neutral"
    assert one(spark, st, (None, None), M.fed_stance(T)) == "Accommodative"


def test_reference_recession_case(spark):
    df = spark.createDataFrame([(2001, 1), (2008, 5), (2007, 12), (2009, 6), (2020, 11), (2019, 3)], "year int, month int")
    flag, name = M.reference_recession_case("year", "month")
    got = [(r.year, r.month, r.f, r.n) for r in df.select("year", "month", flag.alias("f"), name.alias("n")).collect()]
    assert got == [(2001, 1, True, "2001 Recession"), (2008, 5, False, None),
                   (2007, 12, True, "2007-2009 Financial Crisis"), (2009, 6, True, "2007-2009 Financial Crisis"),
                   (2020, 11, True, "2020 COVID Recession"), (2019, 3, False, None)]


def test_interval_tag_months(spark):
    from tidemark.operators import align as A
    import datetime as dt
    periods = spark.createDataFrame([(dt.date(y, m, 1),) for y in range(1995, 2011) for m in range(1, 13)],
                                    "period_date date")
    tagged = A.interval_tag(periods, M.recession_intervals(spark), "period_date", label="recession_name")
    n = {r.recession_name: r.c for r in tagged.groupBy("recession_name").agg(F.count("*").alias("c")).collect()}
    assert n["2001 Recession"] == 9 and n["2007-2009 Financial Crisis"] == 19
    assert tagged.count() == 16 * 12
