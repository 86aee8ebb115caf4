"""Every registered query against its DuckDB twin (row count, columns, values) on the smoke data."""

import pytest

import __spark_entry__ as E
from twin_check import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(E.registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_twin():
    assert set(E.registry.ORACLE) == set(E.registry.QUERIES)
    assert set(E.registry.QUERIES) <= set(E.queries()) and set(E.registry.ORACLE) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "period_date_key" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_twin(spark, con, name):
    msg, ok = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert ok, msg


def test_results_do_not_depend_on_session_time_zone(spark, con):
    """Timestamps stay zone-less (timestamp_ntz): a non-UTC session gives the same results."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for n in ("scan_raw", "check_log", "upsert_latest_wins", "chk_source_freshness"):
            msg, ok = compare(spark, con, n, E.queries()[n], E.oracle_sql()[n], SF)
            assert ok, msg
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
