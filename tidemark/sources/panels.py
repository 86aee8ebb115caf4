"""Observation panels derived from the driver tables (FIXTURES §4).

The reference pulls six indicator series per economy; here an "economy" is a
market segment and each indicator is a distributed aggregate of the order and
line-item tables.  The result has the raw-table schema in long form:

    <panel keys>, series_id, observation_date, value, units, frequency, ingested_at

Sums run in DECIMAL (exact, order-independent) and are divided once at the
end, so the values are the same whatever the partitioning.  The builders only
shape input rows; every indicator operator runs afterwards on any panel of
this schema.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SERIES_BY_ID
from ..functions.calendar import month_start, quarter_start
from .tables import read_table

SEGMENT = "c_mktsegment"


def order_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders ⋈ customer -> (o_orderkey, segment, order columns).

    ``customer`` grows with the scale factor, so no broadcast hint: AQE turns
    the join into a broadcast only when the runtime size is under the
    threshold, and keeps the sort-merge join otherwise.
    """
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                   "o_orderdate")
    c = read_table(spark, sf_dir, "customer", "c_custkey", SEGMENT)
    return o.join(c, o.o_custkey == c.c_custkey, "inner").drop("c_custkey", "o_custkey")


def order_month_facts(spark: SparkSession, sf_dir: str, segments: DataFrame | None = None) -> DataFrame:
    """Per (segment, order month): order count, exact price sum, count of status F, last order time."""
    j = segments if segments is not None else order_segments(spark, sf_dir)
    return j.groupBy(F.col(SEGMENT), month_start("o_orderdate").alias("m")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("sum_price"),
        F.count_if(F.col("o_orderstatus") == "F").alias("n_f"),
        F.max(F.col("o_orderdate").cast("timestamp_ntz")).alias("last_ts"))


def line_month_facts(spark: SparkSession, sf_dir: str, segments: DataFrame | None = None) -> DataFrame:
    """Per (segment, ship month): line count, exact discount sum, sum of unit prices, last ship time.

    lineitem ⋈ (orders ⋈ customer) is the one large-large join; it is a
    shuffle join on the order key (AQE splits a skewed order key), and the
    aggregate after it is partial+final so only (segment, month) partials move.
    """
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_discount", "l_extendedprice", "l_quantity",
                    "l_shipdate")
    seg = (segments if segments is not None else order_segments(spark, sf_dir)).select("o_orderkey", SEGMENT)
    j = li.join(seg, li.l_orderkey == seg.o_orderkey, "inner")
    return j.groupBy(F.col(SEGMENT), month_start("l_shipdate").alias("m")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.col("l_discount").cast("decimal(12,2)")).alias("sum_disc"),
        # summed as decimals: the order of the rows can't change the sum
        F.sum(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).cast("decimal(26,12)")).cast("double").alias("sum_unit"),
        F.max(F.col("l_shipdate").cast("timestamp_ntz")).alias("last_ts"))


def _obs(df: DataFrame, keys: list[str], series_id: str, date, value) -> DataFrame:
    spec = SERIES_BY_ID[series_id]
    return df.select(*[F.col(k) for k in keys],
                     F.lit(series_id).alias("series_id"),
                     date.cast("date").alias("observation_date"),
                     value.cast("double").alias("value"),
                     F.lit(spec.units).alias("units"),
                     F.lit(spec.frequency).alias("frequency"),
                     F.col("last_ts").alias("ingested_at"))


def segment_observations(spark: SparkSession, sf_dir: str, share: bool = True) -> DataFrame:
    """Six indicator series per market segment, long form.

    housing = orders per month; sentiment = mean order price / 2500;
    unemployment = % of orders with status F; GDP = quarterly price sum / 1e6;
    fed funds = 100 × mean discount; CPI = mean unit price / 10.
    Each branch carries its ``series_id`` as a literal, so a filter on one
    series prunes the other branches at planning time.  With ``share`` the two
    month aggregates, which several branches read, are persisted, so their
    scans and joins run once when the whole panel is built.
    """
    keys = [SEGMENT]
    # Only frames of (segment, month) grain are ever held, a few rows a month
    # whatever the input; rows of orders are not.  orders ⋈ customer runs once for
    # the order facts and once, with two columns, for the segment of each line
    # item's order.  Persisted blocks lost with an executor are recomputed.
    # ``share=False`` is for a query that reads one branch only (nothing re-read).
    def keep(df):
        return df.persist(StorageLevel.MEMORY_AND_DISK) if share else df
    om = keep(order_month_facts(spark, sf_dir))
    lm = keep(line_month_facts(spark, sf_dir))
    gq = om.groupBy(F.col(SEGMENT), quarter_start("m").alias("m")).agg(
        F.sum("sum_price").alias("sum_price"), F.max("last_ts").alias("last_ts"))
    parts = [
        _obs(om, keys, "HOUST", F.col("m"), F.col("n_orders").cast("double")),
        _obs(om, keys, "UMCSENT", F.col("m"), F.col("sum_price").cast("double") / F.col("n_orders") / F.lit(2500.0)),
        _obs(om, keys, "UNRATE", F.col("m"), (F.col("n_f") * 100).cast("double") / F.col("n_orders")),
        _obs(gq, keys, "GDPC1", F.col("m"), F.col("sum_price").cast("double") / F.lit(1000000.0)),
        _obs(lm, keys, "FEDFUNDS", F.col("m"), (F.col("sum_disc") * 100).cast("double") / F.col("n_lines")),
        _obs(lm, keys, "CPIAUCSL", F.col("m"), F.col("sum_unit") / F.col("n_lines") / F.lit(10.0)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# Other panels of the same long schema
# ---------------------------------------------------------------------------

def event_day_panel(spark: SparkSession, sf_dir: str, keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """Daily panel: events by (keys, day); value = exact sum of event values."""
    e = read_table(spark, sf_dir, "events", "ts", "value", *keys)
    return e.groupBy(*[F.col(k) for k in keys], F.col("ts").cast("date").alias("observation_date")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value"),
        F.count(F.lit(1)).alias("n_events"),
        F.max(F.col("ts").cast("timestamp_ntz")).alias("ingested_at"))


def part_month_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many-series panel: line items by (part, ship month); exact quantity and revenue sums."""
    li = read_table(spark, sf_dir, "lineitem", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    return li.groupBy(F.col("l_partkey"), month_start("l_shipdate").alias("period_date_key")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("qty"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revenue"),
        F.count(F.lit(1)).alias("n_lines"))


def part_quarter_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by (part, ship quarter); exact quantity sum."""
    li = read_table(spark, sf_dir, "lineitem", "l_partkey", "l_quantity", "l_shipdate")
    return li.groupBy(F.col("l_partkey"), quarter_start("l_shipdate").alias("period_date_key")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("qty"))


def user_day_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many-series panel: events by (user, event type, day)."""
    return event_day_panel(spark, sf_dir, keys=("user_id", "event_type"))
