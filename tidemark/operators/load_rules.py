"""Run-level rules that start from the registry of series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.observations import load_summary


def load_report(parsed: DataFrame, quarantine: DataFrame, registry: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """A row per registered series, and per series that came unregistered.

    status: ``no_data`` if nothing was fetched, ``success`` if anything was
    upserted, else ``partial``.
    """
    s = load_summary(parsed, quarantine, keys, registry)
    status = F.when(F.col("fetched") == 0, "no_data").when(F.col("upserted") > 0, "success").otherwise("partial")
    return s.withColumn("status", status)


def load_report_totals(report: DataFrame) -> DataFrame:
    """One row over a load report: series per status, rows fetched, upserted and failed."""
    per = [F.count_if(F.col("status") == st).alias(f"series_{st}") for st in ("success", "partial", "no_data")]
    return report.agg(F.count(F.lit(1)).alias("series"), *per,
                      *[F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}") for c in ("fetched", "upserted", "failed")])


def freshness(df: DataFrame, expected: DataFrame, as_of: str, keys: Sequence[str] = ("series_id",), loaded_at: str = "ingested_at") -> DataFrame:
    """Age of the newest load per expected series (Q10); one without any row is an error.

    ``expected``: the keys of all configured series with warn_days and error_days.
    """
    latest = df.groupBy(*keys).agg(F.max(loaded_at).alias("max_loaded_at"))
    j = expected.join(latest, list(keys), "left")
    age = F.datediff(F.lit(as_of).cast("date"), F.col("max_loaded_at").cast("date"))
    status = (F.when(F.col("max_loaded_at").isNull() | (age > F.col("error_days")), "error").when(age > F.col("warn_days"), "warn").otherwise("pass"))
    return j.select(*keys, "max_loaded_at", age.alias("age_days"), "warn_days", "error_days", status.alias("freshness_status"))


def row_count_snapshot(df: DataFrame, key: str = "series_id") -> DataFrame:
    """Rows per table and, in a row named ``total``, of all of them (Q13): one pass."""
    g = df.groupBy(F.col(key)).agg(F.count(F.lit(1)).alias("row_count"))
    return g.rollup(key).agg(F.sum("row_count").alias("row_count"), F.grouping(key).alias("_all")).select(
        F.when(F.col("_all") == 1, "total").otherwise(F.col(key)).alias("table_name"), F.coalesce("row_count", F.lit(0)).alias("row_count"))


def growth_verdict(growth: DataFrame, name: str) -> DataFrame:
    """One check row over row growth per table (Q14): only gains add up; a warning if there are none.

    ``growth``: rows of ``row_count_growth``; ``name``: its table column.
    """
    gain = F.sum(F.when(F.col("new_rows") > 0, F.col("new_rows")).otherwise(F.lit(0)))
    idle = F.sort_array(F.collect_list(F.when(F.col("new_rows") <= 0, F.col(name).cast("string"))))  # a name per table
    t = growth.agg(F.coalesce(gain, F.lit(0)).alias("total_new_rows"), idle.alias("idle"))
    status = F.when(F.col("total_new_rows") == 0, "warning").otherwise("passed")
    return t.select(F.lit("row_count").alias("check_type"), F.lit("raw_tables").alias("resource_name"), status.alias("check_status"),
                    F.when(F.col("total_new_rows") == 0, "warning").otherwise("info").alias("severity"), "total_new_rows",
                    F.array_join("idle", ",").alias("tables_with_no_growth"))
