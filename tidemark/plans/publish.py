"""Write, audit, publish: models become visible only when their checks pass.

A run writes its models to a folder of its own, the suite then reads the
written tables, results and failing rows are kept beside them, and one small
pointer file, replaced in a single step, names the run that readers see.  If
a check of severity ``error`` fails, the pointer stays as it is: readers keep
the last good run, and the rejected one can be looked into.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..declared import Check, checks as declared_checks
from ..operators import suite
from ..sources.observations import load_summary, parse_observations, table_exists, upsert, write_checks
from ..sources.store import SeriesStore, remove
from . import models as M
from .pipeline import STAGING

POINTER = "PUBLISHED"
#: what the models that build on a model know it by
MEMO = {"int_gdp_with_yoy_change": "int_gdp", "int_cpi_inflation_rates": "int_cpi", "int_labor_market_metrics": "int_labor",
        "int_financial_conditions": "int_fin", "int_economic_rolling_averages": "int_rolling", "int_recession_indicators": "int_recession",
        "int_indicator_cross_correlations": "int_corr", "dim_economic_periods": "dim:reference",
        "fct_economic_indicators_monthly": "fct_monthly", "fct_economic_indicators_quarterly": "fct_quarterly",
        "fct_recession_analysis": "fct_recession", "fct_inflation_analysis": "fct_inflation", "fct_employment_analysis": "fct_employment"}


@dataclass(frozen=True)
class Publication:
    """What a run came to: ``failed`` names the checks that keep it from being published."""
    run_id: str
    published: bool
    failed: tuple[str, ...]
    warned: tuple[str, ...]


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def published_run(spark: SparkSession, out_dir: str) -> str | None:
    """The run that readers see."""
    p, fs = _fs(spark, f"{out_dir.rstrip('/')}/{POINTER}")
    if not fs.exists(p):
        return None
    return spark.read.text(f"{out_dir.rstrip('/')}/{POINTER}").first()[0]


def point_to(spark: SparkSession, out_dir: str, run_id: str) -> None:
    """Replace the pointer in one step: readers see the old run or the new one, never a mixture."""
    p, fs = _fs(spark, f"{out_dir.rstrip('/')}/{POINTER}")
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out_dir.rstrip('/')}/{POINTER}.{run_id}")
    out = fs.create(new, True)
    out.write(bytearray(run_id, "utf-8"))
    out.close()
    jvm = spark.sparkContext._jvm
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(p).toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(new), fs.makeQualified(p), over)


def read_model(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """A model of the published run."""
    run = published_run(spark, out_dir)
    if run is None:
        raise LookupError(f"nothing is published under {out_dir}")
    return spark.read.parquet(f"{out_dir.rstrip('/')}/runs/{run}/{name}")


def stamped(df: DataFrame, run_at: str) -> DataFrame:
    return df.withColumn("dbt_loaded_at", F.lit(run_at).cast("timestamp_ntz"))


def write_run(ctx: M.Economy, folder: str, run_at: str) -> dict[str, DataFrame]:
    """Write the models of a run and read them back; staging stays a view.

    Models stand in order, and each one reads the written tables of those it
    builds on (S12), so nothing is computed twice and nothing is held.
    """
    spark = ctx.observations.sparkSession
    run = replace(ctx, cut=(), _memo={})
    out = {}
    for name, build in M.MODELS.items():
        df = stamped(build(run), run_at)
        if name not in STAGING:
            df.write.mode("overwrite").parquet(f"{folder}/{name}")
            df = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
            if name in MEMO:
                run._memo[MEMO[name]] = df.drop("dbt_loaded_at")
        out[name] = df
    return out


def log_rows(results: DataFrame, details: DataFrame, run_id: str, run_at: str) -> DataFrame:
    """Suite results shaped like the check log, with the economies concerned in ``details_json``."""
    by = ["model", "column_name", "check_name"]
    bad = F.when(F.col("severity") == "warn", F.lit("warning")).otherwise(F.lit("critical"))
    return results.join(details, by, "left").select(
        F.sha2(F.concat_ws("|", F.lit(run_id), *by), 256).alias("check_id"), F.lit(run_at).cast("timestamp_ntz").alias("check_timestamp"),
        F.lit(run_id).alias("pipeline_run_id"), F.lit("schema").alias("check_type"), F.concat_ws(".", "model", "column_name").alias("resource_name"),
        F.when(F.col("status") == "pass", "passed").when(F.col("status") == "warn", "warning").otherwise("failed").alias("check_status"),
        F.when(F.col("status") == "pass", F.lit("info")).otherwise(bad).alias("severity"),
        F.col("failures").cast("double").alias("metric_value"), F.lit(0.0).alias("threshold_value"), F.col("check_name").alias("description"),
        "details_json", F.lit(run_id).alias("dbt_run_id"))


def publish(ctx: M.Economy, out_dir: str, run_id: str, run_at: str, checks: Sequence[Check] | None = None) -> Publication:
    """Write a run, audit what was written, and publish it if no check of severity ``error`` fails."""
    out_dir, spark = out_dir.rstrip("/"), ctx.observations.sparkSession
    checks = list(declared_checks() if checks is None else checks)
    folder = f"{out_dir}/runs/{run_id}"
    frames = write_run(ctx, folder, run_at)
    suite.run_suite(frames, checks, ctx.K).write.mode("overwrite").parquet(f"{folder}/_suite")
    results = spark.read.parquet(f"{folder}/_suite")
    suite.suite_failures(frames, checks, ctx.K).write.mode("overwrite").partitionBy("model", "check_name").parquet(f"{folder}/_failures")
    failing = spark.read.schema(f"{', '.join(f'{n} string' if n != 'period' else 'period date' for n in suite.FAILING)}").parquet(f"{folder}/_failures")
    write_checks(log_rows(results, suite.failure_details(failing), run_id, run_at).withColumn("run_date", F.to_date(F.lit(run_at))),
                 f"{out_dir}/quality_checks", "run_date")
    named = F.concat_ws(".", "model", "column_name", "check_name").alias("name")
    bad = results.where(F.col("status") != "pass").select(named, "status").orderBy("name").collect()  # one row per declared check at most
    failed = tuple(r.name for r in bad if r.status != "warn")
    if not failed:
        point_to(spark, out_dir, run_id)
    return Publication(run_id, not failed, failed, tuple(r.name for r in bad if r.status == "warn"))


def drop_runs(spark: SparkSession, out_dir: str, run_ids: Sequence[str]) -> None:
    """Delete run folders; the published one stays."""
    now = published_run(spark, out_dir)
    for r in run_ids:
        if r != now:
            remove(spark, f"{out_dir.rstrip('/')}/runs/{r}")


def load_and_publish(payloads: DataFrame, store: SeriesStore, out_dir: str, run_id: str, run_at: str, economy, registry: DataFrame | None = None,
                     checks: Sequence[Check] | None = None) -> tuple[DataFrame, Publication]:
    """The daily run: payloads are parsed and upserted into the stored table, models are built from it, audited and published.

    ``payloads``: series columns, the store's ``seq`` column and ``payload``.
    ``economy`` turns the stored table into the panel of the models.  Returns
    the load summary (kept under the run) and the publication.
    """
    spark = payloads.sparkSession
    folder = f"{out_dir.rstrip('/')}/runs/{run_id}"
    parsed, rejected = parse_observations(payloads, "payload", (*store.series, store.seq))
    rejected.write.mode("overwrite").parquet(f"{folder}/_rejected")
    load_summary(parsed, rejected, store.series, registry).write.mode("overwrite").parquet(f"{folder}/_load")
    rows = upsert(None, parsed, store.keys, (store.seq, "pos")).drop("pos")
    if table_exists(spark, store.path) or not rows.isEmpty():
        store.upsert(rows)
    return spark.read.parquet(f"{folder}/_load"), publish(economy(store.read(spark)), out_dir, run_id, run_at, checks)
