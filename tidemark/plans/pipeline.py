"""End-to-end pipeline run: load -> transform -> quality, as Spark jobs.

The reference runs three processes (ingestion, dbt, quality scripts) against
a database.  Here one function runs the same stages on a cluster:

1. the observation panel is built (or read) and cut once;
2. every model is materialised as a parquet table (S12): staging stays a
   view, intermediate and mart models are written, each partitioned so a
   reader of one economy or period prunes files;
3. the post-load checks run as aggregations, their rows are appended to the
   check log (S10), and the failing rows of each column check are stored
   beside it (Q20, ``store_failures``).

Everything written goes under ``out_dir``, which on a cluster is a shared
folder; nothing passes through the driver except the check rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as Q
from . import models as M

STAGING = {"stg_gdp", "stg_cpi", "stg_unemployment_rate", "stg_federal_funds_rate", "stg_consumer_sentiment",
           "stg_housing_starts"}


def write_models(ctx: M.Economy, out_dir: str, names=None) -> dict[str, str]:
    """Write each model as a table (S12); staging models become temp views."""
    paths = {}
    for name in names or M.MODELS:
        df = M.MODELS[name](ctx)
        if name in STAGING:
            df.createOrReplaceTempView(name)
            continue
        path = f"{out_dir.rstrip('/')}/{name}"
        w = df.write.mode("overwrite")
        if ctx.keys and all(k in df.columns for k in ctx.keys):  # the calendar dimension has no economy key
            w = w.partitionBy(*ctx.keys)
        w.parquet(path)
        paths[name] = path
    return paths


def store_failures(failing: dict[str, DataFrame], out_dir: str, run_id: str) -> None:
    """Keep the failing rows of every column check (Q20), one folder per check and run."""
    for check, df in failing.items():
        (df.withColumn("pipeline_run_id", F.lit(run_id)).write.mode("overwrite")
         .parquet(f"{out_dir.rstrip('/')}/failures/{check}/run={run_id}"))


def run_pipeline(spark: SparkSession, ctx: M.Economy, out_dir: str, check_log: DataFrame, run_id: str,
                 column_checks: dict[str, DataFrame] | None = None) -> DataFrame:
    """Materialise the models, append the check rows, store failing rows; return the run summary."""
    from ..sources.observations import write_checks
    ctx.cut = tuple(set(ctx.cut) | set(M.SHARED))  # intermediates with several consumers are kept once built
    ctx.materialize()
    write_models(ctx, out_dir)
    write_checks(check_log, f"{out_dir.rstrip('/')}/quality_checks")
    if column_checks:
        store_failures(column_checks, out_dir, run_id)
    return Q.check_summary(spark.read.parquet(f"{out_dir.rstrip('/')}/quality_checks")
                           .where(F.col("pipeline_run_id") == run_id))
