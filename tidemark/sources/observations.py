"""Observation load operators (S1-S11): parse payloads, keyed upsert,
high-water marks, incremental and backfill slices, stats, load summary, the
check log sink and the test-run result reader.

All are distributed DataFrame jobs; nothing iterates rows on the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: a payload's observations, each as its own JSON text, so that one odd element does not take the others with it
PAYLOAD_SCHEMA = "observations ARRAY<STRING>"
ELEMENT_SCHEMA = "date STRING, value STRING"
MISSING = "."


def parse_observations(payloads: DataFrame, payload_col: str = "payload", keys: Sequence[str] = ("series_id",),
                       drop_missing: bool = False) -> tuple[DataFrame, DataFrame]:
    """Flatten ``{"observations": [{date, value}]}`` payloads.

    Returns ``(parsed, quarantine)``.  ``"."`` or null value -> null value
    (or the row is dropped with ``drop_missing``).  Whatever does not fit goes
    to the quarantine frame with a reason and its text in ``raw_json``:
    ``bad_payload`` (no JSON object), ``bad_observations`` (the key holds no
    list), ``bad_element`` (an element that is no object, with its place),
    ``bad_date``, ``bad_value``.  The other elements of such a payload are
    parsed all the same.  An object without the key, or a null payload,
    yields no rows.  The source record is kept as it came in ``raw_json``.
    """
    k = [F.col(c) for c in keys]
    names = F.json_object_keys("_text")
    p = payloads.select(*k, F.col(payload_col).alias("_text"), F.from_json(F.col(payload_col), PAYLOAD_SCHEMA)["observations"].alias("_list"))
    rows = p.select(*k, F.posexplode("_list").alias("pos", "_e")).withColumn("_o", F.from_json("_e", ELEMENT_SCHEMA))
    val = F.col("_o.value")
    missing = val.isNull() | (val == MISSING)
    num = F.try_cast(val, "double") if hasattr(F, "try_cast") else F.expr("try_cast(_o.value AS DOUBLE)")
    d = F.try_to_date(F.col("_o.date"), "yyyy-MM-dd")
    # an element with a date is an object; only the others are looked at again
    reason = (F.when(d.isNull() & (F.col("_e").isNull() | F.json_object_keys("_e").isNull()), F.lit("bad_element")).when(d.isNull(), F.lit("bad_date"))
              .when(~missing & num.isNull(), F.lit("bad_value")))
    base = rows.select(*k, "pos", d.alias("observation_date"), F.when(missing, F.lit(None).cast("double")).otherwise(num).alias("value"),
                       F.col("_e").alias("raw_json"), reason.alias("reason"), missing.alias("_missing"))
    parsed = base.where(F.col("reason").isNull())
    if drop_missing:
        parsed = parsed.where(~F.col("_missing"))
    whole = (F.when(names.isNull(), F.lit("bad_payload"))
             .when(F.array_contains(names, "observations"), F.lit("bad_observations")))
    # a payload whose list can be read is one; a broken text may still yield a list
    broken = p.where(F.col("_text").isNotNull() & (F.col("_list").isNull() | names.isNull())).withColumn("reason", whole).where(F.col("reason").isNotNull()).select(
        *k, F.lit(None).cast("int").alias("pos"), F.lit(None).cast("date").alias("observation_date"),
        F.lit(None).cast("double").alias("value"), F.col("_text").alias("raw_json"), "reason")
    return parsed.drop("reason", "_missing"), base.where(F.col("reason").isNotNull()).drop("_missing").unionByName(broken)


def upsert(target: DataFrame | None, updates: DataFrame, keys: Sequence[str], seq: str | Sequence[str]) -> DataFrame:
    """Insert-or-update on ``keys``; the row with the highest ``seq`` wins (S3, ledger #22).

    ``seq`` may name several columns; rows equal in all of them are ordered by
    the whole row, so the result never depends on the order of the input.
    ``max_by(struct(row), seq)`` per key is an aggregate with partial
    aggregation, so duplicates collapse map-side and a key holding a third of
    all rows never lands whole in one task.  Applying the same batch twice
    gives the same result (idempotent).
    """
    src = updates if target is None else target.unionByName(updates, allowMissingColumns=True)
    rest = [c for c in src.columns if c not in keys]
    order = [seq] if isinstance(seq, str) else list(seq)
    row = F.struct(*[F.col(c) for c in rest])
    agg = src.groupBy(*[F.col(k) for k in keys]).agg(
        F.max_by(row, F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], row.alias("_all"))).alias("_r"))
    return agg.select(*[F.col(k) for k in keys], *[F.col(f"_r.{c}").alias(c) for c in rest])


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds anything; any other trouble with the store raises."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p)) and any(not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(p))


def read_partitioned(spark: SparkSession, path: str, partition_col: str, kind: str = "string") -> DataFrame:
    """A table partitioned by ``partition_col``, whose values keep their text: ``007`` is read as ``007``, not as 7."""
    name = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        df = spark.read.parquet(path)
    finally:
        spark.conf.set(name, before)
    return df.withColumn(partition_col, F.col(partition_col).cast(kind)) if kind != "string" else df


def write_upsert(spark: SparkSession, updates: DataFrame, path: str, keys: Sequence[str], seq: str,
                 partition_col: str, most_literals: int = 1000, files: int = 4) -> DataFrame:
    """Upsert into a parquet table partitioned by ``partition_col``, rewriting only touched partitions.

    For few, small partitions; ``store.SeriesStore`` lays a table out by
    (bucket, year) and rewrites only the years a batch touches.  Reads the
    current rows of the touched partitions, merges, and writes with
    dynamic partition overwrite; untouched partitions stay as they are.  Only
    a missing table is a first load: a table that can't be read raises.  Up to
    ``most_literals`` touched values prune the scan as a literal filter, more
    by a semi join.  A partition is written as ``files`` files at most.
    Partition values are read in the updates' type (an empty text is null, as in any folder name).
    """
    from ..session import shared_path
    from .store import remove
    kind = updates.schema[partition_col].dataType.simpleString()
    touched = updates.select(partition_col).distinct()
    current = None
    if table_exists(spark, path):
        current = read_partitioned(spark, path, partition_col, kind)
        some = [r[0] for r in touched.limit(most_literals + 1).collect()]
        if len(some) <= most_literals and None not in some:
            current = current.where(F.col(partition_col).isin(some))
        else:
            current = current.join(touched, current[partition_col].eqNullSafe(touched[partition_col]), "left_semi")
    # the lineage of the merged rows reads ``path``: they are written to the shared folder
    # before the same partitions are overwritten, and that copy is deleted afterwards
    merged = upsert(current, updates, keys, seq)
    staged = shared_path(spark, f"upsert-{uuid.uuid4().hex}")
    merged.write.parquet(staged)
    salt = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(files))
    (spark.read.schema(merged.schema).parquet(staged).repartition(F.col(partition_col), salt).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path))
    remove(spark, staged)
    return read_partitioned(spark, path, partition_col, kind)


OBSERVATION_COLUMNS = ("observation_date", "value", "units", "frequency", "ingested_at")


def write_observations(df: DataFrame, path: str, keys: Sequence[str] = ()) -> None:
    """Store an observation panel as the raw table: parquet partitioned by ``series_id``.

    One directory per series, so reading one series prunes the others
    (``PartitionFilters``), and an upsert rewrites only the series it touches.
    """
    df.select(*keys, "series_id", *OBSERVATION_COLUMNS).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("series_id").parquet(path)


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """Read the stored raw observation table; filters on ``series_id`` prune directories."""
    return read_partitioned(spark, path, "series_id")


def high_water_mark(df: DataFrame, keys: Sequence[str] = ("series_id",), date: str = "observation_date") -> DataFrame:
    """Latest observation date per series (S4); an empty series has no row."""
    return df.groupBy(*[F.col(k) for k in keys]).agg(F.max(date).alias("latest_date"))


def incremental_slice(source: DataFrame, target: DataFrame, as_of: str, keys: Sequence[str] = ("series_id",),
                      lookback_days: int = 90, date: str = "observation_date") -> DataFrame:
    """Source rows from the day after each series' high-water mark up to ``as_of``.

    A series with no high-water mark starts at ``as_of - lookback_days``.
    The marks are one row per series; the join is an equi join sized by the
    planner (a panel may have millions of series).
    """
    hwm = high_water_mark(target, keys, date)
    start = F.coalesce(F.date_add(F.col("latest_date"), 1), F.date_sub(F.lit(as_of).cast("date"), lookback_days))
    j = source.join(hwm, on=list(keys), how="left")
    return j.where((F.col(date) >= start) & (F.col(date) <= F.lit(as_of).cast("date"))).drop("latest_date")


def backfill_slice(source: DataFrame, start: str = "2000-01-01", end: str | None = None,
                   date: str = "observation_date") -> DataFrame:
    """Full-history range filter from ``start`` (S6); pushed down to the scan."""
    cond = F.col(date) >= F.lit(start).cast("date")
    if end:
        cond = cond & (F.col(date) <= F.lit(end).cast("date"))
    return source.where(cond)


def table_stats(df: DataFrame, keys: Sequence[str] = ("series_id",), date: str = "observation_date") -> DataFrame:
    """Row count and latest date per table/series in one aggregate."""
    return df.groupBy(*[F.col(k) for k in keys]).agg(F.count(F.lit(1)).alias("row_count"),
                                                     F.max(date).alias("latest_date"))


def load_summary(parsed: DataFrame, quarantine: DataFrame, keys: Sequence[str] = ("series_id",),
                 registry: DataFrame | None = None) -> DataFrame:
    """fetched / upserted / failed per series and a status.

    ``registry`` holds the keys of all series that should load; those without
    rows are kept with zeros, and series outside it are kept too.

    status: ``no_data`` when nothing was fetched, ``success`` when nothing
    failed, ``failed`` when nothing was upserted, else ``partial``.
    """
    k = [F.col(c) for c in keys]
    ok = parsed.select(*k, F.lit(1).alias("_ok"), F.lit(0).alias("_bad"))
    bad = quarantine.select(*k, F.lit(0).alias("_ok"), F.lit(1).alias("_bad"))
    rows = ok.unionByName(bad)
    if registry is not None:
        rows = rows.unionByName(registry.select(*k, F.lit(0).alias("_ok"), F.lit(0).alias("_bad")))
    s = rows.groupBy(*k).agg(F.sum("_ok").alias("upserted"), F.sum("_bad").alias("failed"))
    s = s.withColumn("fetched", F.col("upserted") + F.col("failed"))
    status = (F.when(F.col("fetched") == 0, "no_data").when(F.col("failed") == 0, "success")
              .when(F.col("upserted") == 0, "failed").otherwise("partial"))
    return s.select(*k, "fetched", "upserted", "failed", status.alias("status"))


def load_totals(summary: DataFrame) -> DataFrame:
    """One row over all series of :func:`load_summary`: series per status and rows fetched, upserted and failed."""
    per = [F.count_if(F.col("status") == st).alias(f"series_{st}") for st in ("success", "partial", "failed", "no_data")]
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("fetched", "upserted", "failed")]
    return summary.agg(F.count(F.lit(1)).alias("series"), *per, *sums)


CHECK_LOG_COLUMNS = ("check_id", "check_timestamp", "pipeline_run_id", "check_type", "resource_name", "check_status",
                     "severity", "metric_value", "threshold_value", "description", "details_json", "dbt_run_id")


def write_checks(checks: DataFrame, path: str, partition_col: str = "check_type") -> None:
    """Append check rows to the check log, partitioned by check type or another column."""
    checks.write.mode("append").partitionBy(partition_col).parquet(path)


RUN_RESULTS_SCHEMA = T.StructType([T.StructField("results", T.ArrayType(T.StructType([
    T.StructField("resource_type", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("name", T.StringType()), T.StructField("unique_id", T.StringType()),
    T.StructField("message", T.StringType())])))])


def read_run_results(spark: SparkSession, path: str) -> DataFrame:
    """Read nested test-run JSON and keep test results."""
    raw = spark.read.schema(RUN_RESULTS_SCHEMA).option("multiLine", "true").json(path)
    return raw.select(F.explode("results").alias("r")).select("r.*").where(F.col("resource_type") == "test")


def run_results_summary(results: DataFrame) -> DataFrame:
    """Failed tests listed, passes counted; critical when any test failed."""
    agg = results.agg(F.count_if(F.col("status") == "fail").alias("failed_tests"),
                      F.count_if(F.col("status") == "pass").alias("passed_tests"))
    status = F.when(F.col("failed_tests") > 0, "failed").otherwise("passed")
    sev = F.when(F.col("failed_tests") > 0, "critical").otherwise("info")
    return agg.select(F.lit("schema").alias("check_type"), F.lit("dbt_tests").alias("resource_name"),
                      status.alias("check_status"), sev.alias("severity"),
                      F.col("failed_tests").cast("double").alias("metric_value"), "failed_tests", "passed_tests")
