"""The check suite: declared checks compiled to one aggregation per model, failing rows in one routed scan (Q1-Q7, Q20).

A model is read once for all of its checks.  Its rows are summed up by the
key of its uniqueness check first (map-side, so a repeated key is combined
before the shuffle), and those sums then give the counts of all checks at
once.  Type checks are decided from the schema, without a job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..declared import FAMILIES, Check

RESULT = ("model", "column_name", "check_name", "severity", "row_count", "failures", "status")


def _literal(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(v).lower() if isinstance(v, bool) else repr(v)


def fails(check: Check) -> str:
    """SQL of whether a row fails a check that looks at single rows."""
    c = f"`{check.column}`"
    if check.kind == "not_null":
        return f"{c} IS NULL"
    if check.kind == "accepted_values":
        return f"({c} IS NOT NULL AND {c} NOT IN ({', '.join(map(_literal, check.params))}))"
    if check.kind == "between":
        return f"({c} IS NOT NULL AND ({c} < {_literal(check.params[0])} OR {c} > {_literal(check.params[1])}))"
    raise ValueError(f"{check.name}: no check of single rows")


def of_family(schema: StructType, check: Check) -> bool:
    kind = schema[check.column].dataType.simpleString().split("(")[0]
    return kind in FAMILIES[check.params[0]]


def _status(failures: Column, severity: Column) -> Column:
    return (F.when(failures.isNull(), "missing").when(failures == 0, "pass").when(severity == "warn", "warn").otherwise("fail"))


def check_model(df: DataFrame, checks: Sequence[Check], keys: Sequence[str] = ()) -> DataFrame:
    """One row per check of one model: row_count, failures, status.

    failures: failing rows; of a uniqueness check the repeated (keys, value),
    nulls apart; of a type check 1.  A check of a column that the model lacks
    has null failures and status ``missing``, which counts as failed.
    """
    schema = df.schema
    own = [k for k in keys if k in schema.names]
    here = [c for c in checks if c.column in schema.names]
    by_row = {f"f{i}": c for i, c in enumerate(here) if c.kind not in ("unique", "of_type")}
    unique = [c for c in here if c.kind == "unique"]
    sums = [F.count(F.lit(1)).alias("n"), *[F.expr(f"count_if({fails(c)}) AS {n}") for n, c in by_row.items()]]
    if unique:
        per = df.groupBy(*own, unique[0].column).agg(*sums)
        total = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *[F.expr(f"coalesce(sum({n}), 0) AS {n}") for n in by_row],
                        F.count_if((F.col("n") > 1) & F.col(unique[0].column).isNotNull()).alias("u0"))
    else:
        total = df.agg(*sums)
    found: dict[Check, str] = {c: n for n, c in by_row.items()}
    if unique:
        found[unique[0]] = "u0"
    for i, c in enumerate(unique[1:], 1):  # further keys need an aggregation of their own
        more = df.where(F.col(c.column).isNotNull()).groupBy(*own, c.column).agg(F.count(F.lit(1)).alias("m"))
        total = total.crossJoin(more.agg(F.count_if(F.col("m") > 1).alias(f"u{i}")))  # one row each
        found[c] = f"u{i}"
    for c in here:
        if c.kind == "of_type":
            found[c] = "0" if of_family(schema, c) else "1"
    rows = F.array(*[F.expr(f"named_struct('model', '{c.model}', 'column_name', '{c.column}', 'check_name', '{c.kind}', 'severity', '{c.severity}', "
                            f"'row_count', n, 'failures', CAST({found.get(c, 'NULL')} AS LONG))") for c in checks])
    out = total.select(F.explode(rows).alias("r")).select("r.*")
    return out.withColumn("status", _status(F.col("failures"), F.col("severity"))).select(*RESULT)


def grouped(checks: Iterable[Check]) -> dict[str, list[Check]]:
    out: dict[str, list[Check]] = {}
    for c in checks:
        out.setdefault(c.model, []).append(c)
    return out


def run_suite(frames: Mapping[str, DataFrame], checks: Iterable[Check], keys: Sequence[str] = ()) -> DataFrame:
    """All checks over all models in one job; a row per declared check."""
    return reduce(DataFrame.unionByName, [check_model(frames[m], cs, keys) for m, cs in grouped(checks).items()])


FAILING = ("model", "column_name", "check_name", "severity", "economy", "period", "found")


def failing_rows(df: DataFrame, checks: Sequence[Check], keys: Sequence[str] = (), date: str = "period_date_key") -> DataFrame:
    """The failing rows of one model: one scan, a row per (row, failed check).

    economy: the row's keys as JSON; period: its date; found: the value that
    failed (for a uniqueness check how often it occurs).
    """
    schema = df.schema
    own = [k for k in keys if k in schema.names]
    economy = F.to_json(F.struct(*own)) if own else F.lit("{}")
    period = F.col(date).cast("date") if date in schema.names else F.lit(None).cast("date")
    here = [c for c in checks if c.column in schema.names]
    label = lambda c: f"'model', '{c.model}', 'column_name', '{c.column}', 'check_name', '{c.kind}', 'severity', '{c.severity}'"
    marks = [F.expr(f"CASE WHEN {fails(c)} THEN named_struct({label(c)}, 'found', CAST(`{c.column}` AS STRING)) END")
             for c in here if c.kind not in ("unique", "of_type")]
    parts = []
    if marks:
        parts.append(df.select(economy.alias("economy"), period.alias("period"), F.explode(F.array_compact(F.array(*marks))).alias("m"))
                     .select("m.model", "m.column_name", "m.check_name", "m.severity", "economy", "period", "m.found"))
    for c in here:
        if c.kind == "unique":
            twice = df.where(F.col(c.column).isNotNull()).groupBy(*own, c.column).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            day = F.col(c.column).cast("date") if schema[c.column].dataType.simpleString() in ("date", "timestamp", "timestamp_ntz") else F.lit(None).cast("date")
            parts.append(twice.select(F.expr(f"named_struct({label(c)})").alias("m"), economy.alias("economy"), day.alias("period"),
                                      F.col("n").cast("string").alias("found"))
                         .select("m.model", "m.column_name", "m.check_name", "m.severity", "economy", "period", "found"))
    if not parts:
        return df.sparkSession.createDataFrame([], ", ".join(f"{n} {'date' if n == 'period' else 'string'}" for n in FAILING))
    return reduce(DataFrame.unionByName, parts)


def suite_failures(frames: Mapping[str, DataFrame], checks: Iterable[Check], keys: Sequence[str] = ()) -> DataFrame:
    """Failing rows of all models (Q20)."""
    parts = [failing_rows(frames[m], cs, keys, "period_date_key" if "period_date_key" in frames[m].columns else "period_date")
             for m, cs in grouped(checks).items()]
    return reduce(DataFrame.unionByName, parts)


def failure_details(failing: DataFrame, most: int = 10) -> DataFrame:
    """(model, column_name, check_name, details_json): per check how many economies fail and the ``most`` with the most failing rows."""
    from pyspark.sql import Window
    by = ["model", "column_name", "check_name"]
    per = failing.groupBy(*by, "economy").agg(F.count(F.lit(1)).alias("rows"), F.min("period").alias("first"), F.max("period").alias("last"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("rows"), "economy"))
    top = (per.withColumn("place", place).where(F.col("place") <= most).groupBy(*by)
           .agg(F.sort_array(F.collect_list(F.struct("place", "economy", "rows", "first", "last"))).alias("worst")))
    n = per.groupBy(*by).agg(F.count(F.lit(1)).alias("economies"), F.sum("rows").alias("rows"))
    return top.join(n, by).select(*by, F.to_json(F.struct("economies", "rows", F.transform("worst", lambda w: w.dropFields("place")).alias("worst"))).alias("details_json"))
