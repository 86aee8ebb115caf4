"""Registered queries of the check suite and of the load rules, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..declared import Check, checks
from ..operators import suite
from ..sources.panels import SEGMENT
from . import models as M
from . import twins as TW
from .publish import stamped
from .registry import driver_economy, register
from .twins import K

RUN_AT = "2001-12-01 06:00:00"


def frames(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """All checked models of the driver panel, stamped with the time of the run."""
    ctx = driver_economy(spark, d, materialize=True)
    ctx.cut = M.SHARED
    return {m: stamped(M.MODELS[m](ctx), RUN_AT) for m in suite.grouped(checks())}




# ------------------------------------------------------------------ twins
def _lit(v) -> str:
    return str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"


def _fails(c: Check) -> str:
    if c.kind == "not_null":
        return f"{c.column} IS NULL"
    if c.kind == "accepted_values":
        return f"{c.column} IS NOT NULL AND {c.column} NOT IN ({', '.join(map(_lit, c.params))})"
    return f"{c.column} IS NOT NULL AND NOT ({c.column} BETWEEN {c.params[0]} AND {c.params[1]})"


TYPES = {"numeric": "DECIMAL.*|DOUBLE", "whole": "DECIMAL.*|DOUBLE|INTEGER|BIGINT|HUGEINT", "date": "DATE", "text": "VARCHAR"}


def _source(model: str) -> str:
    return f"(SELECT *, TIMESTAMP '{RUN_AT}' AS dbt_loaded_at FROM ({TW.MODEL_SELECT[model]}))"


def _key(model: str) -> str:
    return "" if model == "dim_economic_periods" else f"{K}, "


def _results(model: str, cs: list[Check]) -> str:
    def count(c: Check) -> str:
        if c.kind == "of_type":
            return f"coalesce(max(CASE WHEN regexp_full_match(typeof({c.column}), '{TYPES[c.params[0]]}') THEN 0 ELSE 1 END), 0)::BIGINT"
        if c.kind == "unique":
            return (f"(SELECT count(*) FROM (SELECT 1 FROM {_source(model)} WHERE {c.column} IS NOT NULL GROUP BY {_key(model)}{c.column} "
                    f"HAVING count(*) > 1))")
        return f"count(*) FILTER (WHERE {_fails(c)})"
    lists = {n: "[" + ", ".join(f"'{getattr(c, a)}'" for c in cs) + "]" for n, a in (("column_name", "column"), ("check_name", "kind"), ("severity", "severity"))}
    return (f"SELECT '{model}' AS model, unnest({lists['column_name']}) AS column_name, unnest({lists['check_name']}) AS check_name, "
            f"unnest({lists['severity']}) AS severity, n AS row_count, unnest(f) AS failures "
            f"FROM (SELECT count(*) AS n, [{', '.join(map(count, cs))}] AS f FROM {_source(model)})")


def _failures(model: str, cs: list[Check]) -> list[str]:
    date = "period_date" if model == "dim_economic_periods" else "period_date_key"
    economy = "'{}'" if model == "dim_economic_periods" else f"'{{\"{K}\":\"' || {K} || '\"}}'"
    # doubles only fail here when null, so the text of a value never depends on an engine's digits
    head = lambda c: f"SELECT '{model}' AS model, '{c.column}' AS column_name, '{c.kind}' AS check_name, '{c.severity}' AS severity, {economy} AS economy, "
    rows = [f"{head(c)}{date} AS period, CAST({c.column} AS VARCHAR) AS found FROM {_source(model)} WHERE {_fails(c)}"
            for c in cs if c.kind not in ("unique", "of_type")]
    return rows + [f"{head(c)}{c.column} AS period, CAST(count(*) AS VARCHAR) AS found FROM {_source(model)} WHERE {c.column} IS NOT NULL "
                   f"GROUP BY {_key(model)}{c.column} HAVING count(*) > 1" for c in cs if c.kind == "unique"]


_by_model = suite.grouped(checks())
_status = "CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status"
register("suite_results", lambda s, d: suite.run_suite(frames(s, d), checks(), [SEGMENT]),
         f"SELECT *, {_status} FROM (" + " UNION ALL ".join(_results(m, cs) for m, cs in _by_model.items()) + ")")
register("suite_failures", lambda s, d: suite.suite_failures(frames(s, d), checks(), [SEGMENT]),
         " UNION ALL ".join(q for m, cs in _by_model.items() for q in _failures(m, cs)))
