"""Reporting queries (R1-R11) over the marts, per economy (panel key).

The dashboard's Python branching becomes column expressions: lists of
positives / concerns / signals are ``array_compact(array(when ...))``, the
verdict texts a literal map lookup, so the reports run for any number of
economies without a driver loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import VERDICT_UNKNOWN, VERDICTS
from . import models as M
from ..operators import align as A

D = "period_date_key"
HISTORY_FROM = "1999-12-31"


def overview(ctx: M.Economy) -> DataFrame:
    """The overview row per economy."""
    return M.vw_economic_overview_dashboard(ctx)


def inflation_history(ctx: M.Economy, after: str = HISTORY_FROM) -> DataFrame:
    """R2: seven inflation columns after a date, ascending (P11 pushed below the windows it does not touch)."""
    return M.fct_inflation_analysis(ctx).where(F.col(D) > F.lit(after).cast("date")).select(
        *ctx.K, D, "year_month", "yoy_inflation_rate_pct", "mom_inflation_change_pct",
        "inflation_severity_category", "fedfunds_rate_pct", "fed_policy_stance_to_inflation").orderBy(*ctx.K, D)


def recession_history(ctx: M.Economy, after: str = HISTORY_FROM) -> DataFrame:
    """Nine recession columns after a date, ascending."""
    return M.fct_recession_analysis(ctx).where(F.col(D) > F.lit(after).cast("date")).select(
        *ctx.K, D, "year_quarter", "gdp_billions_usd", "qoq_growth_pct", "unemployment_rate_pct",
        "yoy_inflation_rate_pct", "recession_risk_level", "recession_intensity_score",
        "consecutive_negative_quarters").orderBy(*ctx.K, D)


def employment_history(ctx: M.Economy, after: str = HISTORY_FROM) -> DataFrame:
    """Eight employment columns after a date, ascending."""
    return M.fct_employment_analysis(ctx).where(F.col(D) > F.lit(after).cast("date")).select(
        *ctx.K, D, "year_month", "unemployment_rate_pct", "unemployment_yoy_change_pct", "unemployment_trend",
        "housing_starts_thousands", "labor_market_health_score", "labor_market_condition").orderBy(*ctx.K, D)


def latest_qoq(ctx: M.Economy) -> DataFrame:
    """Overview QoQ, falling back to the newest non-null QoQ of the recession table (T5)."""
    ov = overview(ctx).select(*ctx.K, F.col("qoq_growth_pct").alias("overview_qoq"))
    last = A.last_non_null(M.fct_recession_analysis(ctx), "qoq_growth_pct", ctx.K, D, out="last_qoq")
    j = ov.join(last, on=ctx.K, how="left") if ctx.K else ov.crossJoin(F.broadcast(last))
    return j.select(*ctx.K, "overview_qoq", "last_qoq",
                    F.coalesce("overview_qoq", "last_qoq").alias("gdp_qoq_growth_pct"))


def fmt1(x) -> Column:
    """One-decimal text of a number (half-up on its decimal form)."""
    c = x if isinstance(x, Column) else F.col(x)
    return F.round(c.cast("decimal(38,10)"), 1).cast("decimal(18,1)").cast("string")


def economy_snapshot(ctx: M.Economy) -> DataFrame:
    """R6 + R7: positives / concerns / signals by threshold rules, verdict and action by risk level."""
    t = ctx.thresholds
    ov = overview(ctx)
    q = latest_qoq(ctx).select(*ctx.K, "gdp_qoq_growth_pct")
    j = ov.join(q, on=ctx.K, how="left") if ctx.K else ov.crossJoin(q)
    g = F.coalesce(F.col("gdp_qoq_growth_pct"), F.lit(0.0))
    u = F.coalesce(F.col("unemployment_rate_pct").cast("double"), F.lit(0.0))
    uc = F.coalesce(F.col("unemployment_yoy_change_pct"), F.lit(0.0))
    inf = F.coalesce(F.col("yoy_inflation_rate_pct"), F.lit(0.0))
    fed = F.coalesce(F.col("fedfunds_rate_pct").cast("double"), F.lit(0.0))
    fd = F.coalesce(F.col("fedfunds_direction"), F.lit(""))

    def txt(*parts):
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    positives = F.array_compact(F.array(
        F.when(g > t.snap_gdp_growing, txt("GDP is growing (+", fmt1(g), "% QoQ)")),
        F.when((u < t.snap_unemp_low) & (uc < t.snap_unemp_yoy_low), txt("unemployment near historical lows (", fmt1(u), "%)")),
        F.when(~((u < t.snap_unemp_low) & (uc < t.snap_unemp_yoy_low)) & (uc <= 0),
               txt("unemployment stable at ", fmt1(u), "%")),
        F.when(inf <= t.inflation_mild, txt("inflation near the Fed's 2% target (", fmt1(inf), "% YoY)"))))
    concerns = F.array_compact(F.array(
        F.when(g <= 0, txt("GDP contracted this quarter (", fmt1(g), "% QoQ)")),
        F.when(~((u < t.snap_unemp_low) & (uc < t.snap_unemp_yoy_low)) & (uc > t.snap_unemp_yoy_fast),
               txt("unemployment rising fast (+", fmt1(uc), "% YoY) — a classic early-recession signal")),
        F.when(inf > t.inflation_moderate, txt("inflation running hot at ", fmt1(inf), "% — above the 2% target")),
        F.when(fd == "Rising", txt("Fed raising rates (", fmt1(fed), "%) — tightening credit conditions"))))
    signals = F.array_compact(F.array(
        F.when((g > 0) & (g <= t.snap_gdp_growing), txt("GDP growth is modest but positive (+", fmt1(g), "% QoQ)")),
        F.when(~((u < t.snap_unemp_low) & (uc < t.snap_unemp_yoy_low)) & (uc <= t.snap_unemp_yoy_fast) & (uc > 0),
               txt("unemployment ticking up (", fmt1(u), "%, +", fmt1(uc), "% YoY) — worth watching")),
        F.when((inf > t.inflation_mild) & (inf <= t.inflation_moderate),
               txt("inflation is moderating but still elevated (", fmt1(inf), "% YoY)")),
        F.when(fd == "Falling", txt("Fed cutting rates (", fmt1(fed), "%) — easing financial conditions")),
        F.when((fd != "Falling") & (fd != "Rising"), txt("Fed holding rates steady at ", fmt1(fed), "%"))))
    risk = F.coalesce(F.col("recession_risk_level"), F.lit("Unknown"))
    lookup = {i: F.create_map(*[x for v in VERDICTS for x in (F.lit(v[0]), F.lit(v[i]))]) for i in (1, 2, 3)}
    return j.select(*ctx.K, risk.alias("recession_risk_level"),
                    F.array_join(positives, " | ").alias("positives"),
                    F.array_join(concerns, " | ").alias("concerns"),
                    F.array_join(signals, " | ").alias("signals"),
                    F.coalesce(lookup[1][risk], F.lit(VERDICT_UNKNOWN[0])).alias("headline"),
                    F.coalesce(lookup[2][risk], F.lit(VERDICT_UNKNOWN[1])).alias("detail"),
                    F.coalesce(lookup[3][risk], F.lit(VERDICT_UNKNOWN[2])).alias("action"))


def kpi_class(ctx: M.Economy) -> DataFrame:
    """Card classes: GDP < 0 red; unemployment YoY > 1.5 red, > 0.5 yellow; colour by risk."""
    t = ctx.thresholds
    ov = overview(ctx)
    q = latest_qoq(ctx).select(*ctx.K, "gdp_qoq_growth_pct")
    j = ov.join(q, on=ctx.K, how="left") if ctx.K else ov.crossJoin(q)
    g = F.coalesce(F.col("gdp_qoq_growth_pct"), F.lit(0.0))
    uc = F.coalesce(F.col("unemployment_yoy_change_pct"), F.lit(0.0))
    risk = F.col("recession_risk_level")
    risk_cls = (F.when(risk == "Low", "c-green").when(risk == "Emerging", "c-yellow")
                .when(risk == "Moderate", "c-orange").when(risk == "High", "c-red").otherwise(""))
    return j.select(*ctx.K, F.when(g >= 0, "").otherwise("c-red").alias("gdp_class"),
                    F.when(uc > t.kpi_unemp_red, "c-red").when(uc > t.kpi_unemp_yellow, "c-yellow").otherwise("")
                    .alias("unemployment_class"), risk_cls.alias("risk_class"))


def top_k_recent(ctx: M.Economy, k: int = 40) -> DataFrame:
    """Newest ``k`` quarters of the recession table per economy (top-k is the feature; WindowGroupLimit)."""
    r = M.fct_recession_analysis(ctx).select(*ctx.K, "year_quarter", "gdp_billions_usd", "qoq_growth_pct",
                                             "unemployment_rate_pct", "yoy_inflation_rate_pct",
                                             "recession_risk_level", "recession_intensity_score")
    if not ctx.K:
        return r.orderBy(F.col("year_quarter").desc()).limit(k)
    w = Window.partitionBy(*ctx.K).orderBy(F.col("year_quarter").desc())
    return r.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def newest_months(ctx: M.Economy, n: int = 10) -> DataFrame:
    """The newest ``n`` months of the monthly fact per economy (top-k is the feature)."""
    m = M.fct_economic_indicators_monthly(ctx).select(*ctx.K, D, "year_month", "cpi_index", "yoy_inflation_rate_pct",
                                                      "unemployment_rate_pct", "fedfunds_rate_pct", "sentiment_index",
                                                      "housing_starts_thousands")
    if not ctx.K:
        return m.orderBy(F.col(D).desc()).limit(n)
    w = Window.partitionBy(*ctx.K).orderBy(F.col(D).desc())
    return m.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def last_year(ctx: M.Economy) -> DataFrame:
    """The last twelve months of data per economy (relative to each economy's newest month)."""
    m = M.fct_economic_indicators_monthly(ctx)
    newest = m.groupBy(*ctx.K).agg(F.max(D).alias("_newest")) if ctx.K else m.agg(F.max(D).alias("_newest"))
    j = m.join(newest, on=ctx.K, how="inner") if ctx.K else m.crossJoin(F.broadcast(newest))
    return j.where(F.col(D) > F.add_months(F.col("_newest"), -12)).select(
        *ctx.K, D, "year_month", "yoy_inflation_rate_pct", "unemployment_rate_pct", "fedfunds_rate_pct")


def dashboard_from_tables(spark, tables_dir: str, keys=(), after: str = HISTORY_FROM) -> dict[str, DataFrame]:
    """R1-R4 as the dashboard runs them: over the mart tables a pipeline run wrote (``pipeline.write_models``).

    The date filter is a plain column predicate on the stored table, so it
    reaches the parquet scan; the economy key, if any, is a partition column.
    """
    base = tables_dir.rstrip("/")
    k = list(keys)

    def t(name):
        return spark.read.parquet(f"{base}/{name}")
    cutoff = F.col(D) > F.lit(after).cast("date")
    return {
        "overview": t("vw_economic_overview_dashboard"),
        "inflation": t("fct_inflation_analysis").where(cutoff).select(
            *k, D, "year_month", "yoy_inflation_rate_pct", "mom_inflation_change_pct", "inflation_severity_category",
            "fedfunds_rate_pct", "fed_policy_stance_to_inflation").orderBy(*k, D),
        "recession": t("fct_recession_analysis").where(cutoff).select(
            *k, D, "year_quarter", "gdp_billions_usd", "qoq_growth_pct", "unemployment_rate_pct",
            "yoy_inflation_rate_pct", "recession_risk_level", "recession_intensity_score",
            "consecutive_negative_quarters").orderBy(*k, D),
        "employment": t("fct_employment_analysis").where(cutoff).select(
            *k, D, "year_month", "unemployment_rate_pct", "unemployment_yoy_change_pct", "unemployment_trend",
            "housing_starts_thousands", "labor_market_health_score", "labor_market_condition").orderBy(*k, D),
    }
