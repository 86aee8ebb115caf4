"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their SQL twins.

Every query reads the driver tables (or frames Spark derives from them) and
runs the library's own operators over them.  Double outputs are rounded to 6
decimals so the order in which an engine sums a frame cannot change the
compared value; the twins do the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..config import DRIVER_PANEL_THRESHOLDS
from ..sources.panels import SEGMENT, segment_observations
from . import models as M
from . import twins as TW

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Round double columns to 6 decimals for engine-independent comparison.

    The rounding goes through DECIMAL(38,9) and rounds half up there: both
    engines turn a double into a decimal from its shortest decimal form, so an
    exact half (a value like -0.8359375) or summation noise far below 1e-9
    rounds the same way in both.  Decimals carry no negative zero.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(f.name).cast("decimal(38,9)"), 6).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def double_columns(df: DataFrame) -> tuple[str, ...]:
    return tuple(f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType)))


def driver_economy(spark: SparkSession, sf_dir: str, materialize: bool = False, share: bool = True) -> M.Economy:
    """Segment panel from the driver tables with thresholds in its units.

    ``materialize`` cuts the panel's lineage once (``Economy.materialize``):
    worth it when the plan re-reads the panel many times (composite models,
    reports, the check suite); a single-series query instead keeps the lazy
    plan, which prunes the branches it does not need (CPI never scans orders),
    and with ``share=False`` skips persisting frames that only one branch reads.
    """
    ctx = M.Economy(segment_observations(spark, sf_dir, share or materialize), keys=(SEGMENT,),
                    thresholds=DRIVER_PANEL_THRESHOLDS)
    return ctx.materialize() if materialize else ctx


# models whose plan re-reads the panel through several intermediates
COMPOSITE = {"int_recession_indicators", "int_indicator_cross_correlations", "fct_economic_indicators_monthly",
             "fct_economic_indicators_quarterly", "fct_recession_analysis", "fct_inflation_analysis",
             "fct_employment_analysis", "vw_economic_overview_dashboard"}


def register(name: str, fn: Callable[[SparkSession, str], DataFrame], sql: str | None,
             doubles: tuple[str, ...] = ()) -> None:
    QUERIES[name] = lambda spark, sf_dir, _fn=fn: tidy(_fn(spark, sf_dir))
    if sql is not None:
        ORACLE[name] = TW.compose(sql, doubles)


# double columns of each model (rounded in both engines)
MODEL_DOUBLES = {
    "stg_gdp": (), "stg_cpi": (), "stg_unemployment_rate": (), "stg_federal_funds_rate": (),
    "stg_consumer_sentiment": (), "stg_housing_starts": (),
    "int_gdp_with_yoy_change": ("qoq_growth_pct", "yoy_growth_pct"),
    "int_cpi_inflation_rates": ("yoy_inflation_rate_pct", "mom_change_pct", "rolling_3m_inflation_pct"),
    "int_labor_market_metrics": ("yoy_change_pct", "mom_change_pct", "rolling_3m_avg_pct"),
    "int_financial_conditions": ("rate_change_bps", "sentiment_yoy_change_pct"),
    "int_economic_rolling_averages": ("rolling_3m_avg", "rolling_6m_avg", "rolling_12m_avg"),
    "int_recession_indicators": ("qoq_growth_pct", "yoy_growth_pct", "unemployment_yoy_change_pct",
                                 "yoy_inflation_rate_pct"),
    "int_indicator_cross_correlations": (),
    "dim_economic_periods": (),
    "fct_economic_indicators_monthly": ("yoy_inflation_rate_pct", "cpi_mom_change_pct", "unemployment_yoy_change_pct"),
    "fct_economic_indicators_quarterly": ("qoq_growth_pct", "yoy_growth_pct", "avg_cpi_index",
                                          "avg_yoy_inflation_rate_pct", "avg_unemployment_rate_pct",
                                          "avg_unemployment_yoy_change_pct", "avg_fedfunds_rate_pct",
                                          "avg_sentiment_index", "avg_housing_starts_thousands"),
    "fct_recession_analysis": ("qoq_growth_pct", "yoy_growth_pct", "unemployment_yoy_change_pct",
                               "yoy_inflation_rate_pct"),
    "fct_inflation_analysis": ("yoy_inflation_rate_pct", "cpi_mom_change_pct"),
    "fct_employment_analysis": ("unemployment_yoy_change_pct",),
    "vw_economic_overview_dashboard": ("yoy_inflation_rate_pct", "unemployment_yoy_change_pct", "qoq_growth_pct",
                                       "yoy_growth_pct"),
}

# models that read one series of the panel (one branch: nothing to share)
SINGLE_SERIES = {"stg_gdp", "stg_cpi", "stg_unemployment_rate", "stg_federal_funds_rate", "stg_consumer_sentiment",
                 "stg_housing_starts", "int_gdp_with_yoy_change", "int_cpi_inflation_rates", "int_labor_market_metrics"}

for _name, _fn in M.MODELS.items():
    register(_name, lambda spark, sf_dir, _f=_fn, _m=_name in COMPOSITE, _s=_name not in SINGLE_SERIES:
             _f(driver_economy(spark, sf_dir, _m, _s)), TW.MODEL_SELECT[_name], MODEL_DOUBLES[_name])
