"""The single-economy form (no panel keys) equals one economy of the panel."""

import pytest
from pyspark.sql import functions as F

from tidemark.config import DRIVER_PANEL_THRESHOLDS
from tidemark.plans import models as M
from tidemark.plans import reports as RP
from tidemark.sources.panels import SEGMENT, segment_observations

SF = "/root/testdata/sf0.001"


def _n(v):
    return round(v, 9) if isinstance(v, float) else v


def rows(df, drop=()):
    cols = sorted(c for c in df.columns if c not in drop)
    return sorted((tuple(_n(v) for v in r) for r in df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("model", ["int_cpi_inflation_rates", "int_recession_indicators",
                                   "int_indicator_cross_correlations", "fct_economic_indicators_monthly",
                                   "fct_economic_indicators_quarterly", "fct_employment_analysis",
                                   "vw_economic_overview_dashboard"])
def test_single_equals_panel_slice(spark, model):
    obs = segment_observations(spark, SF)
    panel = M.Economy(obs, keys=(SEGMENT,), thresholds=DRIVER_PANEL_THRESHOLDS)
    one = M.Economy(obs.where(F.col(SEGMENT) == "BUILDING").drop(SEGMENT), keys=(),
                    thresholds=DRIVER_PANEL_THRESHOLDS)
    a = M.MODELS[model](panel).where(F.col(SEGMENT) == "BUILDING").drop(SEGMENT)
    b = M.MODELS[model](one)
    if model == "vw_economic_overview_dashboard":
        # the period dimension spans the whole panel's months in the panel form
        drop = ("year", "month", "quarter", "is_nber_recession_period", "recession_name")
    else:
        drop = ()
    assert rows(a, drop) == rows(b, drop)


def test_single_economy_reports(spark):
    obs = segment_observations(spark, SF).where(F.col(SEGMENT) == "HOUSEHOLD").drop(SEGMENT)
    one = M.Economy(obs, keys=(), thresholds=DRIVER_PANEL_THRESHOLDS)
    assert RP.top_k_recent(one, 40).count() <= 40
    assert RP.newest_months(one, 10).count() == 10
    assert RP.economy_snapshot(one).count() == 1
