"""Fixed values that must equal the reference's for right results.

Everything here is data: the six-series registry, staging types, rule
thresholds (with the reference's defaults), freshness/staleness windows,
recession intervals and the fixed texts of the reports.  Operators take these
as parameters so a panel with other units can pass its own cut-offs.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# FIXED VALUES — series registry (series_id, indicator, frequency, staging
# decimal type, staged value column, indicator_type, units, config range,
# test range, freshness warn/error days, staleness days)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class SeriesSpec:
    series_id: str
    indicator: str
    frequency: str
    precision: int
    scale: int
    value_col: str
    indicator_type: str
    units: str
    config_range: tuple[float, float]
    test_range: tuple[float, float]
    fresh_warn_days: int
    fresh_error_days: int
    stale_days: int
    table_name: str

    @property
    def decimal_type(self) -> str:
        return f"decimal({self.precision},{self.scale})"


SERIES: tuple[SeriesSpec, ...] = (
    SeriesSpec("GDPC1", "GDP", "quarterly", 18, 2, "gdp_billions_usd", "Economic Output",
               "Billions of Chained 2012 Dollars", (5000.0, 30000.0), (0.0, 30000.0), 35, 60, 45, "raw_gdp"),
    SeriesSpec("CPIAUCSL", "CPI", "monthly", 18, 4, "cpi_index", "Inflation",
               "Index 1982-1984 = 100", (30.0, 400.0), (50.0, 400.0), 10, 20, 15, "raw_cpi"),
    SeriesSpec("UNRATE", "Unemployment Rate", "monthly", 6, 2, "unemployment_rate_pct", "Labor Market",
               "Percent", (0.0, 15.0), (2.0, 15.0), 8, 15, 15, "raw_unemployment"),
    SeriesSpec("FEDFUNDS", "Federal Funds Rate", "monthly", 6, 2, "fedfunds_rate_pct", "Monetary Policy",
               "Percent", (0.0, 20.0), (0.0, 25.0), 5, 15, 15, "raw_federal_funds"),
    SeriesSpec("UMCSENT", "Consumer Sentiment", "monthly", 8, 2, "sentiment_index", "Consumer Confidence",
               "Index", (50.0, 120.0), (50.0, 150.0), 10, 20, 15, "raw_consumer_sentiment"),
    SeriesSpec("HOUST", "Housing Starts", "monthly", 10, 1, "housing_starts_thousands", "Construction Activity",
               "Thousands of Units", (400.0, 2500.0), (300.0, 3000.0), 12, 25, 15, "raw_housing_starts"),
)
SERIES_BY_ID = {s.series_id: s for s in SERIES}
DATA_SOURCE = "FRED"
BACKFILL_START = "2000-01-01"
DEFAULT_STALE_DAYS = 15
INCREMENTAL_LOOKBACK_DAYS = 90
ZSCORE_LOOKBACK_DAYS = 730
ZSCORE_LIMIT = 3.0

# ---------------------------------------------------------------------------
# FIXED VALUES — labels, intervals and texts the outputs must carry
# ---------------------------------------------------------------------------

# Rolling-average streams of the long table (M11): series, label, category.
ROLLING_STREAMS = (
    ("CPIAUCSL", "CPI", "Inflation"),
    ("UNRATE", "Unemployment Rate", "Labor Market"),
    ("FEDFUNDS", "Federal Funds Rate", "Monetary Policy"),
    ("UMCSENT", "Consumer Sentiment", "Consumer Confidence"),
    ("HOUST", "Housing Starts", "Construction Activity"),
)
ROLLING_WINDOWS = (3, 6, 12)

# Recession periods (intended intervals, inclusive month starts).
RECESSION_INTERVALS = (
    ("2001-03-01", "2001-11-01", "2001 Recession"),
    ("2007-12-01", "2009-06-01", "2007-2009 Financial Crisis"),
    ("2020-03-01", "2020-04-01", "2020 COVID Recession"),
)

# Texts of the recession summary (M17) by risk level; last one is the ELSE.
RISK_SUMMARY = (
    ("High", "Imminent recession risk with multiple distress signals"),
    ("Moderate", "Elevated recession risk, continued monitoring warranted"),
    ("Emerging", "Early warning signs present, situation developing"),
)
RISK_SUMMARY_ELSE = "Low recession risk, economy functioning normally"

# Contributing-factor labels.
FACTOR_LABELS = ("Negative GDP Growth", "Rapid Job Losses", "High Inflation", "Weak Consumer Sentiment")

# Dashboard verdict (icon text dropped) and action texts by risk level.
VERDICTS = (
    ("Low", "Economy looks healthy.", "No recession signals. Growth is on track and conditions are stable.",
     "For investors: risk assets typically perform well in this environment. For businesses: a reasonable time to plan expansion. For consumers: labor market is supportive."),
    ("Emerging", "Early warning signs are appearing.", "The economy is still growing but cracks are forming. Monitor closely over the next 1–2 quarters.",
     "For investors: consider reviewing portfolio defensiveness. For businesses: revisit hiring and capex plans. For policymakers: pre-emptive monitoring warranted."),
    ("Moderate", "Multiple caution signals active.", "Several indicators are deteriorating simultaneously. Historically, this pattern precedes slowdowns within 6–12 months.",
     "For investors: consider tilting toward defensive sectors (utilities, healthcare, consumer staples). For businesses: conserve cash, delay non-essential capex. For policymakers: stimulus tools should be on standby."),
    ("High", "Conditions consistent with recession.", "Most indicators are flashing red. Historical patterns suggest elevated probability of contraction.",
     "For investors: defensive positioning advised — bonds, cash, defensive equities. For businesses: protect margins, freeze non-critical hiring. For policymakers: coordinated fiscal and monetary response may be needed."),
)
VERDICT_UNKNOWN = ("Data unavailable.", "", "")

# Accepted values of the label columns.
ACCEPTED = {
    "inflation_severity_category": ("Mild", "Moderate", "High", "Severe"),
    "trend_direction": ("Rising", "Declining", "Flat"),
    "rate_direction": ("Rising", "Falling", "Flat"),
    "sentiment_outlook": ("Optimistic", "Pessimistic", "Neutral"),
    "recession_risk_level": ("Low", "Emerging", "Moderate", "High"),
    "gdp_unemployment_relationship": ("Strong Inverse", "Moderate Inverse", "Weak", "Positive"),
    "inflation_fedfunds_relationship": ("Strong Positive", "Moderate Positive", "Weak"),
    "inflation_momentum": ("Accelerating", "Decelerating", "Stable"),
    "fed_policy_stance_to_inflation": ("Tightening Response", "Accommodative Despite Inflation", "Restrictive",
                                       "Neutral", "Accommodative"),
    "fed_policy_effectiveness": ("Effective", "Insufficient", "Permissive", "Neutral"),
    "labor_market_condition": ("Excellent", "Good", "Fair", "Weak"),
}


@dataclass(frozen=True)
class Thresholds:
    """Rule cut-offs; defaults are the reference's values (project vars and CASE literals)."""

    # inflation severity (yoy %)
    inflation_mild: float = 2.5
    inflation_moderate: float = 4.0
    inflation_high: float = 5.0
    # recession risk
    consecutive_negative_quarters: int = 2
    risk_unemp_yoy_high: float = 0.5
    risk_gdp_yoy_low: float = 2.0
    risk_emerging_lo: float = 2.0
    risk_emerging_hi: float = 2.5
    risk_emerging_unemp_yoy: float = 0.0
    # intensity score
    intensity_gdp_yoy_neg: float = 0.0
    intensity_gdp_yoy_low: float = 2.0
    intensity_unemp_rate_hi: float = 5.5
    intensity_unemp_rate_mid: float = 4.5
    intensity_unemp_yoy_hi: float = 1.0
    intensity_unemp_yoy_mid: float = 0.5
    # labour market
    healthy_unemp_rate: float = 5.0
    score_rate_low: float = 4.0
    score_rate_mid_hi: float = 5.0
    score_yoy_low: float = 0.5
    score_housing_hi: float = 1500.0
    score_housing_mid: float = 1200.0
    condition_excellent: int = 8
    condition_good: int = 6
    condition_fair: int = 4
    assess_housing_lo: float = 1000.0
    assess_rate_tight: float = 4.5
    assess_unemp_yoy: float = 0.5
    # sentiment pivot
    sentiment_pivot: float = 100.0
    # fed stance (inflation yoy %)
    stance_hot: float = 3.0
    stance_cool: float = 2.0
    # correlation classes
    corr_strong_inverse: float = -0.5
    corr_moderate_inverse: float = -0.2
    corr_weak: float = 0.2
    corr_strong_positive: float = 0.5
    corr_moderate_positive: float = 0.2
    # recession factors
    factor_unemp_yoy: float = 1.0
    factor_inflation: float = 5.0
    factor_sentiment: float = 100.0
    # completeness
    complete_min_sources: int = 4
    # dashboard snapshot / KPI classes
    snap_gdp_growing: float = 0.5
    snap_unemp_low: float = 4.5
    snap_unemp_yoy_low: float = 0.5
    snap_unemp_yoy_fast: float = 1.5
    kpi_unemp_red: float = 1.5
    kpi_unemp_yellow: float = 0.5

    def with_(self, **kw) -> "Thresholds":
        return replace(self, **kw)


REFERENCE_THRESHOLDS = Thresholds()

# Driver-data panel (FIXTURES §4): unemployment stand-in runs about 20-40 and
# housing stand-in about 1-60 per (segment, month) at sf0.01, so the level
# cut-offs are passed scaled to those units; the other rules keep defaults.
DRIVER_PANEL_THRESHOLDS = Thresholds(
    healthy_unemp_rate=33.0,
    intensity_unemp_rate_hi=36.0,
    intensity_unemp_rate_mid=33.0,
    score_rate_low=30.0,
    score_rate_mid_hi=33.0,
    assess_rate_tight=31.5,
    score_housing_hi=45.0,
    score_housing_mid=36.0,
    assess_housing_lo=30.0,
    snap_unemp_low=31.5,
)


@dataclass(frozen=True)
class PanelSpec:
    """Which columns identify a series inside a long panel, and its period column."""

    keys: tuple[str, ...] = ("series_id",)
    date: str = "period_date_key"
    extra: dict = field(default_factory=dict)
