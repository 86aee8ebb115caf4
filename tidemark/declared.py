"""The checks that models must pass, declared per model; ``checks()`` spells them out one by one.

Every declared column is checked by name.  ``required`` columns hold no nulls
(``warn``: a null is only a warning), ``unique`` ones one row per economy and
value, ``labels`` one of the listed values, ``ranges`` values within closed
bounds; the rest are type checks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from .config import ACCEPTED, DATA_SOURCE, RECESSION_INTERVALS, ROLLING_STREAMS, SERIES

#: type families by the names that checks use
FAMILIES = {"numeric": ("decimal", "double"), "whole": ("int", "bigint", "decimal", "double"), "date": ("date",), "text": ("string",)}


@dataclass(frozen=True)
class Check:
    """One declared check. params: values, or (lowest, highest), or a type family."""
    model: str
    column: str
    kind: str        # not_null, unique, accepted_values, between, of_type
    params: tuple = ()
    severity: str = "error"

    @property
    def name(self) -> str:
        return f"{self.model}.{self.column}.{self.kind}"


@dataclass(frozen=True)
class Declared:
    """What is declared about one model."""
    model: str
    required: str
    warn: str = ""
    unique: str = ""
    labels: dict = field(default_factory=dict)
    ranges: dict = field(default_factory=dict)
    numeric: str = ""
    whole: str = ""
    date: str = ""
    text: str = ""

    def checks(self) -> list[Check]:
        out = [Check(self.model, c, "not_null") for c in self.required.split()]
        out += [Check(self.model, c, "not_null", (), "warn") for c in self.warn.split()]
        out += [Check(self.model, c, "unique") for c in self.unique.split()]
        out += [Check(self.model, c, "accepted_values", tuple(v)) for c, v in self.labels.items()]
        out += [Check(self.model, c, "between", tuple(v)) for c, v in self.ranges.items()]
        out += [Check(self.model, c, "of_type", (family,)) for family in FAMILIES for c in getattr(self, family).split()]
        return out


# ---------------------------------------------------------------------------
# FIXED VALUES — columns, labels and bounds that the checks must name
# ---------------------------------------------------------------------------
FLAG = (True, False)
PERCENT_TREND = ACCEPTED["trend_direction"]
RATE_TREND = ACCEPTED["rate_direction"]
OUTLOOK = ACCEPTED["sentiment_outlook"]
SEVERITY = ACCEPTED["inflation_severity_category"]
RISK = ACCEPTED["recession_risk_level"]
STAGING_MODELS = {"GDPC1": "stg_gdp", "CPIAUCSL": "stg_cpi", "UNRATE": "stg_unemployment_rate", "FEDFUNDS": "stg_federal_funds_rate",
                  "UMCSENT": "stg_consumer_sentiment", "HOUST": "stg_housing_starts"}

STAGING = tuple(Declared(
    STAGING_MODELS[s.series_id],
    required=f"period_date period_date_key series_code {s.value_col} data_source indicator_type indicator_name loaded_at is_latest dbt_loaded_at",
    labels={"series_code": (s.series_id,), "data_source": (DATA_SOURCE,), "indicator_type": (s.indicator_type,)},
    ranges={s.value_col: s.test_range}, numeric=s.value_col, date="period_date") for s in SERIES)

INTERMEDIATE = (
    Declared("int_gdp_with_yoy_change", "period_date_key gdp_billions_usd is_qoq_negative_growth is_yoy_negative_growth", unique="period_date_key",
             labels={"is_qoq_negative_growth": FLAG, "is_yoy_negative_growth": FLAG}, numeric="gdp_billions_usd qoq_growth_pct yoy_growth_pct"),
    Declared("int_cpi_inflation_rates", "period_date_key cpi_index inflation_severity_category", unique="period_date_key",
             labels={"inflation_severity_category": SEVERITY}, numeric="cpi_index yoy_inflation_rate_pct mom_change_pct rolling_3m_inflation_pct"),
    Declared("int_labor_market_metrics", "period_date_key unemployment_rate_pct trend_direction is_labor_market_healthy", unique="period_date_key",
             labels={"trend_direction": PERCENT_TREND, "is_labor_market_healthy": FLAG},
             numeric="unemployment_rate_pct yoy_change_pct mom_change_pct rolling_3m_avg_pct"),
    Declared("int_financial_conditions", "period_date_key is_financial_stress_elevated",
             labels={"rate_direction": RATE_TREND, "sentiment_outlook": OUTLOOK, "is_financial_stress_elevated": FLAG},
             numeric="fedfunds_rate_pct rate_change_bps sentiment_index sentiment_yoy_change_pct"),
    Declared("int_economic_rolling_averages", "period_date_key indicator_type metric_category",
             labels={"indicator_type": tuple(label for _, label, _ in ROLLING_STREAMS)}, numeric="rolling_3m_avg rolling_6m_avg rolling_12m_avg"),
    Declared("int_recession_indicators", "period_date_key gdp_billions_usd recession_risk_level recession_intensity_score", unique="period_date_key",
             labels={"recession_risk_level": RISK}, ranges={"recession_intensity_score": (0, 15)},
             numeric="qoq_growth_pct unemployment_rate_pct yoy_inflation_rate_pct", whole="consecutive_negative_quarters"),
    Declared("int_indicator_cross_correlations", "period_date_key", unique="period_date_key",
             labels={c: ACCEPTED[c] for c in ("gdp_unemployment_relationship", "inflation_fedfunds_relationship")},
             ranges={f"{pair}_corr": (-1, 1) for pair in ("gdp_vs_unemployment", "inflation_vs_fedfunds", "gdp_vs_sentiment",
                                                          "unemployment_vs_sentiment", "inflation_vs_sentiment")}),
)

MARTS = (
    Declared("fct_economic_indicators_monthly", "period_date_key year month year_month is_data_complete dbt_loaded_at", warn="is_labor_market_healthy",
             unique="period_date_key",
             labels={"inflation_severity_category": SEVERITY, "unemployment_trend": PERCENT_TREND, "is_labor_market_healthy": FLAG,
                     "fedfunds_direction": RATE_TREND, "sentiment_outlook": OUTLOOK, "is_data_complete": FLAG},
             ranges={"month": (1, 12), "data_completeness_score": (0, 5)},
             numeric="cpi_index yoy_inflation_rate_pct cpi_mom_change_pct unemployment_rate_pct unemployment_yoy_change_pct fedfunds_rate_pct "
                     "sentiment_index housing_starts_thousands"),
    Declared("fct_economic_indicators_quarterly", "period_date_key year quarter year_quarter dbt_loaded_at",
             warn="gdp_billions_usd is_qoq_negative_growth", unique="period_date_key",
             labels={"is_qoq_negative_growth": FLAG, "recession_risk_level": RISK}, ranges={"quarter": (1, 4), "recession_intensity_score": (0, 15)},
             numeric="gdp_billions_usd qoq_growth_pct yoy_growth_pct"),
    Declared("dim_economic_periods", "period_date year quarter month month_name month_short year_quarter year_month quarter_name "
             "is_nber_recession_period dbt_loaded_at", unique="period_date",
             labels={"quarter_name": ("Q1", "Q2", "Q3", "Q4"), "is_nber_recession_period": FLAG,
                     "recession_name": tuple(name for *_, name in RECESSION_INTERVALS)}),
    Declared("fct_recession_analysis", "period_date_key year quarter year_quarter recession_risk_level recession_intensity_score "
             "risk_assessment_summary dbt_loaded_at", unique="period_date_key", labels={"recession_risk_level": RISK},
             ranges={"recession_intensity_score": (0, 15), "num_contributing_factors": (0, 4)},
             numeric="gdp_billions_usd qoq_growth_pct unemployment_rate_pct yoy_inflation_rate_pct sentiment_index",
             whole="consecutive_negative_quarters", text="recession_contributing_factors"),
    Declared("fct_inflation_analysis", "period_date_key year month year_month inflation_momentum fed_policy_stance_to_inflation "
             "fed_policy_effectiveness dbt_loaded_at", warn="yoy_inflation_rate_pct inflation_severity_category", unique="period_date_key",
             labels={"inflation_severity_category": SEVERITY, "inflation_momentum": ACCEPTED["inflation_momentum"], "fedfunds_direction": RATE_TREND,
                     "fed_policy_stance_to_inflation": ACCEPTED["fed_policy_stance_to_inflation"],
                     "fed_policy_effectiveness": ACCEPTED["fed_policy_effectiveness"]},
             numeric="cpi_index yoy_inflation_rate_pct mom_inflation_change_pct fedfunds_rate_pct"),
    Declared("fct_employment_analysis", "period_date_key year month year_month housing_leading_indicator labor_market_health_score "
             "labor_market_condition employment_assessment dbt_loaded_at",
             warn="unemployment_rate_pct unemployment_trend is_labor_market_healthy", unique="period_date_key",
             labels={"unemployment_trend": PERCENT_TREND, "is_labor_market_healthy": FLAG, "housing_leading_indicator": ("Positive", "Negative", "Flat"),
                     "labor_market_condition": ACCEPTED["labor_market_condition"]},
             ranges={"labor_market_health_score": (0, 10)},
             numeric="unemployment_rate_pct unemployment_yoy_change_pct housing_starts_thousands housing_starts_6m_change_pct"),
)


def checks(declared: tuple[Declared, ...] = (*STAGING, *INTERMEDIATE, *MARTS)) -> list[Check]:
    return [c for d in declared for c in d.checks()]
