"""The twenty models (M1-M20) as DataFrame functions over an observation panel.

``Economy`` holds the long observation panel and the panel keys (one
reference "economy" = one key value).  Each model is a function
``(ctx) -> DataFrame``; they call each other like the reference's ``ref()``
and Catalyst plans across the boundaries.  Each model is built once per
context (memoised DataFrame); ``Economy(cut=SHARED)`` also persists the
intermediates that several models consume, and ``Economy.materialize`` cuts
the panel's lineage with a checkpoint before many models run.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (DATA_SOURCE, FACTOR_LABELS, RECESSION_INTERVALS, RISK_SUMMARY, RISK_SUMMARY_ELSE,
                      ROLLING_STREAMS, ROLLING_WINDOWS, SERIES_BY_ID, Thresholds, REFERENCE_THRESHOLDS)
from ..functions import rules as R
from ..functions import series as S
from ..functions.calendar import month_start, quarter_start, year_month_of, year_quarter_of
from ..operators import align as A
from ..operators.panel import latest_flag, series_window

D = "period_date_key"


@dataclass
class Economy:
    """An observation panel and how to read it.

    observations: long frame ``keys..., series_id, observation_date, value, ingested_at``.
    keys: columns naming one economy (empty tuple = the single-economy form).
    """

    observations: DataFrame
    keys: tuple[str, ...] = ()
    thresholds: Thresholds = REFERENCE_THRESHOLDS
    period_start: str | None = None   # dim spine bounds; None = from the data
    period_end: str | None = None
    cut: tuple[str, ...] = ()        # memo entries to persist when built (see SHARED)
    _memo: dict = field(default_factory=dict, repr=False)

    def memo(self, name: str, build) -> DataFrame:
        if name not in self._memo:
            df = build()
            if name in self.cut:
                # several models consume this one: keep it once (lazy, filled by
                # its first consumer; lost blocks are recomputed from lineage)
                from pyspark import StorageLevel
                df = df.persist(StorageLevel.MEMORY_AND_DISK)
            self._memo[name] = df
        return self._memo[name]

    @property
    def K(self) -> list[str]:
        return list(self.keys)

    def window(self):
        return series_window(self.keys, D)

    def persist(self) -> "Economy":
        """Keep the (aggregated) observation panel in executor memory/disk for the models that share it.

        Every model re-reads the panel several times (one branch per staged
        series); persisting it makes all branches read one materialised copy
        instead of re-running the scans, joins and aggregates behind it.  A
        lost executor only means its blocks are recomputed from lineage.
        """
        from pyspark import StorageLevel
        self.observations = self.observations.persist(StorageLevel.MEMORY_AND_DISK)
        self._memo.clear()
        return self

    def materialize(self) -> "Economy":
        """Cut the panel's lineage once with a reliable checkpoint in the shared folder.

        All models then plan over a one-node leaf (small plans, quick
        analysis) instead of re-expanding scans, joins and aggregates behind
        every staged series.  The checkpoint files survive the loss of an
        executor.
        """
        from pyspark import StorageLevel
        from ..session import ensure_checkpoint_dir
        ensure_checkpoint_dir(self.observations.sparkSession)
        obs = self.observations
        if self.keys:
            # windows and grouped aggregates downstream are clustered by the
            # economy keys: lay the panel out that way once, so they reuse it.
            # The checkpoint's write job then reads the repartition's shuffle
            # output instead of recomputing the panel.
            obs = obs.repartition(*self.keys)
        else:
            obs = obs.persist(StorageLevel.MEMORY_AND_DISK)  # so the write job does not recompute it
        self.observations = obs.checkpoint(eager=True)
        self._memo.clear()
        return self


# Intermediates with two or more consumers (M7-M10, M12, M15): the ones the
# reference materialises as tables and that a pipeline run should cut.
SHARED = ("int_gdp", "int_cpi", "int_labor", "int_fin", "int_recession", "fct_monthly")


# ---------------------------------------------------------------------------
# M1-M6 staging
# ---------------------------------------------------------------------------

def scan_raw(ctx: Economy, series_id: str) -> DataFrame:
    """Rows of one raw series (S2): a filter on the literal ``series_id``."""
    return ctx.observations.where(F.col("series_id") == F.lit(series_id)).select(
        *ctx.K, "observation_date", "series_id", "value", "ingested_at")


def stage(ctx: Economy, series_id: str) -> DataFrame:
    """Typed staging view of one series (P1 + P2)."""
    spec = SERIES_BY_ID[series_id]

    def build():
        raw = scan_raw(ctx, series_id).where(F.col("value").isNotNull())
        df = raw.select(
            *ctx.K,
            F.col("observation_date").alias("period_date"),
            F.col("observation_date").cast("date").alias(D),
            F.col("series_id").alias("series_code"),
            F.col("value").cast(spec.decimal_type).alias(spec.value_col),
            F.lit(DATA_SOURCE).alias("data_source"),
            F.lit(spec.indicator_type).alias("indicator_type"),
            F.lit(spec.series_id).alias("indicator_name"),
            F.col("ingested_at").alias("loaded_at"))
        return latest_flag(df, ctx.K, D)
    return ctx.memo(f"stg:{series_id}", build)


def stg_gdp(ctx): return stage(ctx, "GDPC1")
def stg_cpi(ctx): return stage(ctx, "CPIAUCSL")
def stg_unemployment_rate(ctx): return stage(ctx, "UNRATE")
def stg_federal_funds_rate(ctx): return stage(ctx, "FEDFUNDS")
def stg_consumer_sentiment(ctx): return stage(ctx, "UMCSENT")
def stg_housing_starts(ctx): return stage(ctx, "HOUST")


_META = ["data_source", "indicator_type", "indicator_name", "loaded_at", "is_latest"]


# ---------------------------------------------------------------------------
# M7-M13 intermediate
# ---------------------------------------------------------------------------

def int_gdp_with_yoy_change(ctx: Economy) -> DataFrame:
    """QoQ and YoY growth with negative-growth flags (M7: W1 n=4, W2, P4)."""
    def build():
        w = ctx.window()
        x = S.as_double("gdp_billions_usd")
        df = stg_gdp(ctx).select(
            *ctx.K, "period_date", D, "series_code", "gdp_billions_usd",
            S.pct_change(x, w, 1).alias("qoq_growth_pct"),
            S.pct_change(x, w, 4).alias("yoy_growth_pct"), *_META)
        return df.select(*ctx.K, "period_date", D, "series_code", "gdp_billions_usd", "qoq_growth_pct",
                         "yoy_growth_pct",
                         S.negative_flag("qoq_growth_pct").alias("is_qoq_negative_growth"),
                         S.negative_flag("yoy_growth_pct").alias("is_yoy_negative_growth"), *_META)
    return ctx.memo("int_gdp", build)


def inflation_severity(x, t: Thresholds) -> Column:
    return R.bucket(x, [t.inflation_mild, t.inflation_moderate, t.inflation_high],
                    ["Mild", "Moderate", "High"], "Severe")


def int_cpi_inflation_rates(ctx: Economy) -> DataFrame:
    """YoY and MoM inflation, 3-row mean of MoM, severity (M8: W1 n=12, W2, W5b, P3)."""
    def build():
        w = ctx.window()
        x = S.as_double("cpi_index")
        step1 = stg_cpi(ctx).select(
            *ctx.K, "period_date", D, "series_code", "cpi_index",
            S.pct_change(x, w, 12).alias("yoy_inflation_rate_pct"),
            S.pct_change(x, w, 1).alias("mom_change_pct"), *_META)
        step2 = step1.withColumn("rolling_3m_inflation_pct", S.rolling_avg("mom_change_pct", w, 3))
        return step2.select(*ctx.K, "period_date", D, "series_code", "cpi_index", "yoy_inflation_rate_pct",
                            "mom_change_pct", "rolling_3m_inflation_pct",
                            inflation_severity("yoy_inflation_rate_pct", ctx.thresholds)
                            .alias("inflation_severity_category"), *_META)
    return ctx.memo("int_cpi", build)


def int_labor_market_metrics(ctx: Economy) -> DataFrame:
    """YoY %, monthly difference, 3-row mean, trend, healthy flag (M9: W1 W3 W4 W5 P6)."""
    def build():
        w = ctx.window()
        t = ctx.thresholds
        x = S.as_double("unemployment_rate_pct")
        df = stg_unemployment_rate(ctx).select(
            *ctx.K, "period_date", D, "series_code", "unemployment_rate_pct",
            S.pct_change(x, w, 12).alias("yoy_change_pct"),
            S.diff(x, w, 1).alias("mom_change_pct"),
            S.rolling_avg(x, w, 3).alias("rolling_3m_avg_pct"),
            S.direction("unemployment_rate_pct", w, "Rising", "Declining", "Flat").alias("trend_direction"),
            *_META)
        healthy = R.flag((F.col("unemployment_rate_pct") < F.lit(t.healthy_unemp_rate))
                         & F.col("trend_direction").isin("Declining", "Flat"))
        return df.select(*ctx.K, "period_date", D, "series_code", "unemployment_rate_pct", "yoy_change_pct",
                         "mom_change_pct", "rolling_3m_avg_pct", "trend_direction",
                         healthy.alias("is_labor_market_healthy"), *_META)
    return ctx.memo("int_labor", build)


def int_financial_conditions(ctx: Economy) -> DataFrame:
    """Fed funds change/direction ⟗ sentiment YoY/outlook, stress flag (M10: W1 W3 W4 P5 P6 J1)."""
    def build():
        w = ctx.window()
        t = ctx.thresholds
        f = stg_federal_funds_rate(ctx).select(
            *ctx.K, F.col("period_date").alias("f_period_date"), D, "fedfunds_rate_pct",
            S.diff(S.as_double("fedfunds_rate_pct"), w).alias("rate_change_bps"),
            S.direction("fedfunds_rate_pct", w, "Rising", "Falling", "Flat").alias("rate_direction"))
        s = stg_consumer_sentiment(ctx).select(
            *ctx.K, F.col("period_date").alias("s_period_date"), D, "sentiment_index",
            S.pct_change(S.as_double("sentiment_index"), w, 12).alias("sentiment_yoy_change_pct"),
            R.outlook("sentiment_index", t.sentiment_pivot).alias("sentiment_outlook"))
        # full outer alignment of the two series: one union + grouped aggregate
        j = A.align_many([("f", f), ("s", s)], ctx.K + [D])
        stress = R.flag((F.col("rate_direction") == "Rising") & (F.col("sentiment_outlook") == "Pessimistic"))
        return j.select(*ctx.K, F.coalesce("f_period_date", "s_period_date").alias("period_date"), D,
                        "fedfunds_rate_pct", "rate_change_bps", "rate_direction", "sentiment_index",
                        "sentiment_yoy_change_pct", "sentiment_outlook",
                        stress.alias("is_financial_stress_elevated"))
    return ctx.memo("int_fin", build)


def int_economic_rolling_averages(ctx: Economy) -> DataFrame:
    """3/6/12-row means of the five monthly series in ONE windowed pass (M11: W5, U1).

    Instead of five scans unioned, the staged values of all five series are
    read once in long form and windowed by (keys, series).
    """
    def build():
        label = {sid: (lab, cat) for sid, lab, cat in ROLLING_STREAMS}
        sids = list(label)
        typed = None
        for sid in sids:  # staged value: the series' own decimal type, then double
            v = F.col("value").cast(SERIES_BY_ID[sid].decimal_type).cast("double")
            typed = F.when(F.col("series_id") == sid, v) if typed is None else typed.when(F.col("series_id") == sid, v)
        ind = R.decision_table([(F.col("series_id") == s, label[s][0]) for s in sids])
        cat = R.decision_table([(F.col("series_id") == s, label[s][1]) for s in sids])
        long = ctx.observations.where(F.col("series_id").isin(*sids) & F.col("value").isNotNull()).select(
            *ctx.K, "series_id", F.col("observation_date").cast("date").alias(D), typed.alias("v"))
        w = series_window(ctx.K + ["series_id"], D)
        return long.select(*ctx.K, D, ind.alias("indicator_type"),
                           *[S.rolling_avg("v", w, n).alias(f"rolling_{n}m_avg") for n in ROLLING_WINDOWS],
                           cat.alias("metric_category"))
    return ctx.memo("int_rolling", build)


def recession_risk(t: Thresholds) -> Column:
    c = F.col
    return R.decision_table([
        (c("consecutive_negative_quarters") >= t.consecutive_negative_quarters, "High"),
        (c("is_qoq_negative_growth") & (c("unemployment_yoy_change_pct") > t.risk_unemp_yoy_high), "High"),
        ((c("is_qoq_negative_growth") | (c("yoy_growth_pct") < t.risk_gdp_yoy_low))
         & (c("sentiment_outlook") == "Pessimistic"), "Moderate"),
        (c("yoy_growth_pct").between(t.risk_emerging_lo, t.risk_emerging_hi)
         & (c("unemployment_yoy_change_pct") > t.risk_emerging_unemp_yoy), "Emerging"),
    ], "Low")


def recession_intensity(t: Thresholds) -> Column:
    c = F.col
    score = R.additive_score([
        R.points([(c("is_qoq_negative_growth"), 3)]),
        R.points([(c("yoy_growth_pct") < t.intensity_gdp_yoy_neg, 5), (c("yoy_growth_pct") < t.intensity_gdp_yoy_low, 2)]),
        R.points([(c("unemployment_rate_pct") > t.intensity_unemp_rate_hi, 2),
                  (c("unemployment_rate_pct") > t.intensity_unemp_rate_mid, 1)]),
        R.points([(c("unemployment_yoy_change_pct") > t.intensity_unemp_yoy_hi, 2),
                  (c("unemployment_yoy_change_pct") > t.intensity_unemp_yoy_mid, 1)]),
        R.points([(c("inflation_severity_category").isin("High", "Severe"), 1)]),
        R.points([(c("sentiment_outlook") == "Pessimistic", 1)]),
    ])
    return score.cast("decimal(5,2)")


def int_recession_indicators(ctx: Economy) -> DataFrame:
    """GDP quarters ⟕ first-month indicators, negatives-in-4, risk level, intensity (M12: J4 W6 P7 P8)."""
    def build():
        t = ctx.thresholds
        on = ctx.K + [D]
        g = int_gdp_with_yoy_change(ctx).select(*on, "gdp_billions_usd", "qoq_growth_pct", "yoy_growth_pct",
                                                "is_qoq_negative_growth", "is_yoy_negative_growth")
        u = int_labor_market_metrics(ctx).select(*on, "unemployment_rate_pct",
                                                 F.col("yoy_change_pct").alias("unemployment_yoy_change_pct"),
                                                 "is_labor_market_healthy")
        i = int_cpi_inflation_rates(ctx).select(*on, "yoy_inflation_rate_pct", "inflation_severity_category")
        s = int_financial_conditions(ctx).select(*on, "sentiment_index", "sentiment_outlook")
        # GDP quarters left-joined to the first month of each quarter (J4): the
        # four sources aligned in one union + grouped aggregate, keeping the keys
        # GDP has (a left join when every source has one row per key)
        j = A.align_many([("g", g), ("u", u), ("i", i), ("s", s)], on).where(F.col("_has_g") == 1)
        w = ctx.window()
        j = j.withColumn("consecutive_negative_quarters", S.rolling_count_if("is_qoq_negative_growth", w, 4))
        return j.select(*on, "gdp_billions_usd", "qoq_growth_pct", "yoy_growth_pct", "unemployment_rate_pct",
                        "unemployment_yoy_change_pct", "yoy_inflation_rate_pct", "inflation_severity_category",
                        "sentiment_index", "sentiment_outlook", "consecutive_negative_quarters",
                        recession_risk(t).alias("recession_risk_level"),
                        recession_intensity(t).alias("recession_intensity_score"))
    return ctx.memo("int_recession", build)


CORR_PAIRS = (
    ("gdp_vs_unemployment_corr", "gdp_billions_usd", "unemployment_rate_pct"),
    ("inflation_vs_fedfunds_corr", "yoy_inflation_rate_pct", "fedfunds_rate_pct"),
    ("gdp_vs_sentiment_corr", "gdp_billions_usd", "sentiment_index"),
    ("unemployment_vs_sentiment_corr", "unemployment_rate_pct", "sentiment_index"),
    ("inflation_vs_sentiment_corr", "yoy_inflation_rate_pct", "sentiment_index"),
)


def quarter_indicator_means(ctx: Economy) -> DataFrame:
    """GDP quarters with the quarter means of the four monthly inputs of M13, in ONE aggregate.

    Each monthly source is projected to its quarter start and all sources are
    unioned by name; a single ``groupBy(keys, quarter)`` then averages every
    monthly column (avg ignores the other sources' nulls) and keeps the one
    GDP row of the quarter.  No fan-out, no join, one shuffle.
    """
    on = ctx.K + [D]
    q = quarter_start(D).alias(D)
    g = int_gdp_with_yoy_change(ctx).where(F.col("gdp_billions_usd").isNotNull()).select(
        *on, S.as_double("gdp_billions_usd").alias("gdp_billions_usd"), F.lit(1).alias("_has_g"))
    parts = [g,
             int_labor_market_metrics(ctx).select(*ctx.K, q, S.as_double("unemployment_rate_pct").alias("unemployment_rate_pct")),
             int_cpi_inflation_rates(ctx).select(*ctx.K, q, "yoy_inflation_rate_pct"),
             stg_federal_funds_rate(ctx).select(*ctx.K, q, S.as_double("fedfunds_rate_pct").alias("fedfunds_rate_pct")),
             stg_consumer_sentiment(ctx).select(*ctx.K, q, S.as_double("sentiment_index").alias("sentiment_index"))]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    means = ["unemployment_rate_pct", "yoy_inflation_rate_pct", "fedfunds_rate_pct", "sentiment_index"]
    agg = u.groupBy(*on).agg(F.max("gdp_billions_usd").alias("gdp_billions_usd"),
                             *[F.avg(c).alias(c) for c in means], F.max("_has_g").alias("_has_g"))
    return agg.where(F.col("_has_g") == 1).drop("_has_g")


def int_indicator_cross_correlations(ctx: Economy, frame: int = 12) -> DataFrame:
    """Rolling 12-quarter Pearson correlations of five pairs and two relation classes (M13: J5 W7 P8 A9)."""
    def build():
        t = ctx.thresholds
        on = ctx.K + [D]
        nd = quarter_indicator_means(ctx)
        w = ctx.window()
        corr = nd.select(*on, *[S.round_half_up(S.rolling_corr(x, y, w, frame), 3).alias(name)
                                for name, x, y in CORR_PAIRS])
        gu, iff = F.col("gdp_vs_unemployment_corr"), F.col("inflation_vs_fedfunds_corr")
        rel1 = R.decision_table([
            (gu < t.corr_strong_inverse, "Strong Inverse"),
            (gu.between(t.corr_strong_inverse, t.corr_moderate_inverse), "Moderate Inverse"),
            (gu.between(t.corr_moderate_inverse, t.corr_weak), "Weak")], "Positive")
        rel2 = R.decision_table([(iff > t.corr_strong_positive, "Strong Positive"),
                                 (iff > t.corr_moderate_positive, "Moderate Positive")], "Weak")
        return corr.select(*on, *[name for name, _, _ in CORR_PAIRS],
                           rel1.alias("gdp_unemployment_relationship"),
                           rel2.alias("inflation_fedfunds_relationship"))
    return ctx.memo("int_corr", build)


# ---------------------------------------------------------------------------
# M14-M20 marts
# ---------------------------------------------------------------------------

def reference_recession_case(year, month) -> tuple[Column, Column]:
    """The recession CASE exactly as the reference writes it (OR between bounds, ledger #5)."""
    y, m = F.col(year), F.col(month)
    # FIXED VALUES: the reference's recession rule as written (year, month bounds
    # joined by OR, so all of 2001 and 2020 match and 2008 does not) and names
    rules = [
        (((y == 2001) & (m >= 3)) | ((y == 2001) & (m <= 11)), "2001 Recession"),
        (((y == 2007) & (m >= 12)) | ((y == 2009) & (m <= 6)), "2007-2009 Financial Crisis"),
        (((y == 2020) & (m >= 3)) | ((y == 2020) & (m <= 4)), "2020 COVID Recession"),
    ]
    flag = R.decision_table([(c, True) for c, _ in rules], False)
    name = R.decision_table(rules, None).cast("string")
    return flag, name


def period_spine(ctx: Economy) -> DataFrame:
    """Month starts from the first to the last observed month (or the given bounds).

    The bounds are one aggregate row; the spine has one row per calendar
    month, so its size is bounded by the calendar, not by the data.
    """
    obs = ctx.observations
    lo = F.lit(ctx.period_start).cast("date") if ctx.period_start else F.min("observation_date")
    hi = F.lit(ctx.period_end).cast("date") if ctx.period_end else F.max("observation_date")
    bounds = obs.agg(month_start(lo).alias("lo"), month_start(hi).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("period_date"))


def dim_economic_periods(ctx: Economy, recession_mode: str = "reference") -> DataFrame:
    """Calendar dimension with the recession flag and name.

    ``recession_mode='reference'`` reproduces the reference's CASE (all of
    2001 and 2020 flagged); ``'intervals'`` tags the intended intervals with an
    equi interval join (J8).
    """
    def build():
        p = period_spine(ctx)
        d = F.col("period_date")
        dims = p.select(
            "period_date",
            F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
            F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "MMM").alias("month_short"),
            year_quarter_of(F.year(d), F.quarter(d)).alias("year_quarter"),
            year_month_of(F.year(d), F.month(d)).alias("year_month"),
            F.weekofyear(d).alias("week_of_year"), F.dayofmonth(d).alias("day_of_month"),
            F.extract(F.lit("DAYOFWEEK_ISO"), d).cast("int").alias("day_of_week"),
            F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"))
        if recession_mode == "reference":
            flag, name = reference_recession_case("year", "month")
            return dims.select("*", flag.alias("is_nber_recession_period"), name.alias("recession_name"))
        tagged = A.interval_tag(dims, recession_intervals(dims.sparkSession), "period_date",
                                label="recession_name")
        return tagged.select(*dims.columns, F.col("recession_name").isNotNull().alias("is_nber_recession_period"),
                             "recession_name")
    return ctx.memo(f"dim:{recession_mode}", build)


def recession_intervals(spark) -> DataFrame:
    """The three recession intervals as a 3-row table (fixed values)."""
    return spark.createDataFrame(list(RECESSION_INTERVALS),
                                 "start_date string, end_date string, recession_name string").select(
        F.col("start_date").cast("date").alias("start_date"), F.col("end_date").cast("date").alias("end_date"),
        "recession_name")


MONTHLY_SOURCES = ("c", "u", "f", "s", "h")


def fct_economic_indicators_monthly(ctx: Economy) -> DataFrame:
    """Five monthly indicators aligned on the month in one shuffle; completeness 0-5 (M15: J2 A9 P7 P10)."""
    def build():
        t = ctx.thresholds
        on = ctx.K + [D]
        fin = int_financial_conditions(ctx)
        frames = [
            ("c", int_cpi_inflation_rates(ctx).select(*on, "cpi_index", "yoy_inflation_rate_pct",
                                                      "inflation_severity_category",
                                                      F.col("mom_change_pct").alias("cpi_mom_change_pct"))),
            ("u", int_labor_market_metrics(ctx).select(*on, "unemployment_rate_pct",
                                                       F.col("yoy_change_pct").alias("unemployment_yoy_change_pct"),
                                                       F.col("trend_direction").alias("unemployment_trend"),
                                                       "is_labor_market_healthy")),
            ("f", fin.where(F.col("fedfunds_rate_pct").isNotNull()).select(
                *on, "fedfunds_rate_pct", F.col("rate_direction").alias("fedfunds_direction"))),
            ("s", fin.where(F.col("sentiment_index").isNotNull()).select(*on, "sentiment_index", "sentiment_outlook")),
            ("h", stg_housing_starts(ctx).select(*on, "housing_starts_thousands")),
        ]
        m = A.align_many(frames, on)
        score = R.additive_score([F.col(f"_has_{n}") for n in MONTHLY_SOURCES]).cast("int")
        return m.select(
            *on, F.year(D).alias("year"), F.month(D).alias("month"),
            year_month_of(F.year(D), F.month(D)).alias("year_month"),
            "cpi_index", "yoy_inflation_rate_pct", "inflation_severity_category", "cpi_mom_change_pct",
            "unemployment_rate_pct", "unemployment_yoy_change_pct", "unemployment_trend", "is_labor_market_healthy",
            "fedfunds_rate_pct", "fedfunds_direction", "sentiment_index", "sentiment_outlook",
            "housing_starts_thousands", score.alias("data_completeness_score"),
            (score >= t.complete_min_sources).alias("is_data_complete"))
    return ctx.memo("fct_monthly", build)


QUARTER_AVG_COLS = ("cpi_index", "yoy_inflation_rate_pct", "unemployment_rate_pct", "unemployment_yoy_change_pct",
                    "fedfunds_rate_pct", "sentiment_index", "housing_starts_thousands")


def fct_economic_indicators_quarterly(ctx: Economy) -> DataFrame:
    """GDP quarters ⟗ quarter means of the monthly fact ⟕ recession signals (M16: A1 J3).

    All three sources are unioned by name on (keys, quarter) and reduced by
    ONE grouped aggregate: the monthly columns are averaged (A1), the GDP and
    recession columns have one row per quarter and pass through ``max``.  The
    recession signals exist only for GDP quarters, so the left join holds.
    """
    def build():
        on = ctx.K + [D]
        gcols = ["gdp_billions_usd", "qoq_growth_pct", "yoy_growth_pct", "is_qoq_negative_growth",
                 "is_yoy_negative_growth"]
        rcols = ["recession_risk_level", "recession_intensity_score", "consecutive_negative_quarters"]
        g = int_gdp_with_yoy_change(ctx).select(*on, *gcols, F.lit(1).alias("_has_g"))
        m = fct_economic_indicators_monthly(ctx).select(
            *ctx.K, quarter_start(D).alias(D), *[S.as_double(c).alias(f"avg_{c}") for c in QUARTER_AVG_COLS],
            F.lit(1).alias("_has_qa"))
        rs = int_recession_indicators(ctx).select(*on, *rcols)
        u = g.unionByName(m, allowMissingColumns=True).unionByName(rs, allowMissingColumns=True)
        j = u.groupBy(*on).agg(*[F.max(c).alias(c) for c in gcols],
                               *[F.avg(f"avg_{c}").alias(f"avg_{c}") for c in QUARTER_AVG_COLS],
                               *[F.max(c).alias(c) for c in rcols],
                               F.max("_has_g").alias("_has_g"), F.max("_has_qa").alias("_has_qa"))
        j = j.where((F.col("_has_g") == 1) | (F.col("_has_qa") == 1))
        year, quarter = F.year(D), F.quarter(D)
        return j.select(*on, F.col(D).alias("period_date_quarter"), year.alias("year"), quarter.alias("quarter"),
                        year_quarter_of(year, quarter).alias("year_quarter"), *gcols,
                        *[f"avg_{c}" for c in QUARTER_AVG_COLS], *rcols)
    return ctx.memo("fct_quarterly", build)


def fct_recession_analysis(ctx: Economy) -> DataFrame:
    """Contributing factors, their count and the risk summary text (M17: P8 P9)."""
    def build():
        t = ctx.thresholds
        c = F.col
        text, count = R.factor_list([
            (c("qoq_growth_pct") < 0, FACTOR_LABELS[0]),
            (c("unemployment_yoy_change_pct") > t.factor_unemp_yoy, FACTOR_LABELS[1]),
            (c("yoy_inflation_rate_pct") > t.factor_inflation, FACTOR_LABELS[2]),
            (c("sentiment_index") < t.factor_sentiment, FACTOR_LABELS[3]),
        ])
        summary = R.decision_table([(c("recession_risk_level") == lvl, txt) for lvl, txt in RISK_SUMMARY],
                                   RISK_SUMMARY_ELSE)
        ri = int_recession_indicators(ctx)
        return ri.select(*ctx.K, D, F.year(D).alias("year"), F.quarter(D).alias("quarter"),
                         year_quarter_of(F.year(D), F.quarter(D)).alias("year_quarter"),
                         "gdp_billions_usd", "qoq_growth_pct", "yoy_growth_pct", "unemployment_rate_pct",
                         "unemployment_yoy_change_pct", "yoy_inflation_rate_pct", "sentiment_index",
                         "recession_risk_level", "recession_intensity_score", "consecutive_negative_quarters",
                         text.alias("recession_contributing_factors"), count.alias("num_contributing_factors"),
                         summary.alias("risk_assessment_summary"))
    return ctx.memo("fct_recession", build)


def fed_stance(t: Thresholds) -> Column:
    c = F.col
    d, y = c("fedfunds_direction"), c("yoy_inflation_rate_pct")
    return R.decision_table([
        ((d == "Rising") & (y > t.stance_hot), "Tightening Response"),
        ((d == "Falling") & (y > t.stance_hot), "Accommodative Despite Inflation"),
        ((d == "Rising") & (y < t.stance_cool), "Restrictive"),
        (d == "Flat", "Neutral"),
    ], "Accommodative")


def fed_effectiveness() -> Column:
    c = F.col
    st, mo = c("fed_policy_stance_to_inflation"), c("inflation_momentum")
    return R.decision_table([
        ((st == "Tightening Response") & (mo == "Decelerating"), "Effective"),
        ((st == "Tightening Response") & (mo == "Accelerating"), "Insufficient"),
        (st.isin("Accommodative", "Accommodative Despite Inflation") & (mo == "Accelerating"), "Permissive"),
    ], "Neutral")


def fct_inflation_analysis(ctx: Economy) -> DataFrame:
    """Fed stance, inflation momentum and policy effectiveness by month (M18: W2 W4 P8)."""
    def build():
        t = ctx.thresholds
        w = ctx.window()
        m = fct_economic_indicators_monthly(ctx)
        step = m.select(*ctx.K, D, "year", "month", "year_month", "cpi_index", "yoy_inflation_rate_pct",
                        "inflation_severity_category", "cpi_mom_change_pct", "fedfunds_rate_pct",
                        "fedfunds_direction", fed_stance(t).alias("fed_policy_stance_to_inflation"),
                        S.lag_of("yoy_inflation_rate_pct", w).alias("prev_yoy"),
                        S.direction("yoy_inflation_rate_pct", w, "Accelerating", "Decelerating", "Stable")
                        .alias("inflation_momentum"))
        return step.select(*ctx.K, D, "year", "month", "year_month", "cpi_index", "yoy_inflation_rate_pct",
                           S.round_half_up(F.col("yoy_inflation_rate_pct") - F.col("prev_yoy"), 2)
                           .alias("mom_inflation_change_pct"),
                           "inflation_severity_category", "cpi_mom_change_pct", "fedfunds_rate_pct",
                           "fedfunds_direction", "fed_policy_stance_to_inflation", "inflation_momentum",
                           fed_effectiveness().alias("fed_policy_effectiveness"))
    return ctx.memo("fct_inflation", build)


def labor_health_score(t: Thresholds) -> Column:
    c = F.col
    r, tr, y, h = c("unemployment_rate_pct"), c("unemployment_trend"), c("unemployment_yoy_change_pct"), \
        c("housing_starts_thousands")
    return R.additive_score([
        R.points([(r < t.score_rate_low, 3)]),
        R.points([(r.between(t.score_rate_low, t.score_rate_mid_hi), 2)]),
        R.points([(tr == "Declining", 2), (tr == "Flat", 1)]),
        R.points([(y < 0, 2), (y < t.score_yoy_low, 1)]),
        R.points([(h > t.score_housing_hi, 2), (h > t.score_housing_mid, 1)]),
    ])


def fct_employment_analysis(ctx: Economy) -> DataFrame:
    """Labour health score and condition, 6-row housing lead, assessment (M19: W9 P3 P7 P8)."""
    def build():
        t = ctx.thresholds
        w = ctx.window()
        c = F.col
        m = fct_economic_indicators_monthly(ctx)
        step = m.select(*ctx.K, D, "year", "month", "year_month", "unemployment_rate_pct",
                        "unemployment_yoy_change_pct", "unemployment_trend", "is_labor_market_healthy",
                        "housing_starts_thousands", labor_health_score(t).alias("labor_market_health_score"),
                        S.lag_of("housing_starts_thousands", w, 6).alias("h6"))
        h, h6 = c("housing_starts_thousands"), c("h6")
        change = S.round_half_up(F.try_divide(h.cast("double") - h6.cast("double"), h6.cast("double")) * 100.0, 2)
        lead = F.when(h > h6, "Positive").when(h < h6, "Negative").otherwise("Flat")
        sc = c("labor_market_health_score")
        condition = R.decision_table([(sc >= t.condition_excellent, "Excellent"), (sc >= t.condition_good, "Good"),
                                      (sc >= t.condition_fair, "Fair")], "Weak")
        healthy = c("is_labor_market_healthy")
        assessment = R.decision_table([
            (healthy & (h > t.score_housing_hi), "Robust Employment"),
            (healthy & h.between(t.assess_housing_lo, t.score_housing_hi), "Solid Employment"),
            ((c("unemployment_rate_pct") < t.assess_rate_tight) & c("unemployment_trend").isin("Declining", "Flat"),
             "Tightening Labor Market"),
            (c("unemployment_yoy_change_pct") > t.assess_unemp_yoy, "Deteriorating Labor Market"),
        ], "Moderate Employment")
        return step.select(*ctx.K, D, "year", "month", "year_month", "unemployment_rate_pct",
                           "unemployment_yoy_change_pct", "unemployment_trend", "is_labor_market_healthy",
                           "housing_starts_thousands", change.alias("housing_starts_6m_change_pct"),
                           lead.alias("housing_leading_indicator"), "labor_market_health_score",
                           condition.alias("labor_market_condition"), assessment.alias("employment_assessment"))
    return ctx.memo("fct_employment", build)


OVERVIEW_MONTHLY = ("year_month", "cpi_index", "yoy_inflation_rate_pct", "inflation_severity_category",
                    "unemployment_rate_pct", "unemployment_yoy_change_pct", "unemployment_trend",
                    "fedfunds_rate_pct", "fedfunds_direction", "sentiment_index", "sentiment_outlook",
                    "housing_starts_thousands", "is_labor_market_healthy")


def vw_economic_overview_dashboard(ctx: Economy) -> DataFrame:
    """Newest month ⟕ newest quarter with GDP ⟕ newest recession row ⟕ newest period, one row per economy (M20: W8 J7)."""
    def build():
        on = ctx.K
        lm = A.latest_per_key(fct_economic_indicators_monthly(ctx), on, D) if on else \
            fct_economic_indicators_monthly(ctx).orderBy(F.col(D).desc()).limit(1)
        lm = lm.select(*on, F.col(D).alias("latest_month"), *OVERVIEW_MONTHLY, "data_completeness_score",
                       "is_data_complete")
        q = fct_economic_indicators_quarterly(ctx).where(F.col("gdp_billions_usd").isNotNull())
        lq = (A.latest_per_key(q, on, D) if on else q.orderBy(F.col(D).desc()).limit(1)).select(
            *on, "gdp_billions_usd", "qoq_growth_pct", "yoy_growth_pct")
        r = fct_recession_analysis(ctx)
        lr = (A.latest_per_key(r, on, D) if on else r.orderBy(F.col(D).desc()).limit(1)).select(
            *on, "recession_risk_level", "recession_intensity_score", "recession_contributing_factors",
            "num_contributing_factors", "risk_assessment_summary")
        pd_ = dim_economic_periods(ctx).orderBy(F.col("period_date").desc()).limit(1).select(
            "year", "month", "quarter", "is_nber_recession_period", "recession_name")
        if on:
            j = lm.join(lq, on=on, how="left").join(lr, on=on, how="left")
        else:  # single economy: each side is one row (limit 1), so the broadcast is size-bounded
            j = lm.join(F.broadcast(lq), F.lit(True), "left").join(F.broadcast(lr), F.lit(True), "left")
        # the newest period is a single row (limit 1): broadcasting it is size-bounded
        j = j.join(F.broadcast(pd_), F.lit(True), "left")
        return j.select(*on, "latest_month", "year_month", "cpi_index", "yoy_inflation_rate_pct",
                        "inflation_severity_category", "unemployment_rate_pct", "unemployment_yoy_change_pct",
                        "unemployment_trend", "fedfunds_rate_pct", "fedfunds_direction", "sentiment_index",
                        "sentiment_outlook", "housing_starts_thousands", "is_labor_market_healthy",
                        "gdp_billions_usd", "qoq_growth_pct", "yoy_growth_pct", "recession_risk_level",
                        "recession_intensity_score", "recession_contributing_factors", "num_contributing_factors",
                        "risk_assessment_summary", "year", "month", "quarter", "is_nber_recession_period",
                        "recession_name", "data_completeness_score", "is_data_complete")
    return ctx.memo("overview", build)


MODELS = {
    "stg_gdp": stg_gdp,
    "stg_cpi": stg_cpi,
    "stg_unemployment_rate": stg_unemployment_rate,
    "stg_federal_funds_rate": stg_federal_funds_rate,
    "stg_consumer_sentiment": stg_consumer_sentiment,
    "stg_housing_starts": stg_housing_starts,
    "int_gdp_with_yoy_change": int_gdp_with_yoy_change,
    "int_cpi_inflation_rates": int_cpi_inflation_rates,
    "int_labor_market_metrics": int_labor_market_metrics,
    "int_financial_conditions": int_financial_conditions,
    "int_economic_rolling_averages": int_economic_rolling_averages,
    "int_recession_indicators": int_recession_indicators,
    "int_indicator_cross_correlations": int_indicator_cross_correlations,
    "dim_economic_periods": dim_economic_periods,
    "fct_economic_indicators_monthly": fct_economic_indicators_monthly,
    "fct_economic_indicators_quarterly": fct_economic_indicators_quarterly,
    "fct_recession_analysis": fct_recession_analysis,
    "fct_inflation_analysis": fct_inflation_analysis,
    "fct_employment_analysis": fct_employment_analysis,
    "vw_economic_overview_dashboard": vw_economic_overview_dashboard,
}
