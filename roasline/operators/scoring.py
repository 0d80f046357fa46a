"""Campaign forecasts: quantile scores -> ROAS, confidence, risk and insight text.

All steps are column expressions over the (distributed) prediction set; a
scorer only has to add three raw quantile columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roasline.functions import fmt_fixed, safe_divide, text_or

Scorer = Callable[[DataFrame], DataFrame]

RAW_Q = ["raw_q10", "raw_q50", "raw_q90"]
REVENUE_COLS = ["revenue_low", "revenue_expected", "revenue_high"]
ROAS_COLS = ["roas_low", "roas_expected", "roas_high"]

# text standing in for a NULL value inside generated sentences
NULL_TEXT = "nan"

# Confidence rule.
CONF_EMPTY = 40.0
CONF_WIDTH_WEIGHT = 35
CONF_WIDTH_CAP = 60
CONF_NO_BUDGET_PENALTY = 15
CONF_THIN_HISTORY_PENALTY = 10
CONF_THIN_HISTORY_ROWS = 10
CONF_MIN, CONF_MAX = 30, 95

# Insight texts.
SUBJECT_BLENDED = "overall blended marketing performance"
TREND_STABLE = "recent spend and revenue trends are relatively stable"
TREND_SPEND_UP = "recent spend is increasing faster than revenue, which may reduce efficiency"
TREND_REVENUE_UP = "recent revenue is improving faster than spend, which indicates positive momentum"
TREND_REVENUE_WEAK = "recent revenue momentum is weak compared with the previous 30-day baseline"


# --------------------------------------------------------------------------- scorers
def linear_rule_scorer(df: DataFrame) -> DataFrame:
    """Deterministic scorer from recent revenue run-rates.

    low = W*min(r7, r30, r90); mid = W*(0.5*r30 + 0.3*r90) + 0.1*future_budget;
    high = 1.1*W*max(r7, r30, r90), with r_k = hist_{k}d_revenue / k.  It is the
    scorer the SQL oracle can replay, and a baseline for the fitted model.
    """
    w = F.col("forecast_window_days")
    r = {k: F.col(f"hist_{k}d_revenue") / k for k in (7, 30, 90)}
    return df.withColumns({
        "raw_q10": w * F.least(r[7], r[30], r[90]),
        "raw_q50": w * (0.5 * r[30] + 0.3 * r[90]) + 0.1 * F.col("future_budget"),
        "raw_q90": w * F.greatest(r[7], r[30], r[90]) * 1.1,
    })


# --------------------------------------------------------------------------- steps
def monotone_quantiles(df: DataFrame) -> DataFrame:
    """Clip raw scores at 0 and sort (low, expected, high) within each row."""
    arr = F.array_sort(F.array(*[F.greatest(F.col(c).cast("double"), F.lit(0.0)) for c in RAW_Q]))
    return df.withColumn("_q", arr).withColumns(
        {name: F.col("_q")[i] for i, name in enumerate(REVENUE_COLS)}
    ).drop("_q", *RAW_Q)


def forecast_roas(df: DataFrame) -> DataFrame:
    return df.withColumns({r: safe_divide(v, "future_budget") for v, r in zip(REVENUE_COLS, ROAS_COLS)})


def confidence_score(low: Column, expected: Column, high: Column, budget: Column, hist_rows: Column) -> Column:
    base = F.lit(100.0) - F.least((high - low) / expected * CONF_WIDTH_WEIGHT, F.lit(float(CONF_WIDTH_CAP)))
    base = base - F.when(budget <= 0, F.lit(CONF_NO_BUDGET_PENALTY)).otherwise(0)
    base = base - F.when(hist_rows < CONF_THIN_HISTORY_ROWS, F.lit(CONF_THIN_HISTORY_PENALTY)).otherwise(0)
    clamped = F.greatest(F.lit(float(CONF_MIN)), F.least(F.lit(float(CONF_MAX)), base))
    return F.when(expected <= 0, F.lit(CONF_EMPTY)).otherwise(clamped).cast("double")


def _trend(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("double") if name in df.columns else F.lit(1.0)


def risk_level(roas: Column, confidence: Column, spend_trend: Column, revenue_trend: Column) -> Column:
    return (
        F.when((roas < 1) | (confidence < 45), F.lit("High"))
        .when((spend_trend > 1.3) & (revenue_trend < 0.9), F.lit("High"))
        .when((roas < 2) | (confidence < 65), F.lit("Medium"))
        .otherwise(F.lit("Low"))
    )


def trend_message(spend_trend: Column, revenue_trend: Column) -> Column:
    return (
        F.when((spend_trend > 1.2) & (revenue_trend < 1), F.lit(TREND_SPEND_UP))
        .when((revenue_trend > 1.2) & (spend_trend <= 1.2), F.lit(TREND_REVENUE_UP))
        .when(revenue_trend < 0.8, F.lit(TREND_REVENUE_WEAK))
        .otherwise(F.lit(TREND_STABLE))
    )


def insight_subject(level: Column, channel: Column, campaign_type: Column, campaign_name: Column) -> Column:
    ch, ct, nm = text_or(channel, NULL_TEXT), text_or(campaign_type, NULL_TEXT), text_or(campaign_name, NULL_TEXT)
    return (
        F.when(level == "campaign", F.concat(ch, F.lit(" campaign '"), nm, F.lit("'")))
        .when(level == "campaign_type", F.concat(ch, F.lit(" "), ct))
        .when(level == "blended", F.lit(SUBJECT_BLENDED))
        .otherwise(ch)
    )


def insight_summary(df: DataFrame) -> Column:
    st, rt = _trend(df, "spend_trend_7d_vs_30d"), _trend(df, "revenue_trend_7d_vs_30d")
    return F.concat(
        F.lit("For the next "), F.col("forecast_window_days").cast("int").cast("string"), F.lit(" days, "),
        insight_subject(F.col("forecast_level"), F.col("channel"), F.col("campaign_type"), F.col("campaign_name")),
        F.lit(" is forecasted with expected ROAS around "), fmt_fixed("roas_expected", 2),
        F.lit(". Risk level is "), text_or("risk_level", NULL_TEXT), F.lit(". The main reason is that "),
        trend_message(st, rt), F.lit("."),
    )


def add_forecast_columns(scored: DataFrame) -> DataFrame:
    """Raw quantiles -> sorted revenues, ROAS, confidence, risk, text; level=campaign."""
    df = forecast_roas(monotone_quantiles(scored))
    df = df.withColumn("forecast_level", F.lit("campaign"))
    df = df.withColumn("confidence_score", confidence_score(
        F.col("revenue_low"), F.col("revenue_expected"), F.col("revenue_high"),
        F.col("future_budget"), F.col("hist_30d_rows")))
    df = df.withColumn("risk_level", risk_level(
        F.col("roas_expected"), F.col("confidence_score"),
        _trend(df, "spend_trend_7d_vs_30d"), _trend(df, "revenue_trend_7d_vs_30d")))
    return df.withColumn("insight_summary", insight_summary(df))


def campaign_forecast(prediction: DataFrame, scorer: Scorer) -> DataFrame:
    return add_forecast_columns(scorer(prediction))
