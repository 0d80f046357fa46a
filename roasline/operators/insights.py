"""Explanations, rankings and report tables over the forecast table.

Everything is a filter, a projection with text columns, a per-window
``row_number`` (Spark plans a ``WindowGroupLimit`` under it) or an ordered
``limit`` (``TakeOrderedAndProject``); no row leaves the executors except the
k rows a top-k report asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roasline.functions import clean_numeric, fmt_fixed, money, parts_value, round_decimal, sum_parts
from roasline.operators.rollup import level_order

# The read-back contract of the forecast table.
REQUIRED_COLUMNS = ["forecast_level", "channel", "campaign_type", "campaign_id", "campaign_name",
                    "forecast_window_days", "future_budget", "revenue_low", "revenue_expected", "revenue_high",
                    "roas_low", "roas_expected", "roas_high", "confidence_score", "risk_level"]
NUMERIC_COLUMNS = ["forecast_window_days", "future_budget", "revenue_low", "revenue_expected", "revenue_high",
                   "roas_low", "roas_expected", "roas_high", "confidence_score"]
TEXT_COLUMNS = ["forecast_level", "channel", "campaign_type", "campaign_id", "campaign_name", "risk_level"]
SCENARIO_NUMERIC_COLUMNS = ["forecast_window_days", "baseline_budget", "scenario_budget", "budget_change",
                            "budget_change_percent", "baseline_revenue_expected", "scenario_revenue_expected",
                            "revenue_change", "revenue_change_percent", "baseline_roas_expected",
                            "scenario_roas_expected", "roas_change"]
UNKNOWN = "Unknown"

# Explanation texts.
RISK_HIGH_ROAS = ("Risk is high because expected ROAS is below 1.00x, meaning the forecasted "
                  "revenue may not justify the planned budget.")
RISK_HIGH_CONF = ("Risk is high because forecast confidence is weak. The campaign may have "
                  "unstable historical behavior or wide prediction uncertainty.")
RISK_HIGH_WIDE = ("Risk is high because the forecast range is wide, which means the outcome "
                  "is less predictable.")
RISK_HIGH_OTHER = ("Risk is high because performance signals suggest the campaign may not scale "
                   "efficiently under the current forecast assumptions.")
RISK_MEDIUM = ("Risk is medium because the forecast is usable, but efficiency or confidence "
               "should be monitored before making aggressive budget changes.")
RISK_LOW = "Risk is low because forecast confidence and expected ROAS are relatively stable."
ACT_HIGH_ROAS = ("Avoid scaling this segment immediately. Review campaign structure, targeting, "
                 "creative quality, landing page relevance, and tracking accuracy before adding budget.")
ACT_HIGH = ("Do not scale aggressively. Keep budget controlled, monitor daily performance, "
            "and test improvements before increasing spend.")
ACT_MEDIUM_SCALE = "Scale cautiously with a small budget increase and monitor ROAS movement closely."
ACT_MEDIUM = "Maintain or slightly reduce budget until revenue efficiency becomes more consistent."
ACT_LOW_SCALE = ("This segment is a good candidate for controlled scaling because expected ROAS "
                 "and confidence are healthy.")
ACT_LOW = ("Maintain current budget and continue monitoring. Scaling can be considered after "
           "more stable performance is observed.")
SCN_POSITIVE = "This scenario is attractive because it improves expected revenue without reducing ROAS."
SCN_GROWTH = ("This scenario can grow revenue, but the agency should watch efficiency because ROAS is "
              "expected to decline.")
SCN_EFFICIENCY = "This scenario may improve efficiency, but it may limit revenue scale."
SCN_WEAK = "This scenario does not look attractive because both revenue and efficiency may weaken."
HIGH_RISK_LINE = "- There are **%d high-risk forecast rows**. These should be reviewed before budget scaling."
MEDIUM_RISK_LINE = "- There are **%d medium-risk forecast rows**. These can be monitored with controlled budget movement."
BEST_WINDOW_LINE = "- The strongest blended ROAS appears in the **%d-day forecast** with expected ROAS of **"
SUBJECT_OVERALL = "overall marketing performance"


# --------------------------------------------------------------------------- contracts
def forecast_contract(df: DataFrame) -> DataFrame:
    """Check the 15 required columns; numerics unparsable->0, text NULL->'Unknown'."""
    missing = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required prediction columns: {missing}")
    fixed = {c: clean_numeric(c, dtype=df.schema[c].dataType) for c in NUMERIC_COLUMNS}
    fixed["forecast_window_days"] = fixed["forecast_window_days"].cast("int")
    fixed.update({c: F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)) for c in TEXT_COLUMNS})
    return df.withColumns(fixed)


def scenario_contract(df: DataFrame) -> DataFrame:
    present = [c for c in SCENARIO_NUMERIC_COLUMNS if c in df.columns]
    fixed = {c: clean_numeric(c, dtype=df.schema[c].dataType) for c in present}
    if "forecast_window_days" in fixed:
        fixed["forecast_window_days"] = fixed["forecast_window_days"].cast("int")
    return df.withColumns(fixed)


# --------------------------------------------------------------------------- row rules
def level_window_slice(df: DataFrame, level: str | None = None, window: int | None = None) -> DataFrame:
    if level is not None:
        df = df.where(F.col("forecast_level") == level)
    if window is not None:
        df = df.where(F.col("forecast_window_days") == window)
    return df


def uncertainty_ratio() -> Column:
    e = F.col("revenue_expected")
    return F.when(e <= 0, F.lit(1.0)).otherwise((F.col("revenue_high") - F.col("revenue_low")) / e)


def risk_explanation() -> Column:
    risk, roas, conf = F.col("risk_level"), F.col("roas_expected"), F.col("confidence_score")
    high = (F.when(roas < 1, F.lit(RISK_HIGH_ROAS)).when(conf < 45, F.lit(RISK_HIGH_CONF))
            .when(uncertainty_ratio() > 0.8, F.lit(RISK_HIGH_WIDE)).otherwise(F.lit(RISK_HIGH_OTHER)))
    return F.when(risk == "High", high).when(risk == "Medium", F.lit(RISK_MEDIUM)).otherwise(F.lit(RISK_LOW))


def recommended_action() -> Column:
    risk, roas, conf = F.col("risk_level"), F.col("roas_expected"), F.col("confidence_score")
    return (
        F.when(risk == "High", F.when(roas < 1, F.lit(ACT_HIGH_ROAS)).otherwise(F.lit(ACT_HIGH)))
        .when(risk == "Medium", F.when((roas >= 2.5) & (conf >= 60), F.lit(ACT_MEDIUM_SCALE))
              .otherwise(F.lit(ACT_MEDIUM)))
        .when((roas >= 3) & (conf >= 70) & (uncertainty_ratio() < 0.7), F.lit(ACT_LOW_SCALE))
        .otherwise(F.lit(ACT_LOW))
    )


def risk_priority(c: Column | str = "risk_level") -> Column:
    low = F.lower(F.col(c) if isinstance(c, str) else c)
    return F.when(low == "high", 1).when(low == "medium", 2).otherwise(3)


def _x(c: str) -> Column:
    return F.concat(fmt_fixed(c, 2), F.lit("x"))


def insight_subject() -> Column:
    lvl = F.col("forecast_level")
    return (
        F.when(lvl == "blended", F.lit(SUBJECT_OVERALL))
        .when(lvl == "channel", F.col("channel"))
        .when(lvl == "campaign_type", F.concat(F.col("channel"), F.lit(" - "), F.col("campaign_type")))
        .otherwise(F.concat(F.col("channel"), F.lit(" campaign '"), F.col("campaign_name"), F.lit("'")))
    )


INSIGHT_COLUMNS = ["priority", "forecast_window_days", "forecast_level", "channel", "campaign_type", "campaign_id",
                   "campaign_name", "risk_level", "confidence_score", "revenue_expected", "roas_expected",
                   "insight", "recommended_action"]


def insights_table(fc: DataFrame) -> DataFrame:
    """One insight row per forecast row of the four levels."""
    df = fc.where(F.col("forecast_level").isin("blended", "channel", "campaign_type", "campaign"))
    insight = F.concat(
        F.lit("For the next "), F.col("forecast_window_days").cast("int").cast("string"), F.lit(" days, "),
        insight_subject(), F.lit(" is forecasted to generate "), money("revenue_expected"),
        F.lit(" revenue with expected ROAS of "), _x("roas_expected"), F.lit(". "), risk_explanation(),
    )
    return df.select(
        risk_priority().alias("priority"),
        F.col("forecast_window_days").cast("int").alias("forecast_window_days"),
        "forecast_level", "channel", "campaign_type", "campaign_id", "campaign_name", "risk_level",
        round_decimal("confidence_score", 2).alias("confidence_score"),
        round_decimal("revenue_expected", 2).alias("revenue_expected"),
        round_decimal("roas_expected", 4).alias("roas_expected"),
        insight.alias("insight"),
        recommended_action().alias("recommended_action"),
    )


def sort_insights(df: DataFrame) -> DataFrame:
    """Window up, priority up, revenue down; ties in level order, then keys."""
    return df.orderBy("forecast_window_days", "priority", F.col("revenue_expected").desc(),
                      level_order(), "channel", "campaign_type", "campaign_id")


# --------------------------------------------------------------------------- report tables
def executive_summary(fc: DataFrame) -> DataFrame:
    b = fc.where(F.col("forecast_level") == "blended")
    return b.select(
        F.col("forecast_window_days").cast("int").alias("forecast_window_days"),
        money("future_budget").alias("planned_budget"),
        F.concat(F.lit("Expected revenue is "), money("revenue_expected"), F.lit(", with a probable range between "),
                 money("revenue_low"), F.lit(" and "), money("revenue_high"), F.lit(".")).alias("revenue_range"),
        F.concat(F.lit("Expected ROAS is "), _x("roas_expected"), F.lit(", with a range between "),
                 _x("roas_low"), F.lit(" and "), _x("roas_high"), F.lit(".")).alias("roas_range"),
        F.concat(fmt_fixed("confidence_score", 2), F.lit("/100")).alias("confidence"),
        "risk_level",
        risk_explanation().alias("interpretation"),
        recommended_action().alias("recommended_action"),
    )


def channel_leaderboard(fc: DataFrame) -> DataFrame:
    """Channels of each window ranked by expected revenue (descending)."""
    w = Window.partitionBy("forecast_window_days").orderBy(F.col("revenue_expected").desc(), "channel")
    c = fc.where(F.col("forecast_level") == "channel")
    return c.select(
        F.col("forecast_window_days").cast("int").alias("forecast_window_days"),
        F.row_number().over(w).alias("rank"), "channel",
        money("future_budget").alias("budget"), money("revenue_expected").alias("expected_revenue"),
        _x("roas_expected").alias("expected_roas"), "risk_level",
        fmt_fixed("confidence_score", 2).alias("confidence"),
    )


def best_roas_channel(fc: DataFrame) -> DataFrame:
    """Top channel by expected ROAS per window (ties: channel name)."""
    w = Window.partitionBy("forecast_window_days").orderBy(F.col("roas_expected").desc(), "channel")
    c = fc.where(F.col("forecast_level") == "channel").withColumn("_rn", F.row_number().over(w))
    return c.where(F.col("_rn") == 1).select(
        F.col("forecast_window_days").cast("int").alias("forecast_window_days"), "channel", "roas_expected",
        F.concat(F.lit("**Best efficiency signal:** "), F.col("channel"),
                 F.lit(" has the strongest expected ROAS at "), _x("roas_expected"), F.lit(".")).alias("message"),
    )


def top_campaign_types(fc: DataFrame, k: int = 10) -> DataFrame:
    """Top-k campaign types by expected revenue in each window."""
    w = Window.partitionBy("forecast_window_days").orderBy(F.col("revenue_expected").desc(), "channel",
                                                           "campaign_type")
    c = fc.where(F.col("forecast_level") == "campaign_type").withColumn("rank", F.row_number().over(w))
    return c.where(F.col("rank") <= k).select(
        F.col("forecast_window_days").cast("int").alias("forecast_window_days"), "rank", "channel",
        "campaign_type", money("revenue_expected").alias("expected_revenue"),
        _x("roas_expected").alias("expected_roas"), "risk_level",
    )


def _campaign_report_cols() -> list[Column]:
    return [
        "risk_level", "channel", "campaign_id", "campaign_name",
        F.col("forecast_window_days").cast("int").alias("forecast_window_days"),
        money("revenue_expected").alias("expected_revenue"), _x("roas_expected").alias("expected_roas"),
        fmt_fixed("confidence_score", 2).alias("confidence"), recommended_action().alias("recommended_action"),
    ]


def risk_watchlist(fc: DataFrame, k: int = 15) -> DataFrame:
    """High/Medium campaign rows, priority up then revenue down; global top k."""
    c = fc.where((F.col("forecast_level") == "campaign") & F.col("risk_level").isin("High", "Medium"))
    c = c.withColumn("priority", risk_priority())
    top = c.orderBy("priority", F.col("revenue_expected").desc(), "forecast_window_days", "channel",
                    "campaign_id", "campaign_name").limit(k)
    return top.select("priority", *_campaign_report_cols())


def scaling_candidates(fc: DataFrame, k: int = 15) -> DataFrame:
    """Low-risk campaigns with ROAS >= 3 and confidence >= 65; top k by window, ROAS, revenue."""
    c = fc.where((F.col("forecast_level") == "campaign") & (F.col("risk_level") == "Low")
                 & (F.col("roas_expected") >= 3) & (F.col("confidence_score") >= 65))
    top = c.orderBy("forecast_window_days", F.col("roas_expected").desc(), F.col("revenue_expected").desc(),
                    "channel", "campaign_id", "campaign_name").limit(k)
    return top.select(*_campaign_report_cols())


def _top_per_window(rows: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """The first k rows of each window with their rank (WindowGroupLimit keeps k rows a task before the shuffle)."""
    w = Window.partitionBy("forecast_window_days").orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


WINDOW_COLUMNS = ["forecast_window_days", "rank", "channel", "campaign_type"]


def window_campaign_types(fc: DataFrame, k: int = 20) -> DataFrame:
    """Top k campaign types of each window by expected revenue, with figures as numbers."""
    top = _top_per_window(fc.where(F.col("forecast_level") == "campaign_type"), k,
                          F.col("revenue_expected").desc(), "channel", "campaign_type")
    return top.select(*WINDOW_COLUMNS, "future_budget", "revenue_expected", "revenue_low", "revenue_high",
                      "roas_expected", "confidence_score", "risk_level")


def window_watchlist(fc: DataFrame, levels: tuple[str, ...] = ("High", "Medium"), k: int = 50) -> DataFrame:
    """Campaigns of the chosen risk levels, k for each window: by level name, then revenue down."""
    c = fc.where((F.col("forecast_level") == "campaign") & F.col("risk_level").isin(*levels))
    top = _top_per_window(c, k, "risk_level", F.col("revenue_expected").desc(), "channel", "campaign_id", "campaign_name")
    return top.select(*WINDOW_COLUMNS, "campaign_name", "future_budget", "revenue_expected", "roas_expected",
                      "confidence_score", "risk_level", "insight_summary")


def window_scaling(fc: DataFrame, k: int = 30, min_roas: float = 3, min_confidence: float = 65) -> DataFrame:
    """Low-risk campaigns worth scaling, k for each window: by ROAS down, then revenue down."""
    c = fc.where((F.col("forecast_level") == "campaign") & (F.col("risk_level") == "Low")
                 & (F.col("roas_expected") >= min_roas) & (F.col("confidence_score") >= min_confidence))
    top = _top_per_window(c, k, F.col("roas_expected").desc(), F.col("revenue_expected").desc(),
                          "channel", "campaign_id", "campaign_name")
    return top.select(*WINDOW_COLUMNS, "campaign_name", "future_budget", "revenue_expected", "roas_expected",
                      "confidence_score", "risk_level")


def portfolio_summary(fc: DataFrame) -> DataFrame:
    """Mean confidence over all rows, High/Medium row counts, best blended window, and their lines (null: no such line)."""
    blended = F.col("forecast_level") == "blended"
    g = fc.agg(
        *sum_parts("confidence_score", "confidence"), F.count("confidence_score").alias("_scored"),
        F.count_if(F.col("risk_level") == "High").alias("high_risk_rows"),
        F.count_if(F.col("risk_level") == "Medium").alias("medium_risk_rows"),
        F.max_by(F.when(blended, F.struct(F.col("forecast_window_days").cast("int").alias("w"),
                                          F.col("roas_expected").alias("r"))),
                 F.when(blended, F.struct(F.col("roas_expected"), -F.col("forecast_window_days")))).alias("_b"),
    )
    g = g.withColumn("avg_confidence", F.try_divide(parts_value("confidence"), F.col("_scored").cast("double")))
    return g.select(
        F.coalesce(F.col("avg_confidence"), F.lit(0.0)).alias("avg_confidence"),
        "high_risk_rows", "medium_risk_rows",
        F.col("_b.w").alias("best_blended_window"), F.col("_b.r").alias("best_blended_roas"),
        F.concat(F.lit("- Overall forecast confidence across all forecast rows is **"),
                 fmt_fixed(F.coalesce(F.col("avg_confidence"), F.lit(0.0)), 2), F.lit("/100**.")).alias("confidence_line"),
        F.when(F.col("high_risk_rows") > 0, F.format_string(HIGH_RISK_LINE, "high_risk_rows")).alias("high_risk_line"),
        F.when(F.col("medium_risk_rows") > 0, F.format_string(MEDIUM_RISK_LINE, "medium_risk_rows")).alias("medium_risk_line"),
        F.when(F.col("_b").isNotNull(), F.concat(
            F.format_string(BEST_WINDOW_LINE, "_b.w"), _x("_b.r"), F.lit("**."))).alias("best_window_line"),
    )


def scenario_interpretation(comparison: DataFrame) -> DataFrame:
    """Blended scenario rows with the report's interpretation wording."""
    rc, roc = F.col("revenue_change"), F.col("roas_change")
    text = (F.when((rc > 0) & (roc >= 0), F.lit(SCN_POSITIVE)).when((rc > 0) & (roc < 0), F.lit(SCN_GROWTH))
            .when((rc <= 0) & (roc > 0), F.lit(SCN_EFFICIENCY)).otherwise(F.lit(SCN_WEAK)))
    b = comparison.where(F.col("forecast_level") == "blended")
    return b.select(
        "scenario_id", F.col("forecast_window_days").cast("int").alias("forecast_window_days"),
        money("baseline_budget").alias("baseline_budget"), money("scenario_budget").alias("scenario_budget"),
        F.concat(money("budget_change"), F.lit(" ("), fmt_fixed("budget_change_percent", 2), F.lit("%)"))
        .alias("budget_change"),
        F.concat(money("revenue_change"), F.lit(" ("), fmt_fixed("revenue_change_percent", 2), F.lit("%)"))
        .alias("revenue_change"),
        F.concat(fmt_fixed("roas_change", 2), F.lit("x")).alias("roas_change"),
        text.alias("interpretation"),
    )
