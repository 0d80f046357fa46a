"""Multi-level roll-up of campaign forecasts and the final forecast table.

Campaigns are first summed up to (window, channel, type); one ``GROUPING SETS``
aggregate over that small result gives the channel, campaign-type and blended
levels, so the campaign rows are never expanded, with ``grouping_id`` telling a subtotal apart from a NULL campaign type.  Roll-ups add quantiles
(a sum of q10s, not the q10 of the sum), average confidence without weights
and take the worst risk of the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roasline.functions import add_parts, exact_sum_parts, parts_value, round_half_even, safe_divide, text_or
from roasline.operators.scoring import NULL_TEXT, REVENUE_COLS, ROAS_COLS, insight_summary

# Final table layout.
OUTPUT_COLUMNS = [
    "forecast_id", "forecast_level", "channel", "campaign_type", "campaign_id", "campaign_name",
    "forecast_window_days", "forecast_start_date", "forecast_end_date", "future_budget",
    "revenue_low", "revenue_expected", "revenue_high", "roas_low", "roas_expected", "roas_high",
    "confidence_score", "risk_level", "insight_summary",
]
ROUNDED_COLUMNS = ["future_budget", "revenue_low", "revenue_expected", "revenue_high",
                   "roas_low", "roas_expected", "roas_high", "confidence_score"]
LEVEL_ORDER = ["blended", "channel", "campaign_type", "campaign"]
ALL = "ALL"


def _risk_rank() -> Column:
    return F.when(F.col("risk_level") == "High", 2).when(F.col("risk_level") == "Medium", 1).otherwise(0)


def rollup_levels(cf: DataFrame, extra_keys: list[str] | None = None) -> DataFrame:
    """Channel, campaign-type and blended rows from campaign forecasts."""
    extra = list(extra_keys or [])
    w = [*extra, "forecast_window_days"]
    sets = [w, [*w, "channel"], [*w, "channel", "campaign_type"]]
    summed = ["future_budget", *REVENUE_COLS, "confidence_score"]
    first = F.struct("channel", "campaign_id", "campaign_name", "campaign_type", "forecast_start_date",
                     "forecast_end_date")
    types = cf.groupBy(*w, "channel", "campaign_type").agg(
        *exact_sum_parts({c: c for c in summed}),
        F.count("confidence_score").alias("_scored"),
        F.max(_risk_rank()).alias("_risk"),
        F.min(first).alias("_first"),
    )
    g = types.groupingSets(sets, *w, "channel", "campaign_type").agg(
        (F.grouping("channel") * 2 + F.grouping("campaign_type")).alias("_gid"),
        *add_parts(summed),
        F.sum("_scored").alias("_scored"),
        F.max("_risk").alias("_risk"),
        F.min("_first").alias("_first"),
    )
    g = g.withColumns({c: parts_value(c) for c in summed})
    g = g.withColumn("confidence_score", F.try_divide("confidence_score", F.col("_scored").cast("double")))
    level = F.when(F.col("_gid") == 0, "campaign_type").when(F.col("_gid") == 1, "channel").otherwise("blended")
    g = g.withColumn("forecast_level", level).withColumns({
        "channel": F.when(F.col("forecast_level") == "blended", F.lit(ALL)).otherwise(F.col("channel")),
        "campaign_type": F.when(F.col("forecast_level") == "campaign_type", F.col("campaign_type"))
        .otherwise(F.lit(ALL)),
        "campaign_id": F.lit(ALL),
        "campaign_name": F.lit(ALL),
        "risk_level": F.when(F.col("_risk") == 2, "High").when(F.col("_risk") == 1, "Medium").otherwise("Low"),
        "forecast_start_date": F.col("_first.forecast_start_date"),
        "forecast_end_date": F.col("_first.forecast_end_date"),
    })
    g = g.withColumns({r: safe_divide(v, "future_budget") for v, r in zip(REVENUE_COLS, ROAS_COLS)})
    g = g.withColumn("forecast_id", F.concat_ws(
        "_", F.col("forecast_level"), text_or("channel", NULL_TEXT), text_or("campaign_type", NULL_TEXT),
        F.col("forecast_window_days").cast("string")))
    g = g.withColumn("insight_summary", insight_summary(g))
    return g.select(*extra, *OUTPUT_COLUMNS)


def level(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("forecast_level") == name)


def forecast_table(cf: DataFrame, extra_keys: list[str] | None = None) -> DataFrame:
    """All four levels in the 19-column layout; numerics NULL->0, rounded half-even to 4."""
    extra = list(extra_keys or [])
    campaign = cf.select(*extra, *OUTPUT_COLUMNS)
    out = rollup_levels(cf, extra).unionByName(campaign)
    return out.withColumns({c: round_half_even(F.coalesce(F.col(c), F.lit(0.0)), 4) for c in ROUNDED_COLUMNS}) \
              .withColumn("forecast_window_days", F.col("forecast_window_days").cast("int"))


def sort_forecast(df: DataFrame) -> DataFrame:
    """Presentation order of the forecast table (for a sink)."""
    return df.orderBy("forecast_window_days", "forecast_level", "channel", "campaign_type", "campaign_id")


def level_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("forecast_level").agg(F.count(F.lit(1)).alias("rows"))


def level_order(c: Column | str = "forecast_level") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    out = F.lit(len(LEVEL_ORDER))
    for i, name in reversed(list(enumerate(LEVEL_ORDER))):
        out = F.when(c == name, F.lit(i)).otherwise(out)
    return out
