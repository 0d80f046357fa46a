"""Normalisation: three platform exports -> one unified daily campaign table.

All functions are narrow projections (no shuffle).  Column choices that depend
on which columns an export has are made while the plan is built, from
``df.columns``; the data itself is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roasline.functions import clean_numeric, first_existing, parse_date, divide_sql

# The unified schema, in order.
UNIFIED_COLUMNS = [
    "date", "channel", "campaign_id", "campaign_name", "campaign_type",
    "daily_budget", "spend", "clicks", "impressions", "conversions", "revenue",
    "ctr", "cpc", "cpm", "conversion_rate", "roas",
]
GROUP_KEYS = ["channel", "campaign_id", "campaign_name", "campaign_type"]
MEASURES = ["daily_budget", "spend", "clicks", "impressions", "conversions", "revenue"]
RATES = ["ctr", "cpc", "cpm", "conversion_rate", "roas"]

# Channel labels.
GOOGLE = "Google Ads"
MICROSOFT = "Microsoft Ads"
META = "Meta Ads"

# Google budget columns, first one present wins.
GOOGLE_BUDGET_COLUMNS = [
    "campaign_budget_amount",
    "campaign_budget_amount_micros",
    "campaign_budget",
    "campaign_budget_amount_local",
]

# Meta campaign-type keywords (checked in this order).
META_REMARKETING_WORDS = ("remarketing", "retarget")
META_PROSPECTING_WORDS = ("prospecting", "dpa")

UNIFIED_SCHEMA = T.StructType(
    [T.StructField("date", T.DateType())]
    + [T.StructField(c, T.StringType()) for c in GROUP_KEYS]
    + [T.StructField(c, T.DoubleType()) for c in MEASURES + RATES]
)


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def _num(df: DataFrame, name: str) -> Column:
    return clean_numeric(name, dtype=_dtype(df, name))


def _date(df: DataFrame, name: str) -> Column:
    return parse_date(name, dtype=_dtype(df, name))


def _text(name: str, null_label: str | None) -> Column:
    c = F.col(name).cast("string")
    return c if null_label is None else F.coalesce(c, F.lit(null_label))


def meta_campaign_type(name: Column | str) -> Column:
    """Campaign type of a Meta campaign from its name (remarketing words first)."""
    low = F.lower(F.col(name) if isinstance(name, str) else name)
    remarketing = None
    for w in META_REMARKETING_WORDS:
        remarketing = low.contains(w) if remarketing is None else remarketing | low.contains(w)
    prospecting = None
    for w in META_PROSPECTING_WORDS:
        prospecting = low.contains(w) if prospecting is None else prospecting | low.contains(w)
    return (
        F.when(remarketing, F.lit("Remarketing"))
        .when(prospecting, F.lit("Prospecting"))
        .otherwise(F.lit("Generic"))
    )


def rate_metrics(df: DataFrame) -> DataFrame:
    """ctr, cpc, cpm, conversion_rate and roas; bad quotients become 0."""
    texts = {
        "ctr": divide_sql("clicks", "impressions", clean_inf=True),
        "cpc": divide_sql("spend", "clicks", clean_inf=True),
        "cpm": f"({divide_sql('spend', 'impressions', clean_inf=True)}) * 1000D",
        "conversion_rate": divide_sql("conversions", "clicks", clean_inf=True),
        "roas": divide_sql("revenue", "spend", clean_inf=True),
    }
    return df.withColumns({name: F.expr(text) for name, text in texts.items()})


def _finish(df: DataFrame) -> DataFrame:
    return rate_metrics(df).select(*UNIFIED_COLUMNS)


def normalize_google(raw: DataFrame, scale_budget_micros: bool = False, null_label: str | None = None) -> DataFrame:
    """Google Ads export -> unified rows.

    Budget comes from the first budget column present, else 0.0.  A budget in
    micros is taken as is unless ``scale_budget_micros`` is set.
    """
    budget_col = first_existing(raw.columns, GOOGLE_BUDGET_COLUMNS)
    if budget_col is None:
        budget = F.lit(0.0)
    else:
        budget = _num(raw, budget_col)
        if scale_budget_micros and budget_col.endswith("_micros"):
            budget = budget / F.lit(1_000_000.0)
    out = raw.select(
        _date(raw, "segments_date").alias("date"),
        F.lit(GOOGLE).alias("channel"),
        _text("campaign_id", null_label).alias("campaign_id"),
        _text("campaign_name", null_label).alias("campaign_name"),
        _text("campaign_advertising_channel_type", null_label).alias("campaign_type"),
        budget.alias("daily_budget"),
        (_num(raw, "metrics_cost_micros") / F.lit(1_000_000.0)).alias("spend"),
        _num(raw, "metrics_clicks").alias("clicks"),
        _num(raw, "metrics_impressions").alias("impressions"),
        _num(raw, "metrics_conversions").alias("conversions"),
        _num(raw, "metrics_conversions_value").alias("revenue"),
    )
    return _finish(out)


def normalize_bing(raw: DataFrame, null_label: str | None = None) -> DataFrame:
    """Microsoft (Bing) Ads export -> unified rows."""
    out = raw.select(
        _date(raw, "TimePeriod").alias("date"),
        F.lit(MICROSOFT).alias("channel"),
        _text("CampaignId", null_label).alias("campaign_id"),
        _text("CampaignName", null_label).alias("campaign_name"),
        _text("CampaignType", null_label).alias("campaign_type"),
        _num(raw, "DailyBudget").alias("daily_budget"),
        _num(raw, "Spend").alias("spend"),
        _num(raw, "Clicks").alias("clicks"),
        _num(raw, "Impressions").alias("impressions"),
        _num(raw, "Conversions").alias("conversions"),
        _num(raw, "Revenue").alias("revenue"),
    )
    return _finish(out)


def normalize_meta(raw: DataFrame, null_label: str | None = None) -> DataFrame:
    """Meta Ads export -> unified rows.

    The export's ``conversion`` column holds conversion value, so it becomes
    revenue and the conversion count is 0.0.
    """
    out = raw.select(
        _date(raw, "date_start").alias("date"),
        F.lit(META).alias("channel"),
        _text("campaign_id", null_label).alias("campaign_id"),
        _text("campaign_name", null_label).alias("campaign_name"),
        meta_campaign_type("campaign_name").alias("campaign_type"),
        _num(raw, "daily_budget").alias("daily_budget"),
        _num(raw, "spend").alias("spend"),
        _num(raw, "clicks").alias("clicks"),
        _num(raw, "impressions").alias("impressions"),
        F.lit(0.0).alias("conversions"),
        _num(raw, "conversion").alias("revenue"),
    )
    return _finish(out)


NORMALIZERS = {"google": normalize_google, "bing": normalize_bing, "meta": normalize_meta}


def unify(google: DataFrame, bing: DataFrame, meta: DataFrame) -> DataFrame:
    """Union of the three normalised platforms (UNION ALL, no shuffle).

    The presentation order (date, channel, campaign_id; undated last) belongs
    to a sink: see ``sort_unified``.
    """
    return google.unionByName(bing).unionByName(meta)


def normalize_all(raw: dict[str, DataFrame], **options) -> DataFrame:
    google_opts = {k: v for k, v in options.items() if k in ("scale_budget_micros", "null_label")}
    other_opts = {k: v for k, v in options.items() if k == "null_label"}
    return unify(
        normalize_google(raw["google"], **google_opts),
        normalize_bing(raw["bing"], **other_opts),
        normalize_meta(raw["meta"], **other_opts),
    )


def sort_unified(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("date").asc_nulls_last(), "channel", "campaign_id")


def dated_rows(df: DataFrame) -> DataFrame:
    """Rows with a usable date (pushed into the scan side by Catalyst)."""
    return df.where(F.col("date").isNotNull())
