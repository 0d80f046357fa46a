"""Data-quality audit of the unified table.

One scan: where duplicate keys are asked for, the counters ride on the keyed aggregate that finds
them and are folded afterwards; a single other check counts only what it needs, without a keyed
shuffle.  Everything is returned as a long table

    (ord, check_name, column_name, value, message)

``message`` holds the observation text when the audit reports it and is NULL
otherwise, so ``quality_report`` is a filter of the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roasline.operators.normalize import UNIFIED_COLUMNS

# Column lists of the audit.
REQUIRED_COLUMNS = list(UNIFIED_COLUMNS)
MISSING_CHECK_COLUMNS = ["date", "channel", "campaign_id", "campaign_name", "campaign_type", "spend", "revenue"]
NEGATIVE_CHECK_COLUMNS = [
    "daily_budget", "spend", "clicks", "impressions", "conversions", "revenue",
    "ctr", "cpc", "cpm", "conversion_rate", "roas",
]
DUPLICATE_KEYS = ["date", "channel", "campaign_id"]
ZERO_CHECKS = [("spend", "Zero spend rows"), ("revenue", "Zero revenue rows"),
               ("clicks", "Zero click rows"), ("impressions", "Zero impression rows")]
ROAS_OUTLIER_THRESHOLD = 100

# Message texts.
MSG_DUPLICATES = ("Duplicate campaign-date rows found: {n}. "
                  "This may happen if platform exports contain repeated daily campaign records.")
MSG_ROAS_NONE = "ROAS could not be calculated for any row"
MSG_ROAS_EXTREME = ("Extreme ROAS rows found: {n}. "
                    "These rows may be valid, but should be handled carefully during modeling.")
MSG_NO_DATE = "date column is missing"

REPORT_SCHEMA = "ord int, check_name string, column_name string, value bigint, message string"


def _is_missing(df: DataFrame, c: str) -> Column:
    cond = F.col(c).isNull()
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        cond = cond | F.isnan(c)
    return cond


def _finite(c: str) -> Column:
    x = F.col(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def _fmt(template: str, n: Column) -> Column:
    head, tail = template.split("{n}")
    return F.concat(F.lit(head), n.cast("string"), F.lit(tail))


def _row(ord_: int, check: str, column: str | None, value: Column, message: Column) -> Column:
    return F.struct(
        F.lit(ord_).alias("ord"),
        F.lit(check).alias("check_name"),
        F.lit(column).cast("string").alias("column_name"),
        value.cast("bigint").alias("value"),
        message.cast("string").alias("message"),
    )


def _py_list(names: list[str]) -> str:
    return "[" + ", ".join(repr(n) for n in names) + "]"


CHECKS = ("required_columns", "missing_values", "negative_values", "invalid_dates", "duplicates",
          "zero_activity", "roas_outliers")


def _counters(df: DataFrame, checks) -> dict[str, Column]:
    """The counters that ``checks`` need, over the columns that ``df`` has."""
    cols = set(df.columns)
    aggs: dict[str, Column] = {"_rows": F.count(F.lit(1))}
    if "missing_values" in checks:
        aggs |= {f"miss_{c}": F.count_if(_is_missing(df, c)) for c in MISSING_CHECK_COLUMNS if c in cols}
    if "negative_values" in checks:
        aggs |= {f"neg_{c}": F.count_if(F.col(c) < 0) for c in NEGATIVE_CHECK_COLUMNS if c in cols}
    if "invalid_dates" in checks and "date" in cols:
        aggs["bad_date"] = F.count_if(F.col("date").isNull())
    if "zero_activity" in checks:
        aggs |= {f"zero_{c}": F.count_if(F.col(c) == 0) for c, _ in ZERO_CHECKS if c in cols}
    if "roas_outliers" in checks and "roas" in cols:
        aggs["roas_valid"] = F.count_if(_finite("roas"))
        aggs["roas_extreme"] = F.count_if(_finite("roas") & (F.col("roas") > ROAS_OUTLIER_THRESHOLD))
    return aggs


def quality_checks(df: DataFrame, checks=CHECKS) -> DataFrame:
    """The named checks as one long table.

    Duplicates are the rows beyond the first of a key (NULL keys group together).  Counts combine
    map-side, so a hot key ships one row per map task.
    """
    cols = set(df.columns)
    aggs = _counters(df, checks)
    has_dup_keys = "duplicates" in checks and all(k in cols for k in DUPLICATE_KEYS)
    if has_dup_keys:
        keyed = df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in DUPLICATE_KEYS]).agg(
            *[v.alias(k) for k, v in aggs.items()])
        counts = keyed.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in aggs],
                           F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicates"))
    else:
        counts = df.agg(*[v.alias(k) for k, v in aggs.items()])

    rows: list[Column] = []
    missing_required = [c for c in REQUIRED_COLUMNS if c not in cols]
    if "required_columns" in checks:
        rows.append(_row(0, "required_columns", None, F.lit(len(missing_required)),
                         F.lit(f"Missing required columns: {_py_list(missing_required)}" if missing_required else None)))
    for i, c in enumerate(MISSING_CHECK_COLUMNS):
        if f"miss_{c}" in aggs:
            n = F.col(f"miss_{c}")
            rows.append(_row(10 + i, "missing_values", c, n,
                             F.when(n > 0, F.concat(F.lit(f"{c}: "), n.cast("string"), F.lit(" missing values")))))
    for i, c in enumerate(NEGATIVE_CHECK_COLUMNS):
        if f"neg_{c}" in aggs:
            n = F.col(f"neg_{c}")
            rows.append(_row(30 + i, "negative_values", c, n,
                             F.when(n > 0, F.concat(F.lit(f"{c}: "), n.cast("string"), F.lit(" negative values found")))))
    if "bad_date" in aggs:
        n = F.col("bad_date")
        rows.append(_row(50, "invalid_dates", "date", n,
                         F.when(n > 0, F.concat(F.lit("date: "), n.cast("string"), F.lit(" invalid or missing dates")))))
    elif "invalid_dates" in checks:
        rows.append(_row(50, "invalid_dates", "date", F.lit(None), F.lit(MSG_NO_DATE)))
    for i, (c, label) in enumerate(ZERO_CHECKS):
        if f"zero_{c}" in aggs:
            n = F.col(f"zero_{c}")
            rows.append(_row(70 + i, "zero_activity", c, n, F.concat(F.lit(f"{label}: "), n.cast("string"))))
    if "roas_extreme" in aggs:
        n = F.col("roas_extreme")
        rows.append(_row(80, "roas_outliers", "roas", n,
                         F.when(F.col("roas_valid") == 0, F.lit(MSG_ROAS_NONE))
                         .when(n > 0, _fmt(MSG_ROAS_EXTREME, n))))
    if has_dup_keys:
        n = F.col("duplicates")
        rows.append(_row(60, "duplicates", ",".join(DUPLICATE_KEYS), n, F.when(n > 0, _fmt(MSG_DUPLICATES, n))))
    return counts.select(F.inline(F.array(*rows)))


def quality_report(df: DataFrame) -> DataFrame:
    """The reported observations only, in audit order (``ord``)."""
    return quality_checks(df).where(F.col("message").isNotNull())


def check(df: DataFrame, name: str) -> DataFrame:
    if name not in CHECKS:
        raise ValueError(f"unknown check {name}; known: {CHECKS}")
    return quality_checks(df, (name,))


def quality_profile(df: DataFrame, approx_campaigns: bool = False) -> DataFrame:
    """Rows, columns, date range, sorted channels and distinct campaign ids."""
    cols = set(df.columns)
    distinct = F.approx_count_distinct if approx_campaigns else F.count_distinct
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("total_columns"),
        (F.min("date") if "date" in cols else F.lit(None).cast("date")).alias("date_min"),
        (F.max("date") if "date" in cols else F.lit(None).cast("date")).alias("date_max"),
        (F.array_join(F.array_sort(F.collect_set("channel")), ", ") if "channel" in cols else F.lit("")).alias("channels"),
        (distinct("campaign_id").cast("bigint") if "campaign_id" in cols else F.lit(0).cast("bigint")).alias("campaign_count"),
    )
