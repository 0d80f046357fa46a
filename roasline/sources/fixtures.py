"""Raw platform exports derived from the shared test tables.

The test data is a TPC-H-like star schema, not ad-platform exports.  These views
turn ``lineitem ⋈ supplier ⋈ nation`` into three daily campaign exports with the
column names of each platform (campaign = supplier; platform = supplier key mod
3) and plant dirty values on purpose (bad dates, unparsable clicks, zero
impressions, negative revenue, extreme ROAS, missing campaign types).

The SQL text is the single source for both engines: Spark runs it through
``spark.sql`` with DataFrame parameters, the DuckDB oracle pastes it into CTEs.
Money stays DECIMAL until it becomes text so both engines produce the same
strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("lineitem", "supplier", "nation")

FX_BASE = """
SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, n_name,
       CAST(l_suppkey AS STRING) AS cid,
       CASE WHEN l_orderkey % 997 = 0 THEN 'not-a-date' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS dt,
       CASE WHEN l_orderkey % 50 = 7 THEN 'n/a' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS clicks,
       CAST(CASE WHEN l_orderkey % 101 = 0 THEN 0 ELSE CAST(l_quantity AS INT) * 20 + l_linenumber END AS STRING) AS impressions,
       CAST(l_linenumber AS STRING) AS conversions,
       CAST(CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(5,4)) END AS DECIMAL(18,6)) AS budget,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) *
            CASE WHEN l_orderkey % 333 = 0 THEN CAST(0.0001 AS DECIMAL(5,4)) ELSE CAST(l_discount AS DECIMAL(5,4)) END AS DECIMAL(18,6)) AS spend,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(5,4)) *
            CASE WHEN l_returnflag = 'R' AND l_orderkey % 500 = 3 THEN -2 ELSE 2 END AS DECIMAL(18,6)) AS revenue
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey
"""

RAW_GOOGLE = """
SELECT cid AS campaign_id, CONCAT(n_name, ' brand') AS campaign_name, dt AS segments_date,
       CASE l_suppkey % 4 WHEN 0 THEN 'SEARCH' WHEN 1 THEN 'SHOPPING' WHEN 2 THEN 'DISPLAY' ELSE 'PERFORMANCE_MAX' END
         AS campaign_advertising_channel_type,
       CAST(budget AS STRING) AS campaign_budget_amount,
       CAST(CAST(spend * 1000000 AS BIGINT) AS STRING) AS metrics_cost_micros,
       clicks AS metrics_clicks, impressions AS metrics_impressions, conversions AS metrics_conversions,
       CAST(revenue AS STRING) AS metrics_conversions_value
FROM {fx_base} WHERE l_suppkey % 3 = 0
"""

RAW_BING = """
SELECT cid AS CampaignId, CONCAT(n_name, ' search') AS CampaignName,
       CASE WHEN l_suppkey % 11 = 0 THEN NULL WHEN l_suppkey % 2 = 0 THEN 'Search' ELSE 'Audience' END AS CampaignType,
       dt AS TimePeriod, CAST(budget AS STRING) AS DailyBudget, CAST(spend AS STRING) AS Spend,
       clicks AS Clicks, impressions AS Impressions, conversions AS Conversions, CAST(revenue AS STRING) AS Revenue
FROM {fx_base} WHERE l_suppkey % 3 = 2
"""

RAW_META = """
SELECT cid AS campaign_id,
       CONCAT(n_name, CASE l_suppkey % 5 WHEN 0 THEN ' Remarketing' WHEN 1 THEN ' Retargeting Prospecting'
                                         WHEN 2 THEN ' Prospecting' WHEN 3 THEN ' DPA' ELSE ' Always-on' END) AS campaign_name,
       dt AS date_start, CAST(budget AS STRING) AS daily_budget, CAST(spend AS STRING) AS spend,
       clicks, impressions, CAST(revenue AS STRING) AS conversion
FROM {fx_base} WHERE l_suppkey % 3 = 1
"""

RAW_VIEWS = {"google": RAW_GOOGLE, "bing": RAW_BING, "meta": RAW_META}


def base_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in BASE_TABLES}


def raw_exports(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """``{google, bing, meta}`` raw string-typed exports built from the test tables."""
    tables = base_tables(spark, sf_dir)
    fx_base = spark.sql(FX_BASE, **tables)
    return {platform: spark.sql(text, fx_base=fx_base) for platform, text in RAW_VIEWS.items()}


def duckdb_ctes() -> str:
    """The same views as a DuckDB ``WITH`` prefix over the registered tables."""
    parts = [f"fx_base AS ({FX_BASE.format(lineitem='lineitem', supplier='supplier', nation='nation')})"]
    for platform, text in RAW_VIEWS.items():
        parts.append(f"raw_{platform} AS ({text.format(fx_base='fx_base')})")
    return "WITH " + ",\n".join(parts)


# A hand-made node table (test-only): two models of two rounds over TREE_FEATURES.
TREE_FEATURES = ["hist_30d_revenue", "future_budget", "forecast_window_days"]
TREE_START = {"revenue_q10": 4.0, "revenue_q50": 6.5}
TREE_RATE, TREE_DEPTH = 0.25, 2
TREE_COLUMNS = ["model", "round", "node", "feature", "threshold", "left", "right", "value"]
TREE_NODES = [
    ("revenue_q10", 0, 0, 0, 30000.0, 1, 2, 0.0), ("revenue_q10", 0, 1, -1, 0.0, 0, 0, 1.5),
    ("revenue_q10", 0, 2, 2, 30.0, 3, 4, 0.0), ("revenue_q10", 0, 3, -1, 0.0, 0, 0, -2.0), ("revenue_q10", 0, 4, -1, 0.0, 0, 0, 0.75),
    ("revenue_q10", 1, 0, -1, 0.0, 0, 0, 0.5),
    ("revenue_q50", 0, 0, 1, 15000.0, 1, 2, 0.0), ("revenue_q50", 0, 1, 2, 60.0, 3, 4, 0.0), ("revenue_q50", 0, 2, -1, 0.0, 0, 0, 3.25),
    ("revenue_q50", 0, 3, -1, 0.0, 0, 0, -1.0), ("revenue_q50", 0, 4, -1, 0.0, 0, 0, 2.0),
    ("revenue_q50", 1, 0, 2, 30.0, 1, 2, 0.0), ("revenue_q50", 1, 1, -1, 0.0, 0, 0, 0.125), ("revenue_q50", 1, 2, -1, 0.0, 0, 0, -0.375),
]
