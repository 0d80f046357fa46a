"""DuckDB oracle queries, one per registered Spark query.

Each text is ``WITH <shared CTE chain> SELECT ...``.  The CTE chain starts with
the fixture exports (the very same SQL text the engine runs in Spark) and then
re-derives every stage independently in plain SQL: DuckDB only inlines the
CTEs a query references.
"""

from __future__ import annotations

from oracle.sqlparts import date, num, sdiv_clean
from roasline.sources.fixtures import duckdb_ctes

CTES: list[tuple[str, str]] = []


def cte(name: str, body: str) -> None:
    CTES.append((name, body))


def with_chain() -> str:
    return duckdb_ctes() + ",\n" + ",\n".join(f"{n} AS ({b})" for n, b in CTES)


ORACLE: dict[str, str] = {}


def register(name: str, select: str) -> None:
    ORACLE[name] = select


def oracle_sql() -> dict[str, str]:
    chain = with_chain()
    return {name: f"{chain}\n{select}" for name, select in ORACLE.items()}


# --------------------------------------------------------------------------- normalise
cte(
    "n_google",
    f"""SELECT {date('segments_date')} AS date, 'Google Ads' AS channel, campaign_id, campaign_name,
        campaign_advertising_channel_type AS campaign_type,
        {num('campaign_budget_amount')} AS daily_budget,
        {num('metrics_cost_micros')} / 1000000.0::DOUBLE AS spend,
        {num('metrics_clicks')} AS clicks, {num('metrics_impressions')} AS impressions,
        {num('metrics_conversions')} AS conversions, {num('metrics_conversions_value')} AS revenue
    FROM raw_google""",
)
cte(
    "n_bing",
    f"""SELECT {date('TimePeriod')} AS date, 'Microsoft Ads' AS channel, CampaignId AS campaign_id,
        CampaignName AS campaign_name, CampaignType AS campaign_type,
        {num('DailyBudget')} AS daily_budget, {num('Spend')} AS spend, {num('Clicks')} AS clicks,
        {num('Impressions')} AS impressions, {num('Conversions')} AS conversions, {num('Revenue')} AS revenue
    FROM raw_bing""",
)
cte(
    "n_meta",
    f"""SELECT {date('date_start')} AS date, 'Meta Ads' AS channel, campaign_id, campaign_name,
        CASE WHEN contains(lower(campaign_name), 'remarketing') OR contains(lower(campaign_name), 'retarget') THEN 'Remarketing'
             WHEN contains(lower(campaign_name), 'prospecting') OR contains(lower(campaign_name), 'dpa') THEN 'Prospecting'
             ELSE 'Generic' END AS campaign_type,
        {num('daily_budget')} AS daily_budget, {num('spend')} AS spend, {num('clicks')} AS clicks,
        {num('impressions')} AS impressions, 0.0::DOUBLE AS conversions, {num('conversion')} AS revenue
    FROM raw_meta""",
)
RATES_SQL = f"""{sdiv_clean('clicks', 'impressions')} AS ctr, {sdiv_clean('spend', 'clicks')} AS cpc,
        {sdiv_clean('spend', 'impressions')} * 1000.0 AS cpm, {sdiv_clean('conversions', 'clicks')} AS conversion_rate,
        {sdiv_clean('revenue', 'spend')} AS roas"""
for _p in ("google", "bing", "meta"):
    cte(f"u_{_p}", f"SELECT *, {RATES_SQL} FROM n_{_p}")
cte("unified", "SELECT * FROM u_google UNION ALL SELECT * FROM u_bing UNION ALL SELECT * FROM u_meta")
cte("dated", "SELECT * FROM unified WHERE date IS NOT NULL")

register("normalize_google", "SELECT * FROM u_google")
register("normalize_bing", "SELECT * FROM u_bing")
register("normalize_meta", "SELECT * FROM u_meta")
register("unified_campaigns", "SELECT * FROM unified")
register("dated_rows", "SELECT * FROM dated")


# --------------------------------------------------------------------------- audit
_MISS = ["date", "channel", "campaign_id", "campaign_name", "campaign_type", "spend", "revenue"]
_NEG = ["daily_budget", "spend", "clicks", "impressions", "conversions", "revenue", "ctr", "cpc", "cpm",
        "conversion_rate", "roas"]
_ZERO = [("spend", "Zero spend rows"), ("revenue", "Zero revenue rows"), ("clicks", "Zero click rows"),
         ("impressions", "Zero impression rows")]
_DBL = {"spend", "revenue"}
_aggs = ["count(*) AS _rows"]
_aggs += [f"count_if({c} IS NULL{' OR isnan(' + c + ')' if c in _DBL else ''}) AS miss_{c}" for c in _MISS]
_aggs += [f"count_if({c} < 0) AS neg_{c}" for c in _NEG]
_aggs += ["count_if(date IS NULL) AS bad_date"]
_aggs += [f"count_if({c} = 0) AS zero_{c}" for c, _ in _ZERO]
_aggs += ["count_if(roas IS NOT NULL AND NOT isnan(roas) AND NOT isinf(roas)) AS roas_valid",
          "count_if(roas IS NOT NULL AND NOT isnan(roas) AND NOT isinf(roas) AND roas > 100) AS roas_extreme"]
cte("dq_counts", "SELECT " + ", ".join(_aggs) + " FROM unified")
cte("dq_dups", "SELECT COALESCE(SUM(n - 1), 0)::BIGINT AS duplicates FROM "
               "(SELECT date, channel, campaign_id, count(*) AS n FROM unified GROUP BY ALL)")


def _dq(ord_, check, column, value, message, src="dq_counts"):
    col = "NULL::VARCHAR" if column is None else f"'{column}'"
    return (f"SELECT {ord_}::INTEGER AS ord, '{check}' AS check_name, {col} AS column_name, "
            f"({value})::BIGINT AS value, ({message})::VARCHAR AS message FROM {src}")


_parts = [_dq(0, "required_columns", None, "0", "NULL")]
_parts += [_dq(10 + i, "missing_values", c, f"miss_{c}",
               f"CASE WHEN miss_{c} > 0 THEN '{c}: ' || miss_{c} || ' missing values' END") for i, c in enumerate(_MISS)]
_parts += [_dq(30 + i, "negative_values", c, f"neg_{c}",
               f"CASE WHEN neg_{c} > 0 THEN '{c}: ' || neg_{c} || ' negative values found' END") for i, c in enumerate(_NEG)]
_parts += [_dq(50, "invalid_dates", "date", "bad_date",
               "CASE WHEN bad_date > 0 THEN 'date: ' || bad_date || ' invalid or missing dates' END")]
_parts += [_dq(60, "duplicates", "date,channel,campaign_id", "duplicates",
               "CASE WHEN duplicates > 0 THEN 'Duplicate campaign-date rows found: ' || duplicates || '. This may happen "
               "if platform exports contain repeated daily campaign records.' END", src="dq_dups")]
_parts += [_dq(70 + i, "zero_activity", c, f"zero_{c}", f"'{label}: ' || zero_{c}") for i, (c, label) in enumerate(_ZERO)]
_parts += [_dq(80, "roas_outliers", "roas", "roas_extreme",
               "CASE WHEN roas_valid = 0 THEN 'ROAS could not be calculated for any row' WHEN roas_extreme > 0 THEN "
               "'Extreme ROAS rows found: ' || roas_extreme || '. These rows may be valid, but should be handled "
               "carefully during modeling.' END")]
cte("dq_long", "\nUNION ALL ".join(_parts))

for _name, _check in [("dq_required_columns", "required_columns"), ("dq_missing", "missing_values"),
                      ("dq_negative", "negative_values"), ("dq_dates", "invalid_dates"),
                      ("dq_duplicates", "duplicates"), ("dq_zero_activity", "zero_activity"),
                      ("dq_roas_outliers", "roas_outliers")]:
    register(_name, f"SELECT * FROM dq_long WHERE check_name = '{_check}'")
register("dq_report", "SELECT * FROM dq_long WHERE message IS NOT NULL")
register("dq_profile", """SELECT count(*) AS total_rows, 16::BIGINT AS total_columns, min(date) AS date_min,
    max(date) AS date_max, array_to_string(list_sort(list_distinct(list(channel))), ', ') AS channels,
    count(DISTINCT campaign_id)::BIGINT AS campaign_count FROM unified""")

# dataset summary of the three raw exports
_RAW_COLS = {
    "google": ["campaign_id", "campaign_name", "segments_date", "campaign_advertising_channel_type",
               "campaign_budget_amount", "metrics_cost_micros", "metrics_clicks", "metrics_impressions",
               "metrics_conversions", "metrics_conversions_value"],
    "bing": ["CampaignId", "CampaignName", "CampaignType", "TimePeriod", "DailyBudget", "Spend", "Clicks",
             "Impressions", "Conversions", "Revenue"],
    "meta": ["campaign_id", "campaign_name", "date_start", "daily_budget", "spend", "clicks", "impressions",
             "conversion"],
}
register("dataset_summary", "\nUNION ALL ".join(
    f"SELECT '{p}' AS platform, count(*)::BIGINT AS rows, {len(c)}::INTEGER AS columns, "
    f"'{', '.join(c)}' AS column_names FROM raw_{p}" for p, c in _RAW_COLS.items()))


# --------------------------------------------------------------------------- features
from oracle.sqlparts import micro, sdiv  # noqa: E402

K = ["channel", "campaign_id", "campaign_name", "campaign_type"]
KS = ", ".join(K)
WINDOWS = [7, 14, 30, 60, 90]
HORIZONS = [30, 60, 90]
MU = ["spend", "revenue", "clicks", "impressions", "conversions", "budget"]


def keys_eq(a, b):
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in K)


def metrics(prefix, r, d, u):
    """13 period columns from row count r, day count d and micro sums u[c]."""
    sp, rv, cl, im, cv, bu = (f"({u[c]})::DOUBLE / 1e6" for c in MU)
    return [
        f"({r})::BIGINT AS {prefix}_rows", f"({d})::BIGINT AS {prefix}_active_days",
        f"{sp} AS {prefix}_spend", f"{rv} AS {prefix}_revenue", f"{cl} AS {prefix}_clicks",
        f"{im} AS {prefix}_impressions", f"{cv} AS {prefix}_conversions",
        f"{sdiv(bu, r)} AS {prefix}_avg_daily_budget", f"{sdiv(cl, im)} AS {prefix}_ctr",
        f"{sdiv(sp, cl)} AS {prefix}_cpc", f"{sdiv(sp, im)} * 1000.0 AS {prefix}_cpm",
        f"{sdiv(cv, cl)} AS {prefix}_conversion_rate", f"{sdiv(rv, sp)} AS {prefix}_roas",
    ]


HIST_SQL_COLS = [f"hist_{w}d_{s}" for w in WINDOWS for s in
                 ["rows", "active_days", "spend", "revenue", "clicks", "impressions", "conversions",
                  "avg_daily_budget", "ctr", "cpc", "cpm", "conversion_rate", "roas"]]
TRENDS_SQL = (f"{sdiv('hist_7d_spend / 7', 'hist_30d_spend / 30')} AS spend_trend_7d_vs_30d, "
              f"{sdiv('hist_7d_revenue / 7', 'hist_30d_revenue / 30')} AS revenue_trend_7d_vs_30d, "
              f"{sdiv('hist_7d_roas', 'hist_30d_roas')} AS roas_trend_7d_vs_30d")

cte("fe_daily", f"""SELECT {KS}, date, count(*) AS n, {', '.join(f'SUM({micro(c)}) AS {c}_u' for c in MU[:-1])},
    SUM({micro('daily_budget')}) AS budget_u FROM dated GROUP BY ALL""")
cte("fe_bounds", f"SELECT {KS}, min(date) AS first_date, max(date) AS last_date FROM fe_daily GROUP BY ALL")
cte("fe_spine", f"""SELECT {KS}, first_date, last_date,
    CAST(unnest(generate_series(first_date + 29, last_date - 30, INTERVAL 7 DAY)) AS DATE) AS cutoff_date
    FROM fe_bounds WHERE first_date + 29 <= last_date - 30""")


def _hist_aggs(anchor):
    out = []
    for w in WINDOWS:
        inside = f"d.date BETWEEN {anchor} - {w - 1} AND {anchor}"
        out.append(f"SUM(CASE WHEN {inside} THEN d.n ELSE 0 END) AS r{w}")
        out.append(f"COUNT(CASE WHEN {inside} THEN 1 END) AS d{w}")
        out += [f"SUM(CASE WHEN {inside} THEN d.{c}_u ELSE 0 END) AS {c}{w}" for c in MU]
    return out


def _hist_cols():
    out = []
    for w in WINDOWS:
        out += metrics(f"hist_{w}d", f"r{w}", f"d{w}", {c: f"{c}{w}" for c in MU})
    return out


_fut = []
for _h in HORIZONS:
    _in = f"d.date BETWEEN s.cutoff_date + 1 AND s.cutoff_date + {_h}"
    _fut.append(f"SUM(CASE WHEN {_in} THEN d.n ELSE 0 END) AS fr{_h}")
    _fut += [f"SUM(CASE WHEN {_in} THEN d.{c}_u ELSE 0 END) AS f{c}{_h}" for c in MU]
cte("fe_spine_agg", f"""SELECT {', '.join('s.' + k for k in K)}, s.cutoff_date, s.first_date, s.last_date,
    {', '.join(_hist_aggs('s.cutoff_date') + _fut)}
    FROM fe_spine s LEFT JOIN fe_daily d ON {keys_eq('s', 'd')}
      AND d.date BETWEEN s.cutoff_date - 89 AND s.cutoff_date + 90
    GROUP BY ALL""")
cte("fe_spine_feat", f"""SELECT *, {TRENDS_SQL} FROM (SELECT {KS}, cutoff_date, first_date, last_date,
    {', '.join(_hist_cols())}, {', '.join(f'fr{h}' for h in HORIZONS)},
    {', '.join(f'f{c}{h}' for h in HORIZONS for c in MU)} FROM fe_spine_agg)""")


def id_cols(mode):
    return f"""'{mode}_' || COALESCE(channel, 'nan') || '_' || COALESCE(campaign_id, 'nan') || '_' || forecast_window_days
        || '_' || strftime(cutoff_date, '%Y-%m-%d') AS forecast_id, '{mode}' AS mode, 'campaign' AS forecast_level,
    {KS}, cutoff_date, cutoff_date + 1 AS forecast_start_date, cutoff_date + forecast_window_days AS forecast_end_date,
    forecast_window_days::INTEGER AS forecast_window_days, (cutoff_date - first_date + 1)::INTEGER AS campaign_age_days,
    month(cutoff_date + 1)::INTEGER AS forecast_month, quarter(cutoff_date + 1)::INTEGER AS forecast_quarter,
    year(cutoff_date + 1)::INTEGER AS forecast_year"""


TREND_NAMES = "spend_trend_7d_vs_30d, revenue_trend_7d_vs_30d, roas_trend_7d_vs_30d"
_fut_sel = " UNION ALL ".join(
    f"""SELECT *, {h} AS forecast_window_days, fr{h} AS fn, {', '.join(f'f{c}{h} AS fu_{c}' for c in MU)}
        FROM fe_spine_feat""" for h in HORIZONS)
cte("fe_train_base", f"""SELECT * FROM ({_fut_sel}) WHERE cutoff_date + forecast_window_days <= last_date AND fn > 0""")
cte("fe_train", f"""SELECT {id_cols('train')}, {', '.join(HIST_SQL_COLS)}, {TREND_NAMES},
    fb AS future_budget, {sdiv('fb', 'forecast_window_days')} AS future_budget_per_day,
    fu_spend::DOUBLE / 1e6 AS target_future_spend, fu_revenue::DOUBLE / 1e6 AS target_future_revenue,
    fu_clicks::DOUBLE / 1e6 AS target_future_clicks, fu_impressions::DOUBLE / 1e6 AS target_future_impressions,
    fu_conversions::DOUBLE / 1e6 AS target_future_conversions,
    {sdiv('fu_revenue::DOUBLE / 1e6', 'fu_spend::DOUBLE / 1e6')} AS target_future_roas
    FROM (SELECT *, CASE WHEN fu_budget::DOUBLE / 1e6 / fn * forecast_window_days <= 0 THEN fu_spend::DOUBLE / 1e6
                         ELSE fu_budget::DOUBLE / 1e6 / fn * forecast_window_days END AS fb FROM fe_train_base)""")

# prediction set: each campaign cut off at its own last date
cte("fe_pred_agg", f"""SELECT {', '.join('b.' + k for k in K)}, b.first_date, b.last_date AS cutoff_date,
    {', '.join(_hist_aggs('b.last_date'))}
    FROM fe_bounds b JOIN fe_daily d ON {keys_eq('b', 'd')} AND d.date BETWEEN b.last_date - 89 AND b.last_date
    GROUP BY ALL""")
cte("fe_pred_feat", f"""SELECT *, {TRENDS_SQL} FROM (SELECT {KS}, cutoff_date, first_date, {', '.join(_hist_cols())}
    FROM fe_pred_agg)""")
_est = (f"CASE WHEN hist_30d_avg_daily_budget > 0 THEN hist_30d_avg_daily_budget * forecast_window_days "
        f"ELSE {sdiv('hist_30d_spend', 'greatest(hist_30d_active_days, 1)')} * forecast_window_days END")
cte("fe_pred", f"""SELECT {id_cols('predict')}, {', '.join(HIST_SQL_COLS)}, {TREND_NAMES},
    fb AS future_budget, {sdiv('fb', 'forecast_window_days')} AS future_budget_per_day
    FROM (SELECT *, {_est} AS fb FROM (SELECT *, unnest([30, 60, 90]) AS forecast_window_days FROM fe_pred_feat))""")

register("period_aggregate", f"""SELECT {KS}, {', '.join(metrics('period', 'sum(n)', 'count(*)', {c: f'sum({c}_u)' for c in MU}))}
    FROM fe_daily WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' GROUP BY ALL""")
register("cutoff_spine", f"SELECT {KS}, cutoff_date, unnest([30, 60, 90]) AS forecast_window_days FROM fe_spine")
register("trailing_features", f"SELECT {KS}, cutoff_date, {', '.join(HIST_SQL_COLS)} FROM fe_spine_feat")
register("trend_features", f"SELECT {KS}, cutoff_date, {TREND_NAMES} FROM fe_spine_feat")
register("calendar_features", """SELECT forecast_id, channel, campaign_id, campaign_name, campaign_type, cutoff_date,
    forecast_start_date, forecast_end_date, forecast_window_days, campaign_age_days, forecast_month, forecast_quarter,
    forecast_year FROM fe_train""")
register("training_set", "SELECT * FROM fe_train")
register("prediction_set", "SELECT * FROM fe_pred")
register("future_budget", f"""SELECT {KS}, forecast_window_days, hist_30d_avg_daily_budget, hist_30d_spend,
    hist_30d_active_days, future_budget, future_budget_per_day FROM fe_pred""")
register("asof_latest", f"""SELECT {', '.join('s.' + k for k in K)}, s.cutoff_date, d.date AS latest_date,
    d.n::BIGINT AS latest_rows, d.spend_u::DOUBLE / 1e6 AS latest_spend, d.revenue_u::DOUBLE / 1e6 AS latest_revenue
    FROM (SELECT DISTINCT {KS}, cutoff_date FROM fe_spine) s
    ASOF LEFT JOIN (SELECT *, COALESCE(campaign_type, '<null>') AS ct FROM fe_daily) d
      ON s.channel = d.channel AND s.campaign_id = d.campaign_id AND s.campaign_name = d.campaign_name
     AND COALESCE(s.campaign_type, '<null>') = d.ct AND d.date <= s.cutoff_date""")


# --------------------------------------------------------------------------- scoring (fixture scorer)
from oracle.sqlparts import bround, fmt2, xavg, xsum  # noqa: E402

cte("sc_raw", """SELECT *,
    forecast_window_days * least(hist_7d_revenue / 7, hist_30d_revenue / 30, hist_90d_revenue / 90) AS raw_q10,
    forecast_window_days * (0.5 * (hist_30d_revenue / 30) + 0.3 * (hist_90d_revenue / 90)) + 0.1 * future_budget AS raw_q50,
    forecast_window_days * greatest(hist_7d_revenue / 7, hist_30d_revenue / 30, hist_90d_revenue / 90) * 1.1 AS raw_q90
    FROM fe_pred""")
cte("sc_sorted", """SELECT * EXCLUDE (raw_q10, raw_q50, raw_q90, q), q[1] AS revenue_low, q[2] AS revenue_expected,
    q[3] AS revenue_high FROM (SELECT *, list_sort([greatest(raw_q10, 0.0), greatest(raw_q50, 0.0),
    greatest(raw_q90, 0.0)]) AS q FROM sc_raw)""")
cte("sc_roas", f"""SELECT *, {sdiv('revenue_low', 'future_budget')} AS roas_low,
    {sdiv('revenue_expected', 'future_budget')} AS roas_expected, {sdiv('revenue_high', 'future_budget')} AS roas_high
    FROM sc_sorted""")
cte("sc_conf", """SELECT *, CASE WHEN revenue_expected <= 0 THEN 40.0 ELSE greatest(30.0, least(95.0,
    100.0 - least((revenue_high - revenue_low) / revenue_expected * 35, 60.0)
    - CASE WHEN future_budget <= 0 THEN 15 ELSE 0 END - CASE WHEN hist_30d_rows < 10 THEN 10 ELSE 0 END)) END
    AS confidence_score FROM sc_roas""")


def risk_sql(st="spend_trend_7d_vs_30d", rt="revenue_trend_7d_vs_30d"):
    return f"""CASE WHEN roas_expected < 1 OR confidence_score < 45 THEN 'High'
        WHEN {st} > 1.3 AND {rt} < 0.9 THEN 'High'
        WHEN roas_expected < 2 OR confidence_score < 65 THEN 'Medium' ELSE 'Low' END"""


def insight_sql(st="spend_trend_7d_vs_30d", rt="revenue_trend_7d_vs_30d"):
    subject = """CASE WHEN forecast_level = 'campaign' THEN COALESCE(channel, 'nan') || ' campaign ''' || COALESCE(campaign_name, 'nan') || ''''
        WHEN forecast_level = 'campaign_type' THEN COALESCE(channel, 'nan') || ' ' || COALESCE(campaign_type, 'nan')
        WHEN forecast_level = 'blended' THEN 'overall blended marketing performance' ELSE COALESCE(channel, 'nan') END"""
    trend = f"""CASE WHEN {st} > 1.2 AND {rt} < 1 THEN 'recent spend is increasing faster than revenue, which may reduce efficiency'
        WHEN {rt} > 1.2 AND {st} <= 1.2 THEN 'recent revenue is improving faster than spend, which indicates positive momentum'
        WHEN {rt} < 0.8 THEN 'recent revenue momentum is weak compared with the previous 30-day baseline'
        ELSE 'recent spend and revenue trends are relatively stable' END"""
    return (f"'For the next ' || forecast_window_days::INTEGER || ' days, ' || {subject} || "
            f"' is forecasted with expected ROAS around ' || {fmt2('roas_expected')} || '. Risk level is ' || "
            f"COALESCE(risk_level, 'nan') || '. The main reason is that ' || {trend} || '.'")


cte("sc_risk", f"SELECT * REPLACE ('campaign' AS forecast_level), {risk_sql()} AS risk_level FROM sc_conf")
cte("campaign_fc", f"SELECT *, {insight_sql()} AS insight_summary FROM sc_risk")

OUT_COLS = ["forecast_id", "forecast_level", "channel", "campaign_type", "campaign_id", "campaign_name",
            "forecast_window_days", "forecast_start_date", "forecast_end_date", "future_budget",
            "revenue_low", "revenue_expected", "revenue_high", "roas_low", "roas_expected", "roas_high",
            "confidence_score", "risk_level", "insight_summary"]
ROUNDED = ["future_budget", "revenue_low", "revenue_expected", "revenue_high", "roas_low", "roas_expected",
           "roas_high", "confidence_score"]


def rollup_sql(src, extra=()):
    ex = "".join(f"{e}, " for e in extra)
    order = "ORDER BY channel, campaign_id, campaign_name, campaign_type"
    return f"""SELECT {ex}forecast_window_days, channel AS g_channel, campaign_type AS g_type,
        GROUPING(channel, campaign_type) AS gid,
        {xsum('future_budget')} AS future_budget, {xsum('revenue_low')} AS revenue_low,
        {xsum('revenue_expected')} AS revenue_expected, {xsum('revenue_high')} AS revenue_high,
        {xavg('confidence_score')} AS confidence_score,
        max(CASE risk_level WHEN 'High' THEN 2 WHEN 'Medium' THEN 1 ELSE 0 END) AS risk_rank,
        first(forecast_start_date {order}) AS forecast_start_date, first(forecast_end_date {order}) AS forecast_end_date
    FROM {src}
    GROUP BY GROUPING SETS (({ex}forecast_window_days), ({ex}forecast_window_days, channel),
                            ({ex}forecast_window_days, channel, campaign_type))"""


def rollup_final_sql(agg, extra=()):
    ex = "".join(f"{e}, " for e in extra)
    lvl = "CASE gid WHEN 0 THEN 'campaign_type' WHEN 1 THEN 'channel' ELSE 'blended' END"
    inner = f"""SELECT {ex}{lvl} AS forecast_level,
        CASE WHEN gid = 3 THEN 'ALL' ELSE g_channel END AS channel,
        CASE WHEN gid = 0 THEN g_type ELSE 'ALL' END AS campaign_type,
        'ALL' AS campaign_id, 'ALL' AS campaign_name, forecast_window_days::INTEGER AS forecast_window_days,
        forecast_start_date, forecast_end_date, future_budget, revenue_low, revenue_expected, revenue_high,
        {sdiv('revenue_low', 'future_budget')} AS roas_low, {sdiv('revenue_expected', 'future_budget')} AS roas_expected,
        {sdiv('revenue_high', 'future_budget')} AS roas_high, confidence_score,
        CASE risk_rank WHEN 2 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END AS risk_level FROM {agg}"""
    return f"""SELECT {ex}forecast_level || '_' || COALESCE(channel, 'nan') || '_' || COALESCE(campaign_type, 'nan') || '_'
        || forecast_window_days AS forecast_id, * EXCLUDE ({', '.join(extra) + ', ' if extra else ''}forecast_level),
        forecast_level, {insight_sql('1.0', '1.0')} AS insight_summary FROM ({inner})"""


def table_sql(levels_src, campaign_src, extra=()):
    ex = "".join(f"{e}, " for e in extra)
    cols = ", ".join(f"{bround('COALESCE(' + c + ', 0)', 4)} AS {c}" if c in ROUNDED else c for c in OUT_COLS)
    return f"""SELECT {ex}{cols} FROM (SELECT {ex}{', '.join(OUT_COLS)} FROM {levels_src}
        UNION ALL SELECT {ex}{', '.join(OUT_COLS)} FROM {campaign_src})"""


cte("fc_agg", rollup_sql("campaign_fc"))
cte("fc_levels", rollup_final_sql("fc_agg"))
cte("fc_table", table_sql("fc_levels", "campaign_fc"))

_PK = f"{KS}, forecast_window_days"
register("monotone_quantiles", f"SELECT {_PK}, revenue_low, revenue_expected, revenue_high FROM sc_sorted")
register("forecast_roas", f"SELECT {_PK}, future_budget, roas_low, roas_expected, roas_high FROM sc_roas")
register("confidence_score", f"""SELECT {_PK}, revenue_low, revenue_expected, revenue_high, future_budget, hist_30d_rows,
    confidence_score FROM sc_conf""")
register("risk_level", f"""SELECT {_PK}, roas_expected, confidence_score, spend_trend_7d_vs_30d, revenue_trend_7d_vs_30d,
    risk_level FROM campaign_fc""")
register("forecast_insight", f"SELECT {_PK}, insight_summary FROM campaign_fc")
register("campaign_forecast", "SELECT * FROM campaign_fc")
register("forecast_table", "SELECT * FROM fc_table")
register("rollup_channel", "SELECT * FROM fc_table WHERE forecast_level = 'channel'")
register("rollup_campaign_type", "SELECT * FROM fc_table WHERE forecast_level = 'campaign_type'")
register("rollup_blended", "SELECT * FROM fc_table WHERE forecast_level = 'blended'")
register("forecast_level_counts", "SELECT forecast_level, count(*) AS rows FROM fc_table GROUP BY ALL")


# --------------------------------------------------------------------------- scenarios
def fc_chain(p, src, extra=()):
    """The scoring + roll-up chain over another prediction source."""
    bodies = {n: b for n, b in CTES}
    names = ["sc_raw", "sc_sorted", "sc_roas", "sc_conf", "sc_risk", "campaign_fc"]
    ren = {"fe_pred": src, **{n: f"{p}_{n}" for n in names}}
    for n in names:
        body = bodies[n]
        for old in sorted(ren, key=len, reverse=True):
            body = body.replace(f"FROM {old}", f"FROM {ren[old]}")
        cte(f"{p}_{n}", body)
    cte(f"{p}_agg", rollup_sql(f"{p}_campaign_fc", extra))
    cte(f"{p}_levels", rollup_final_sql(f"{p}_agg", extra))
    cte(f"{p}_table", table_sql(f"{p}_levels", f"{p}_campaign_fc", extra))


SCENARIO_SQL_MULT = {"Google Ads": 1.2, "Meta Ads": 0.9, "Microsoft Ads": 1.0}
SCENARIO_SQL_NAME = "Google Ads: +20% | Meta Ads: -10% | Microsoft Ads: +0%"
_case = " ".join(f"WHEN '{c}' THEN {m}" for c, m in SCENARIO_SQL_MULT.items())
cte("sn_pred0", f"""SELECT *, CASE WHEN scenario_id = 0 THEN 1.0 ELSE COALESCE(CASE channel {_case} END, 1.0) END::DOUBLE
    AS budget_multiplier FROM (SELECT *, unnest([0, 1]) AS scenario_id FROM fe_pred)""")
cte("cat_tab", """SELECT c_nationkey + 1 AS scenario_id, c_custkey % 3 AS position,
    CASE c_custkey % 3 WHEN 0 THEN 'Google Ads' WHEN 1 THEN 'Microsoft Ads' ELSE 'Meta Ads' END AS channel,
    (sum(c_custkey) % 101 + 50)::DOUBLE / 100 AS multiplier FROM customer GROUP BY ALL""")
cte("cat_names", """SELECT scenario_id, string_agg(channel || ': ' || CASE WHEN multiplier >= 1 THEN '+' ELSE '' END
    || round((multiplier - 1) * 100)::BIGINT || '%', ' | ' ORDER BY position) AS scenario_name FROM cat_tab GROUP BY ALL""")
cte("cat_pred0", """SELECT p.*, i.scenario_id::INTEGER AS scenario_id, COALESCE(t.multiplier, 1.0) AS budget_multiplier
    FROM fe_pred p, (SELECT DISTINCT scenario_id FROM cat_tab UNION ALL SELECT 0) i
    LEFT JOIN cat_tab t ON t.scenario_id = i.scenario_id AND t.channel = p.channel""")
for _p in ("sn", "cat"):
    cte(f"{_p}_pred", f"""SELECT * REPLACE (fb AS future_budget, {sdiv('fb', 'forecast_window_days')} AS future_budget_per_day)
    FROM (SELECT *, future_budget * budget_multiplier AS fb FROM {_p}_pred0)""")
    fc_chain(_p, f"{_p}_pred", extra=("scenario_id",))

_CK = ["forecast_level", "channel", "campaign_type", "campaign_id", "campaign_name", "forecast_window_days"]
_CMP = [("future_budget", "budget"), ("revenue_expected", "revenue_expected"), ("revenue_low", "revenue_low"),
        ("revenue_high", "revenue_high"), ("roas_expected", "roas_expected"),
        ("confidence_score", "confidence_score"), ("risk_level", "risk_level")]
_SN_ROUND = ["baseline_budget", "scenario_budget", "budget_change", "budget_change_percent",
             "baseline_revenue_expected", "scenario_revenue_expected", "revenue_change", "revenue_change_percent",
             "baseline_roas_expected", "scenario_roas_expected", "roas_change",
             "baseline_confidence_score", "scenario_confidence_score"]
_subj = """CASE WHEN forecast_level = 'blended' THEN 'overall marketing performance'
    WHEN forecast_level = 'channel' THEN COALESCE(channel, 'nan')
    WHEN forecast_level = 'campaign_type' THEN COALESCE(channel, 'nan') || ' ' || COALESCE(campaign_type, 'nan')
    ELSE COALESCE(channel, 'nan') || ' campaign ''' || COALESCE(campaign_name, 'nan') || '''' END"""
_act = """CASE WHEN revenue_change > 0 AND roas_change >= 0 THEN 'This scenario looks positive because revenue is expected to improve without reducing ROAS.'
    WHEN revenue_change > 0 AND roas_change < 0 THEN 'This scenario may increase revenue, but efficiency may reduce because ROAS is expected to decline.'
    WHEN revenue_change <= 0 AND roas_change > 0 THEN 'This scenario may improve efficiency, but revenue growth may be limited.'
    ELSE 'This scenario is not attractive because both revenue and efficiency may weaken.' END"""
for _p, _name in (("sn", f"'{SCENARIO_SQL_NAME}'"), ("cat", "(SELECT scenario_name FROM cat_names n WHERE n.scenario_id = cat_cmp0.scenario_id)")):
    cte(f"{_p}_join", f"""SELECT s.scenario_id, {', '.join('s.' + k for k in _CK)},
    {', '.join(f'b.{c} AS baseline_{n}' for c, n in _CMP)}, {', '.join(f's.{c} AS scenario_{n}' for c, n in _CMP)}
    FROM (SELECT * FROM {_p}_table WHERE scenario_id <> 0) s
    JOIN (SELECT * FROM {_p}_table WHERE scenario_id = 0) b ON {' AND '.join(f's.{k} IS NOT DISTINCT FROM b.{k}' for k in _CK)}""")
    cte(f"{_p}_delta", f"""SELECT *, {sdiv('budget_change', 'baseline_budget')} * 100 AS budget_change_percent,
    {sdiv('revenue_change', 'baseline_revenue_expected')} * 100 AS revenue_change_percent
    FROM (SELECT *, scenario_budget - baseline_budget AS budget_change,
      scenario_revenue_expected - baseline_revenue_expected AS revenue_change,
      scenario_roas_expected - baseline_roas_expected AS roas_change FROM {_p}_join)""")
    cte(f"{_p}_cmp0", f"""SELECT *, 'For the next ' || forecast_window_days::INTEGER || ' days, ' || {_subj} ||
    ' is expected to change revenue by ' || {fmt2('revenue_change')} || ' (' || {fmt2('revenue_change_percent')} ||
    '%). Expected scenario ROAS is ' || {fmt2('scenario_roas_expected')} || '. Risk level is ' ||
    COALESCE(scenario_risk_level, 'nan') || '. ' || {_act} AS scenario_recommendation FROM {_p}_delta""")
    cte(f"{_p}_cmp", f"""SELECT * REPLACE ({', '.join(f"{bround('COALESCE(' + c + ', 0)', 4)} AS {c}" for c in _SN_ROUND)}),
    {_name} AS scenario_name FROM {_p}_cmp0""")

register("scenario_budget", f"""SELECT {KS}, forecast_window_days, scenario_id, budget_multiplier, future_budget,
    future_budget_per_day FROM sn_pred""")
register("scenario_forecast", "SELECT * FROM sn_table")
register("scenario_catalogue_budget", f"""SELECT {KS}, forecast_window_days, scenario_id, budget_multiplier, future_budget,
    future_budget_per_day FROM cat_pred""")
register("scenario_catalogue_names", "SELECT scenario_id::INTEGER AS scenario_id, scenario_name FROM cat_names")
register("scenario_catalogue_comparison", "SELECT * FROM cat_cmp")
register("scenario_join", f"""SELECT scenario_id, {', '.join(_CK)},
    {', '.join(f'baseline_{n}' for _, n in _CMP)}, {', '.join(f'scenario_{n}' for _, n in _CMP)} FROM sn_cmp""")
register("scenario_deltas", f"""SELECT scenario_id, {', '.join(_CK)}, budget_change, budget_change_percent,
    revenue_change, revenue_change_percent, roas_change FROM sn_cmp""")
register("scenario_recommendation", f"SELECT scenario_id, {', '.join(_CK)}, scenario_recommendation FROM sn_cmp")
register("scenario_comparison", "SELECT * FROM sn_cmp")
register("scenario_name", "SELECT DISTINCT scenario_id, scenario_name FROM sn_cmp")
register("scenario_blended", """SELECT scenario_id, scenario_name, forecast_window_days, baseline_budget, scenario_budget,
    budget_change, budget_change_percent, baseline_revenue_expected, scenario_revenue_expected, revenue_change,
    revenue_change_percent, baseline_roas_expected, scenario_roas_expected, roas_change, scenario_risk_level,
    scenario_recommendation FROM sn_cmp WHERE forecast_level = 'blended'""")


# --------------------------------------------------------------------------- insights
from oracle.sqlparts import money  # noqa: E402

cte("fx", """SELECT * REPLACE (COALESCE(forecast_level, 'Unknown') AS forecast_level, COALESCE(channel, 'Unknown') AS channel,
    COALESCE(campaign_type, 'Unknown') AS campaign_type, COALESCE(campaign_id, 'Unknown') AS campaign_id,
    COALESCE(campaign_name, 'Unknown') AS campaign_name, COALESCE(risk_level, 'Unknown') AS risk_level) FROM fc_table""")
UNC = "(CASE WHEN revenue_expected <= 0 THEN 1.0 ELSE (revenue_high - revenue_low) / revenue_expected END)"
RISK_EXPL = f"""CASE WHEN risk_level = 'High' THEN CASE
      WHEN roas_expected < 1 THEN 'Risk is high because expected ROAS is below 1.00x, meaning the forecasted revenue may not justify the planned budget.'
      WHEN confidence_score < 45 THEN 'Risk is high because forecast confidence is weak. The campaign may have unstable historical behavior or wide prediction uncertainty.'
      WHEN {UNC} > 0.8 THEN 'Risk is high because the forecast range is wide, which means the outcome is less predictable.'
      ELSE 'Risk is high because performance signals suggest the campaign may not scale efficiently under the current forecast assumptions.' END
    WHEN risk_level = 'Medium' THEN 'Risk is medium because the forecast is usable, but efficiency or confidence should be monitored before making aggressive budget changes.'
    ELSE 'Risk is low because forecast confidence and expected ROAS are relatively stable.' END"""
ACTION = f"""CASE WHEN risk_level = 'High' THEN CASE WHEN roas_expected < 1
        THEN 'Avoid scaling this segment immediately. Review campaign structure, targeting, creative quality, landing page relevance, and tracking accuracy before adding budget.'
        ELSE 'Do not scale aggressively. Keep budget controlled, monitor daily performance, and test improvements before increasing spend.' END
    WHEN risk_level = 'Medium' THEN CASE WHEN roas_expected >= 2.5 AND confidence_score >= 60
        THEN 'Scale cautiously with a small budget increase and monitor ROAS movement closely.'
        ELSE 'Maintain or slightly reduce budget until revenue efficiency becomes more consistent.' END
    WHEN roas_expected >= 3 AND confidence_score >= 70 AND {UNC} < 0.7
        THEN 'This segment is a good candidate for controlled scaling because expected ROAS and confidence are healthy.'
    ELSE 'Maintain current budget and continue monitoring. Scaling can be considered after more stable performance is observed.' END"""
PRIO = "CASE lower(risk_level) WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END"


def xr(c):
    return f"{fmt2(c)} || 'x'"


_FK = "forecast_level, channel, campaign_type, campaign_id, campaign_name, forecast_window_days"
register("forecast_contract", "SELECT * FROM fx")
register("level_window_slice", "SELECT * FROM fx WHERE forecast_level = 'campaign' AND forecast_window_days = 30")
register("uncertainty_ratio", f"SELECT {_FK}, {UNC} AS uncertainty_ratio FROM fx")
register("risk_explanation", f"SELECT {_FK}, risk_level, {RISK_EXPL} AS risk_explanation FROM fx")
register("recommended_action", f"SELECT {_FK}, risk_level, {ACTION} AS recommended_action FROM fx")
_subj_e = """CASE WHEN forecast_level = 'blended' THEN 'overall marketing performance' WHEN forecast_level = 'channel' THEN channel
    WHEN forecast_level = 'campaign_type' THEN channel || ' - ' || campaign_type ELSE channel || ' campaign ''' || campaign_name || '''' END"""
register("insights_table", f"""SELECT {PRIO} AS priority, forecast_window_days, forecast_level, channel, campaign_type, campaign_id,
    campaign_name, risk_level, {fmt2('confidence_score')}::DOUBLE AS confidence_score,
    {fmt2('revenue_expected')}::DOUBLE AS revenue_expected, {fmt2('roas_expected', 4)}::DOUBLE AS roas_expected,
    'For the next ' || forecast_window_days || ' days, ' || {_subj_e} || ' is forecasted to generate ' ||
    {money('revenue_expected')} || ' revenue with expected ROAS of ' || {xr('roas_expected')} || '. ' || {RISK_EXPL} AS insight,
    {ACTION} AS recommended_action
    FROM fx WHERE forecast_level IN ('blended', 'channel', 'campaign_type', 'campaign')""")
register("executive_summary", f"""SELECT forecast_window_days, {money('future_budget')} AS planned_budget,
    'Expected revenue is ' || {money('revenue_expected')} || ', with a probable range between ' || {money('revenue_low')}
      || ' and ' || {money('revenue_high')} || '.' AS revenue_range,
    'Expected ROAS is ' || {xr('roas_expected')} || ', with a range between ' || {xr('roas_low')} || ' and '
      || {xr('roas_high')} || '.' AS roas_range,
    {fmt2('confidence_score')} || '/100' AS confidence, risk_level, {RISK_EXPL} AS interpretation,
    {ACTION} AS recommended_action FROM fx WHERE forecast_level = 'blended'""")
register("channel_leaderboard", f"""SELECT forecast_window_days,
    row_number() OVER (PARTITION BY forecast_window_days ORDER BY revenue_expected DESC, channel) AS rank, channel,
    {money('future_budget')} AS budget, {money('revenue_expected')} AS expected_revenue, {xr('roas_expected')} AS expected_roas,
    risk_level, {fmt2('confidence_score')} AS confidence FROM fx WHERE forecast_level = 'channel'""")
register("best_roas_channel", f"""SELECT forecast_window_days, channel, roas_expected,
    '**Best efficiency signal:** ' || channel || ' has the strongest expected ROAS at ' || {xr('roas_expected')} || '.' AS message
    FROM fx WHERE forecast_level = 'channel'
    QUALIFY row_number() OVER (PARTITION BY forecast_window_days ORDER BY roas_expected DESC, channel) = 1""")
register("top_campaign_types", f"""SELECT forecast_window_days, rank, channel, campaign_type, {money('revenue_expected')} AS expected_revenue,
    {xr('roas_expected')} AS expected_roas, risk_level FROM (SELECT *, row_number() OVER (PARTITION BY forecast_window_days
    ORDER BY revenue_expected DESC, channel, campaign_type) AS rank FROM fx WHERE forecast_level = 'campaign_type')
    WHERE rank <= 10""")
_CR = f"""risk_level, channel, campaign_id, campaign_name, forecast_window_days, {money('revenue_expected')} AS expected_revenue,
    {xr('roas_expected')} AS expected_roas, {fmt2('confidence_score')} AS confidence, {ACTION} AS recommended_action"""
register("risk_watchlist", f"""SELECT {PRIO} AS priority, {_CR} FROM fx
    WHERE forecast_level = 'campaign' AND risk_level IN ('High', 'Medium')
    ORDER BY {PRIO}, revenue_expected DESC, forecast_window_days, channel, campaign_id, campaign_name LIMIT 15""")
register("scaling_candidates", f"""SELECT {_CR} FROM fx WHERE forecast_level = 'campaign' AND risk_level = 'Low'
    AND roas_expected >= 3 AND confidence_score >= 65
    ORDER BY forecast_window_days, roas_expected DESC, revenue_expected DESC, channel, campaign_id, campaign_name LIMIT 15""")
register("portfolio_summary", f"""SELECT COALESCE({xavg('confidence_score')}, 0.0) AS avg_confidence,
    count_if(risk_level = 'High') AS high_risk_rows, count_if(risk_level = 'Medium') AS medium_risk_rows,
    (SELECT forecast_window_days FROM fx WHERE forecast_level = 'blended' ORDER BY roas_expected DESC, forecast_window_days LIMIT 1) AS best_blended_window,
    (SELECT roas_expected FROM fx WHERE forecast_level = 'blended' ORDER BY roas_expected DESC, forecast_window_days LIMIT 1) AS best_blended_roas,
    '- Overall forecast confidence across all forecast rows is **' || {fmt2(f"COALESCE({xavg('confidence_score')}, 0.0)")} || '/100**.' AS confidence_line,
    CASE WHEN count_if(risk_level = 'High') > 0 THEN '- There are **' || count_if(risk_level = 'High') || ' high-risk forecast rows**. These should be reviewed before budget scaling.' END AS high_risk_line,
    CASE WHEN count_if(risk_level = 'Medium') > 0 THEN '- There are **' || count_if(risk_level = 'Medium') || ' medium-risk forecast rows**. These can be monitored with controlled budget movement.' END AS medium_risk_line,
    (SELECT '- The strongest blended ROAS appears in the **' || forecast_window_days || '-day forecast** with expected ROAS of **' || {xr('roas_expected')} || '**.'
        FROM fx WHERE forecast_level = 'blended' ORDER BY roas_expected DESC, forecast_window_days LIMIT 1) AS best_window_line
    FROM fx""")


def window_top(condition, order, k, columns):
    return f"""SELECT forecast_window_days, rank, channel, campaign_type, {columns} FROM (SELECT *, row_number() OVER (
        PARTITION BY forecast_window_days ORDER BY {order}) AS rank FROM fx WHERE {condition}) WHERE rank <= {k}"""


register("window_campaign_types", window_top(
    "forecast_level = 'campaign_type'", "revenue_expected DESC, channel, campaign_type", 20,
    "future_budget, revenue_expected, revenue_low, revenue_high, roas_expected, confidence_score, risk_level"))
_WC = "campaign_name, future_budget, revenue_expected, roas_expected, confidence_score, risk_level"
register("window_watchlist", window_top(
    "forecast_level = 'campaign' AND risk_level IN ('High', 'Medium')",
    "risk_level, revenue_expected DESC, channel, campaign_id, campaign_name", 50, _WC + ", insight_summary"))
register("window_scaling", window_top(
    "forecast_level = 'campaign' AND risk_level = 'Low' AND roas_expected >= 3 AND confidence_score >= 65",
    "roas_expected DESC, revenue_expected DESC, channel, campaign_id, campaign_name", 30, _WC))
register("scenario_contract", "SELECT * FROM sn_cmp")
register("scenario_contract_text", """SELECT * REPLACE (CASE WHEN forecast_level = 'channel' THEN 0 ELSE baseline_budget END AS baseline_budget,
    CASE WHEN forecast_window_days = 60 THEN 0 ELSE revenue_change END AS revenue_change,
    CASE WHEN channel = 'Meta Ads' THEN 0 ELSE roas_change END AS roas_change,
    CASE WHEN forecast_level = 'blended' THEN 0 ELSE scenario_budget END AS scenario_budget) FROM sn_cmp""")
register("forecast_contract_text", """SELECT * REPLACE (CASE WHEN forecast_level = 'channel' THEN 0 ELSE future_budget END AS future_budget,
    CASE WHEN forecast_window_days = 60 THEN 0 ELSE revenue_low END AS revenue_low,
    CASE WHEN channel = 'Meta Ads' THEN 0 ELSE roas_expected END AS roas_expected,
    CASE WHEN forecast_level = 'blended' THEN 'Unknown' ELSE channel END AS channel) FROM fx""")
register("scenario_report", f"""SELECT scenario_id, forecast_window_days, {money('baseline_budget')} AS baseline_budget,
    {money('scenario_budget')} AS scenario_budget,
    {money('budget_change')} || ' (' || {fmt2('budget_change_percent')} || '%)' AS budget_change,
    {money('revenue_change')} || ' (' || {fmt2('revenue_change_percent')} || '%)' AS revenue_change,
    {fmt2('roas_change')} || 'x' AS roas_change,
    CASE WHEN revenue_change > 0 AND roas_change >= 0 THEN 'This scenario is attractive because it improves expected revenue without reducing ROAS.'
      WHEN revenue_change > 0 AND roas_change < 0 THEN 'This scenario can grow revenue, but the agency should watch efficiency because ROAS is expected to decline.'
      WHEN revenue_change <= 0 AND roas_change > 0 THEN 'This scenario may improve efficiency, but it may limit revenue scale.'
      ELSE 'This scenario does not look attractive because both revenue and efficiency may weaken.' END AS interpretation
    FROM sn_cmp WHERE forecast_level = 'blended'""")


# --------------------------------------------------------------------------- model (exact parts)
register("train_clean", "SELECT * REPLACE (greatest(COALESCE(target_future_revenue, 0.0), 0.0) AS target_future_revenue) "
                        "FROM fe_train WHERE target_future_revenue IS NOT NULL")
_HELD_OUT = "('0x' || substr(md5('42:' || forecast_id), 1, 8))::BIGINT % 100 >= 80"
_METRICS = f"""count(*) AS rows, {bround('avg(abs(e))', 4)} AS mae, {bround('sqrt(avg(e * e))', 4)} AS rmse,
    {bround('CASE WHEN var_pop(y) * count(y) > 0 THEN 1.0 - sum(e * e) / (var_pop(y) * count(y)) ELSE 0.0 END', 4)} AS r2"""
register("regression_metrics", f"""SELECT {_METRICS}
    FROM (SELECT greatest(forecast_window_days * (0.5 * (hist_30d_revenue / 30) + 0.3 * (hist_90d_revenue / 90))
                 + 0.1 * future_budget, 0.0) - greatest(target_future_revenue, 0.0) AS e, greatest(target_future_revenue, 0.0) AS y
          FROM fe_train WHERE target_future_revenue IS NOT NULL AND {_HELD_OUT})""")


# --------------------------------------------------------------------------- helpers, discovery, model inputs
register("clean_numeric", " UNION ALL ".join(
    f"""SELECT '{p}' AS platform, '{c}' AS column_name, {c} AS text, COALESCE(TRY_CAST({c} AS DOUBLE), 0.0) AS value
    FROM raw_{p}""" for p, c in [("google", "metrics_clicks"), ("bing", "Clicks"), ("meta", "clicks"), ("bing", "Spend"),
                                 ("meta", "conversion")]))
register("parse_dates", """SELECT l_orderkey, l_linenumber, (l_orderkey % 8)::INTEGER AS layout,
    CASE WHEN l_orderkey % 8 < 7 THEN l_shipdate::DATE END AS date FROM lineitem""")
register("meta_campaign_type", """SELECT campaign_id, campaign_name,
    CASE WHEN regexp_matches(campaign_name, '(?i)remarketing|retarget') THEN 'Remarketing'
         WHEN regexp_matches(campaign_name, '(?i)prospecting|dpa') THEN 'Prospecting' ELSE 'Generic' END AS campaign_type
    FROM raw_meta""")
register("safe_divide", """SELECT channel, campaign_id, date, clicks, impressions,
    COALESCE(clicks / NULLIF(impressions, 0), 0) AS scalar_rule, COALESCE(clicks / NULLIF(impressions, 0), 0) AS column_rule
    FROM unified""")
register("rate_metrics", """SELECT channel, campaign_id, date, daily_budget, spend, clicks, impressions, conversions, revenue,
    COALESCE(clicks / NULLIF(impressions, 0), 0) AS ctr, COALESCE(spend / NULLIF(clicks, 0), 0) AS cpc,
    COALESCE(spend / NULLIF(impressions, 0), 0) * 1000 AS cpm, COALESCE(conversions / NULLIF(clicks, 0), 0) AS conversion_rate,
    COALESCE(revenue / NULLIF(spend, 0), 0) AS roas FROM unified""")
_GOOGLE = ["campaign_id", "campaign_name", "segments_date", "campaign_advertising_channel_type", "campaign_budget_amount",
           "metrics_cost_micros", "metrics_clicks", "metrics_impressions", "metrics_conversions", "metrics_conversions_value"]
_FAULT = "metrics_impressions::INTEGER % 10"
register("csv_rows", f"""SELECT * REPLACE (CASE WHEN {_FAULT} = 4 THEN 'a "' || campaign_name || '"' ELSE campaign_name END AS campaign_name)
    FROM raw_google WHERE {_FAULT} > 2""")
register("csv_quarantine", f"""SELECT {" || ',' || ".join(f"COALESCE({c}, '')" for c in _GOOGLE[:-1])} ||
    CASE {_FAULT} WHEN 0 THEN '' WHEN 1 THEN ',' || metrics_conversions_value || ',more' ELSE ',"' || metrics_conversions_value END AS line
    FROM raw_google WHERE {_FAULT} <= 2""")
register("source_discovery", """SELECT stem || m || '.csv' AS file_name, platform
    FROM (SELECT DISTINCT strftime(o_orderdate::DATE, '%Y-%m') AS m FROM orders),
         (VALUES ('google_ads_', 'google'), ('MS_Ads-', 'bing'), ('Facebook ', 'meta')) AS v(stem, platform)""")
register("align_features", """SELECT forecast_id, channel, NULL::VARCHAR AS campaign_type, 0.0::DOUBLE AS hist_7d_spend,
    CASE WHEN forecast_window_days > 30 THEN hist_14d_spend ELSE 0 END AS hist_14d_spend, hist_30d_spend FROM fe_pred""")
register("holdout_split", """SELECT forecast_id, ('0x' || substr(md5('42:' || forecast_id), 1, 8))::BIGINT % 100 < 80 AS is_train
    FROM fe_train""")
_FEATURES = (["channel", "campaign_id", "campaign_name", "campaign_type", "forecast_level", "forecast_window_days",
              "campaign_age_days", "forecast_month", "forecast_quarter", "forecast_year"] + HIST_SQL_COLS
             + TREND_NAMES.split(", ") + ["future_budget", "future_budget_per_day"])
register("feature_columns", "\nUNION ALL ".join(
    f"SELECT {i}::INTEGER AS position, '{c}' AS column_name, '{'categorical' if i < 5 else 'numeric'}' AS kind, "
    f"count({c}) AS filled_rows FROM fe_train" for i, c in enumerate(_FEATURES)))


# the hand-made node table as nested conditions, written out by hand
register("score_node_table", f"""SELECT {_PK},
    4.0::DOUBLE + 0.25::DOUBLE * CASE WHEN COALESCE(hist_30d_revenue, 0) <= 30000 THEN 1.5
        WHEN forecast_window_days <= 30 THEN -2.0 ELSE 0.75 END::DOUBLE + 0.25::DOUBLE * 0.5::DOUBLE AS log_q10,
    6.5::DOUBLE + 0.25::DOUBLE * CASE WHEN COALESCE(future_budget, 0) > 15000 THEN 3.25
        WHEN forecast_window_days <= 60 THEN -1.0 ELSE 2.0 END::DOUBLE
        + 0.25::DOUBLE * CASE WHEN forecast_window_days <= 30 THEN 0.125 ELSE -0.375 END::DOUBLE AS log_q50
    FROM fe_pred""")


# the hand-made node table on training rows, and what it scores in each rolling window
_LOG_Q10 = """4.0::DOUBLE + 0.25::DOUBLE * CASE WHEN COALESCE(hist_30d_revenue, 0) <= 30000 THEN 1.5
    WHEN forecast_window_days <= 30 THEN -2.0 ELSE 0.75 END::DOUBLE + 0.25::DOUBLE * 0.5::DOUBLE"""
_LOG_Q50 = """6.5::DOUBLE + 0.25::DOUBLE * CASE WHEN COALESCE(future_budget, 0) > 15000 THEN 3.25
    WHEN forecast_window_days <= 60 THEN -1.0 ELSE 2.0 END::DOUBLE
    + 0.25::DOUBLE * CASE WHEN forecast_window_days <= 30 THEN 0.125 ELSE -0.375 END::DOUBLE"""


def split_point(percent):
    return f"""(SELECT min(d) FROM (SELECT cutoff_date AS d, sum(count(*)) OVER (ORDER BY cutoff_date) AS upto,
        sum(count(*)) OVER () AS total FROM fe_train WHERE cutoff_date IS NOT NULL AND target_future_revenue IS NOT NULL GROUP BY cutoff_date)
        WHERE upto * 100 >= {percent} * total)"""


_POINTS = [50, 60, 70, 80, 90, 100]
_LOSS = ", ".join(f"{bround(f'avg(greatest({q} * (y - {c}), ({q} - 1) * (y - {c})))', 4)} AS pinball_{c}, "
                  f"{bround(f'avg(CASE WHEN y <= {c} THEN 1.0 ELSE 0.0 END)', 4)} AS coverage_{c}" for c, q in [("q10", 0.1), ("q50", 0.5)])
register("time_split", f"""SELECT forecast_id, COALESCE(cutoff_date <= {split_point(80).replace(' AND target_future_revenue IS NOT NULL', '')}, true) AS is_train
    FROM fe_train""")
register("rolling_metrics", "SELECT * FROM (WITH p AS (SELECT " + ", ".join(f"{split_point(k)} AS p{k}" for k in _POINTS) + f"""),
    r AS (SELECT cutoff_date AS d, greatest(target_future_revenue, 0.0) AS y, exp({_LOG_Q10}) AS q10, exp({_LOG_Q50}) AS q50
          FROM fe_train WHERE target_future_revenue IS NOT NULL),
    f AS (""" + " UNION ALL ".join(f"SELECT {k}::INTEGER AS fold, p{a} AS train_until, y, q10, q50, q50 - y AS e FROM r, p WHERE d > p{a} AND d <= p{b}"
                               for k, (a, b) in enumerate(zip(_POINTS, _POINTS[1:]))) + f""")
    SELECT fold, train_until, {_METRICS}, {_LOSS} FROM f GROUP BY fold, train_until)""")

# the dictionary, and prediction rows encoded by it
_LABELS = " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c}::VARCHAR AS label FROM fe_train WHERE target_future_revenue IS NOT NULL" for c in _FEATURES[:5])
_CODES = f"""SELECT column_name, label, count(*) AS rows,
    row_number() OVER (PARTITION BY column_name ORDER BY label NULLS FIRST) - 1 AS code FROM ({_LABELS}) GROUP BY column_name, label"""
register("label_codes", _CODES)
_NUMERIC = _FEATURES[5:]
_FIRST = {c: f"{len(_NUMERIC)} + " + (" + ".join(f"(SELECT count(*) FROM codes WHERE column_name = '{b}')" for b in _FEATURES[:i]) or "0") for i, c in enumerate(_FEATURES[:5])}
register("encode_features", f"SELECT * FROM (WITH codes AS ({_CODES}), m AS (SELECT " + ", ".join(
    f"avg(COALESCE({c}, 0)) AS m_{c}, stddev_pop(COALESCE({c}, 0)) AS d_{c}" for c in _NUMERIC)
    + " FROM fe_train WHERE target_future_revenue IS NOT NULL) SELECT forecast_id, concat_ws(',', " + ", ".join(
    f"(SELECT {_FIRST[c]} + code FROM codes WHERE column_name = '{c}' AND label IS NOT DISTINCT FROM fe_pred.{c})" for c in _FEATURES[:5])
    + ") AS one_hot_slots, " + ", ".join(bround(f"(COALESCE({c}, 0) - m_{c}) / CASE WHEN d_{c} > 0 THEN d_{c} ELSE 1 END", 4) + f" AS {c}" for c in _NUMERIC)
    + " FROM fe_pred, m)")
