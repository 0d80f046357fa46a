"""Query registry: one entry per operator of the inventory.

Every entry is ``fn(spark, sf_dir) -> DataFrame`` and reads the shared test
tables through the fixture exports, so its work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roasline.operators import normalize as N
from roasline.sources.fixtures import raw_exports

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn

    return deco


# ----------------------------------------------------------------- shared inputs
def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.normalize_all(raw_exports(spark, sf_dir))


def dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.dated_rows(unified(spark, sf_dir))


# ----------------------------------------------------------------- normalise
@query("normalize_google")
def q_normalize_google(spark, sf_dir):
    return N.normalize_google(raw_exports(spark, sf_dir)["google"])


@query("normalize_bing")
def q_normalize_bing(spark, sf_dir):
    return N.normalize_bing(raw_exports(spark, sf_dir)["bing"])


@query("normalize_meta")
def q_normalize_meta(spark, sf_dir):
    return N.normalize_meta(raw_exports(spark, sf_dir)["meta"])


@query("unified_campaigns")
def q_unified(spark, sf_dir):
    return unified(spark, sf_dir)


@query("dated_rows")
def q_dated(spark, sf_dir):
    return dated(spark, sf_dir)


# ----------------------------------------------------------------- column helpers
from pyspark.sql import functions as F  # noqa: E402

from roasline.functions import clean_numeric, parse_date, safe_divide  # noqa: E402


@query("clean_numeric")
def q_clean_numeric(spark, sf_dir):
    raw = raw_exports(spark, sf_dir)
    texts = [("google", "metrics_clicks"), ("bing", "Clicks"), ("meta", "clicks"), ("bing", "Spend"), ("meta", "conversion")]
    parts = [raw[p].select(F.lit(p).alias("platform"), F.lit(c).alias("column_name"), F.col(c).alias("text"),
                           clean_numeric(c).alias("value")) for p, c in texts]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# l_shipdate written in the layouts that exports use; one in eight is no date
DATE_TEXTS = ["yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSS", "yyyy-M-d", "MM/dd/yyyy",
              "yyyy/MM/dd", "yyyyMMdd", "'n/a' yyyy"]


@query("parse_dates")
def q_parse_dates(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_shipdate")
    layout = (F.col("l_orderkey") % len(DATE_TEXTS)).cast("int")
    ship = F.col("l_shipdate").cast("timestamp")
    text = F.element_at(F.array(*[F.date_format(ship, f) for f in DATE_TEXTS]), layout + 1)
    return li.select("l_orderkey", "l_linenumber", layout.alias("layout"), parse_date(text).alias("date"))


@query("meta_campaign_type")
def q_meta_campaign_type(spark, sf_dir):
    meta = raw_exports(spark, sf_dir)["meta"]
    return meta.select("campaign_id", "campaign_name", N.meta_campaign_type("campaign_name").alias("campaign_type"))


@query("safe_divide")
def q_safe_divide(spark, sf_dir):
    return unified(spark, sf_dir).select(
        "channel", "campaign_id", "date", "clicks", "impressions",
        safe_divide("clicks", "impressions").alias("scalar_rule"),
        safe_divide("clicks", "impressions", clean_inf=True).alias("column_rule"))


@query("rate_metrics")
def q_rate_metrics(spark, sf_dir):
    measures = unified(spark, sf_dir).select("channel", "campaign_id", "date", *N.MEASURES)
    return N.rate_metrics(measures)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predict entry point: exports -> features -> scores -> four-level forecast table."""
    return forecast_tbl(spark, sf_dir)


# ----------------------------------------------------------------- sources
from roasline.sources import csv_io as S  # noqa: E402


@query("source_discovery")
def q_source_discovery(spark, sf_dir):
    """Export file names made of the order months (three platforms, several files each), dealt to platforms."""
    months = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.date_format("o_orderdate", "yyyy-MM").alias("m")).distinct()
    stems = F.array(*[F.lit(s) for s in ("google_ads_", "MS_Ads-", "Facebook ", "notes_")])
    names = months.select(F.explode(stems).alias("stem"), "m").select(F.concat("stem", "m", F.lit(".csv")).alias("file_name"))
    return S.platform_of(names, "file_name").where(F.col("platform").isNotNull())


def export_lines(spark, sf_dir):
    """CSV lines of the Google export with planted faults: a field too few, one too many, quotes never closed, quotes well used."""
    raw = raw_exports(spark, sf_dir)["google"]
    fields = [F.coalesce(F.col(c), F.lit("")) for c in raw.columns]
    name = raw.columns.index("campaign_name")
    fault = F.col("metrics_impressions").cast("int") % 10
    fields[name] = F.when(fault == 3, F.concat(F.lit('"'), fields[name], F.lit('"'))).when(fault == 4, F.concat(F.lit('"a ""'), fields[name], F.lit('"""'))).otherwise(fields[name])
    last = F.when(fault == 0, F.lit("")).when(fault == 1, F.concat(F.lit(","), fields[-1], F.lit(",more"))).when(
        fault == 2, F.concat(F.lit(',"'), fields[-1])).otherwise(F.concat(F.lit(","), fields[-1]))
    return raw.select(F.concat(F.concat_ws(",", *fields[:-1]), last).alias("value")), tuple(raw.columns)


@query("csv_rows")
def q_csv_rows(spark, sf_dir):
    rows = S.parse_lines(*export_lines(spark, sf_dir))
    return rows.where(F.col(S.CORRUPT).isNull()).drop(S.CORRUPT)


@query("csv_quarantine")
def q_csv_quarantine(spark, sf_dir):
    rows = S.parse_lines(*export_lines(spark, sf_dir))
    return rows.where(F.col(S.CORRUPT).isNotNull()).select(F.col(S.CORRUPT).alias("line"))


@query("dataset_summary")
def q_dataset_summary(spark, sf_dir):
    return S.dataset_summary(raw_exports(spark, sf_dir))


# ----------------------------------------------------------------- audit
from roasline.operators import quality as Q  # noqa: E402

for _name, _check in [("dq_required_columns", "required_columns"), ("dq_missing", "missing_values"),
                      ("dq_negative", "negative_values"), ("dq_dates", "invalid_dates"),
                      ("dq_duplicates", "duplicates"), ("dq_zero_activity", "zero_activity"),
                      ("dq_roas_outliers", "roas_outliers")]:
    QUERIES[_name] = (lambda c: lambda spark, sf_dir: Q.check(unified(spark, sf_dir), c))(_check)


@query("dq_report")
def q_dq_report(spark, sf_dir):
    return Q.quality_report(unified(spark, sf_dir))


@query("dq_profile")
def q_dq_profile(spark, sf_dir):
    return Q.quality_profile(unified(spark, sf_dir))


# ----------------------------------------------------------------- features
from roasline.operators import features as FE  # noqa: E402

_K = FE.GROUP_KEYS


@query("period_aggregate")
def q_period_aggregate(spark, sf_dir):
    return FE.period_aggregate(dated(spark, sf_dir), "1998-01-01", "1998-12-31")


@query("cutoff_spine")
def q_cutoff_spine(spark, sf_dir):
    return FE.cutoff_spine(dated(spark, sf_dir))


@query("trailing_features")
def q_trailing(spark, sf_dir):
    return FE.spine_features(dated(spark, sf_dir)).select(*_K, "cutoff_date", *FE.HIST_COLUMNS)


@query("trend_features")
def q_trends(spark, sf_dir):
    return FE.spine_features(dated(spark, sf_dir)).select(*_K, "cutoff_date", *FE.TREND_COLUMNS)


@query("calendar_features")
def q_calendar(spark, sf_dir):
    return FE.training_set(dated(spark, sf_dir)).select(
        "forecast_id", *_K, "cutoff_date", "forecast_start_date", "forecast_end_date", "forecast_window_days",
        "campaign_age_days", "forecast_month", "forecast_quarter", "forecast_year")


@query("training_set")
def q_training(spark, sf_dir):
    return FE.training_set(dated(spark, sf_dir))


@query("prediction_set")
def q_prediction(spark, sf_dir):
    return FE.prediction_set(dated(spark, sf_dir))


@query("future_budget")
def q_future_budget(spark, sf_dir):
    return FE.prediction_set(dated(spark, sf_dir)).select(
        *_K, "forecast_window_days", "hist_30d_avg_daily_budget", "hist_30d_spend", "hist_30d_active_days",
        "future_budget", "future_budget_per_day")


@query("asof_latest")
def q_asof(spark, sf_dir):
    d = dated(spark, sf_dir)
    probes = FE.cutoff_spine(d, horizons=None)      # the bounds are few, so one task may make most probes: none are held to be compared
    return FE.asof_latest(d, probes)


# ----------------------------------------------------------------- scoring, roll-up
from roasline.operators import rollup as R  # noqa: E402
from roasline.operators import scoring as P  # noqa: E402

_PK = [*_K, "forecast_window_days"]


def prediction(spark, sf_dir):
    return FE.prediction_set(dated(spark, sf_dir))


def campaign_fc(spark, sf_dir):
    return P.campaign_forecast(prediction(spark, sf_dir), P.linear_rule_scorer)


def forecast_tbl(spark, sf_dir):
    return R.forecast_table(campaign_fc(spark, sf_dir))


@query("monotone_quantiles")
def q_monotone(spark, sf_dir):
    return P.monotone_quantiles(P.linear_rule_scorer(prediction(spark, sf_dir))).select(*_PK, *P.REVENUE_COLS)


@query("forecast_roas")
def q_forecast_roas(spark, sf_dir):
    df = P.forecast_roas(P.monotone_quantiles(P.linear_rule_scorer(prediction(spark, sf_dir))))
    return df.select(*_PK, "future_budget", *P.ROAS_COLS)


@query("confidence_score")
def q_confidence(spark, sf_dir):
    return campaign_fc(spark, sf_dir).select(*_PK, *P.REVENUE_COLS, "future_budget", "hist_30d_rows",
                                             "confidence_score")


@query("risk_level")
def q_risk(spark, sf_dir):
    return campaign_fc(spark, sf_dir).select(*_PK, "roas_expected", "confidence_score", "spend_trend_7d_vs_30d",
                                             "revenue_trend_7d_vs_30d", "risk_level")


@query("forecast_insight")
def q_insight(spark, sf_dir):
    return campaign_fc(spark, sf_dir).select(*_PK, "insight_summary")


@query("campaign_forecast")
def q_campaign_forecast(spark, sf_dir):
    return campaign_fc(spark, sf_dir)


@query("forecast_table")
def q_forecast_table(spark, sf_dir):
    return forecast_tbl(spark, sf_dir)


for _lvl in ("channel", "campaign_type", "blended"):
    QUERIES[f"rollup_{_lvl}"] = (lambda l: lambda spark, sf_dir: R.level(forecast_tbl(spark, sf_dir), l))(_lvl)


@query("forecast_level_counts")
def q_level_counts(spark, sf_dir):
    return R.level_counts(forecast_tbl(spark, sf_dir))


# ----------------------------------------------------------------- scenarios
from roasline.operators import scenario as B  # noqa: E402

# the example plan scored by the registered scenario queries (a user input)
EXAMPLE_SCENARIOS = {1: {"Google Ads": 1.2, "Meta Ads": 0.9, "Microsoft Ads": 1.0}}


def comparison(spark, sf_dir):
    return B.run_scenarios(prediction(spark, sf_dir), EXAMPLE_SCENARIOS, P.linear_rule_scorer)


@query("scenario_budget")
def q_scenario_budget(spark, sf_dir):
    return B.scenario_budgets(prediction(spark, sf_dir), EXAMPLE_SCENARIOS).select(
        *_PK, "scenario_id", "budget_multiplier", "future_budget", "future_budget_per_day")


@query("scenario_forecast")
def q_scenario_forecast(spark, sf_dir):
    return B.scenario_forecast(prediction(spark, sf_dir), EXAMPLE_SCENARIOS, P.linear_rule_scorer)


@query("scenario_join")
def q_scenario_join(spark, sf_dir):
    c = comparison(spark, sf_dir)
    return c.select("scenario_id", *B.COMPARISON_KEYS, *[x for x in c.columns if x.startswith(("baseline_", "scenario_"))
                                                         and x not in ("scenario_id", "scenario_recommendation",
                                                                       "scenario_name")])


@query("scenario_deltas")
def q_scenario_deltas(spark, sf_dir):
    return comparison(spark, sf_dir).select("scenario_id", *B.COMPARISON_KEYS, *B.DELTA_COLUMNS)


@query("scenario_recommendation")
def q_scenario_reco(spark, sf_dir):
    return comparison(spark, sf_dir).select("scenario_id", *B.COMPARISON_KEYS, "scenario_recommendation")


@query("scenario_comparison")
def q_scenario_comparison(spark, sf_dir):
    return comparison(spark, sf_dir)


@query("scenario_name")
def q_scenario_name(spark, sf_dir):
    return comparison(spark, sf_dir).select("scenario_id", "scenario_name").distinct()


@query("scenario_blended")
def q_scenario_blended(spark, sf_dir):
    return B.blended_impact(comparison(spark, sf_dir))


def scenario_catalogue(spark, sf_dir):
    """A catalogue of budget plans as data: one scenario per nation of the customers, channels it has no customers for left out."""
    channel = F.element_at(F.array(F.lit("Google Ads"), F.lit("Microsoft Ads"), F.lit("Meta Ads")), (F.col("c_custkey") % 3 + 1).cast("int"))
    return (spark.read.parquet(f"{sf_dir}/customer.parquet")
            .groupBy((F.col("c_nationkey") + 1).cast("int").alias("scenario_id"), (F.col("c_custkey") % 3).cast("int").alias("position"), channel.alias("channel"))
            .agg(((F.sum("c_custkey") % 101 + 50).cast("double") / 100).alias("multiplier")))


@query("scenario_catalogue_budget")
def q_catalogue_budget(spark, sf_dir):
    return B.scenario_budgets(prediction(spark, sf_dir), scenario_catalogue(spark, sf_dir)).select(
        *_PK, "scenario_id", "budget_multiplier", "future_budget", "future_budget_per_day")


@query("scenario_catalogue_names")
def q_catalogue_names(spark, sf_dir):
    return B.scenario_names(scenario_catalogue(spark, sf_dir))


@query("scenario_catalogue_comparison")
def q_catalogue_comparison(spark, sf_dir):
    return B.run_scenarios(prediction(spark, sf_dir), scenario_catalogue(spark, sf_dir), P.linear_rule_scorer)


# ----------------------------------------------------------------- contracts, insights
from roasline.operators import insights as E  # noqa: E402


def fx(spark, sf_dir):
    return E.forecast_contract(forecast_tbl(spark, sf_dir))


_FK = ["forecast_level", "channel", "campaign_type", "campaign_id", "campaign_name", "forecast_window_days"]


@query("forecast_contract")
def q_forecast_contract(spark, sf_dir):
    return fx(spark, sf_dir)


@query("scenario_contract")
def q_scenario_contract(spark, sf_dir):
    return E.scenario_contract(comparison(spark, sf_dir))


def stored_as_text(df, planted):
    """``df`` as a text file would give it back: numbers as text, with ``planted`` {column: (condition, text)} instead."""
    return df.withColumns({c: F.when(F.expr(where), F.lit(text)).otherwise(F.col(c).cast("string")) for c, (where, text) in planted.items()})


@query("scenario_contract_text")
def q_scenario_contract_text(spark, sf_dir):
    return E.scenario_contract(stored_as_text(comparison(spark, sf_dir), {
        "baseline_budget": ("forecast_level = 'channel'", "n/a"), "revenue_change": ("forecast_window_days = 60", None),
        "roas_change": ("channel = 'Meta Ads'", ""), "scenario_budget": ("forecast_level = 'blended'", "NaN")}))


@query("forecast_contract_text")
def q_forecast_contract_text(spark, sf_dir):
    return E.forecast_contract(stored_as_text(forecast_tbl(spark, sf_dir), {
        "future_budget": ("forecast_level = 'channel'", "unknown"), "revenue_low": ("forecast_window_days = 60", None),
        "roas_expected": ("channel = 'Meta Ads'", ""), "channel": ("forecast_level = 'blended'", None)}))


@query("level_window_slice")
def q_level_window(spark, sf_dir):
    return E.level_window_slice(fx(spark, sf_dir), "campaign", 30)


@query("uncertainty_ratio")
def q_uncertainty(spark, sf_dir):
    return fx(spark, sf_dir).select(*_FK, E.uncertainty_ratio().alias("uncertainty_ratio"))


@query("risk_explanation")
def q_risk_expl(spark, sf_dir):
    return fx(spark, sf_dir).select(*_FK, "risk_level", E.risk_explanation().alias("risk_explanation"))


@query("recommended_action")
def q_action(spark, sf_dir):
    return fx(spark, sf_dir).select(*_FK, "risk_level", E.recommended_action().alias("recommended_action"))


@query("insights_table")
def q_insights(spark, sf_dir):
    return E.insights_table(fx(spark, sf_dir))


@query("executive_summary")
def q_exec(spark, sf_dir):
    return E.executive_summary(fx(spark, sf_dir))


@query("channel_leaderboard")
def q_leaderboard(spark, sf_dir):
    return E.channel_leaderboard(fx(spark, sf_dir))


@query("best_roas_channel")
def q_best_roas(spark, sf_dir):
    return E.best_roas_channel(fx(spark, sf_dir))


@query("top_campaign_types")
def q_top_types(spark, sf_dir):
    return E.top_campaign_types(fx(spark, sf_dir), 10)


@query("risk_watchlist")
def q_watchlist(spark, sf_dir):
    return E.risk_watchlist(fx(spark, sf_dir), 15)


@query("scaling_candidates")
def q_scaling(spark, sf_dir):
    return E.scaling_candidates(fx(spark, sf_dir), 15)


@query("window_campaign_types")
def q_window_types(spark, sf_dir):
    return E.window_campaign_types(fx(spark, sf_dir))


@query("window_watchlist")
def q_window_watchlist(spark, sf_dir):
    return E.window_watchlist(fx(spark, sf_dir))


@query("window_scaling")
def q_window_scaling(spark, sf_dir):
    return E.window_scaling(fx(spark, sf_dir))


@query("portfolio_summary")
def q_portfolio(spark, sf_dir):
    return E.portfolio_summary(fx(spark, sf_dir))


@query("scenario_report")
def q_scenario_report(spark, sf_dir):
    return E.scenario_interpretation(E.scenario_contract(comparison(spark, sf_dir)))


# ----------------------------------------------------------------- model
import pandas as pd  # noqa: E402

from roasline.functions import round_half_even  # noqa: E402
from roasline.functions.numbering import written  # noqa: E402
from roasline.operators import encode as EN  # noqa: E402
from roasline.operators import quantile as M  # noqa: E402
from roasline.sources import fixtures as FX  # noqa: E402

_MODELS: dict = {}


def training(spark, sf_dir):
    return FE.training_set(dated(spark, sf_dir))


def fitted(spark, sf_dir):
    """Fit once per session and data folder; the model queries share it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        _MODELS[key] = M.train(training(spark, sf_dir))
    return _MODELS[key]


def node_table_walk(spark):
    """The hand-made node table walked for each row."""
    nodes = pd.DataFrame(FX.TREE_NODES, columns=FX.TREE_COLUMNS)
    walk = M.tree_walker(spark, nodes, FX.TREE_START, FX.TREE_RATE, FX.TREE_DEPTH)
    return walk(F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FX.TREE_FEATURES]))


@query("train_clean")
def q_train_clean(spark, sf_dir):
    return M.train_clean(training(spark, sf_dir))


@query("feature_columns")
def q_feature_columns(spark, sf_dir):
    return M.feature_profile(M.train_clean(training(spark, sf_dir)))


@query("align_features")
def q_align(spark, sf_dir):
    """The prediction set without two trained features and with NULLs planted in a third."""
    p = prediction(spark, sf_dir)
    cut = p.drop("hist_7d_spend", "campaign_type").withColumn(
        "hist_14d_spend", F.when(F.col("forecast_window_days") > 30, F.col("hist_14d_spend")))
    nums = ["hist_7d_spend", "hist_14d_spend", "hist_30d_spend"]
    return M.align_features(cut, ["channel", "campaign_type"], nums).select(
        "forecast_id", "channel", "campaign_type", *nums)


@query("holdout_split")
def q_holdout(spark, sf_dir):
    t = training(spark, sf_dir)
    return t.select("forecast_id", M.holdout_split(t).alias("is_train"))


@query("label_codes")
def q_label_codes(spark, sf_dir):
    """The dictionary of all categorical columns of the training set."""
    return EN.label_codes(M.train_clean(training(spark, sf_dir)), M.CATEGORICAL_COLUMNS)


@query("encode_features")
def q_encode(spark, sf_dir):
    """Every prediction row encoded by a dictionary and a scale of the training set.

    Both are aggregates, so the training set is made for each and never stored: it takes far more
    disk than the shuffles that make it, and the dictionary needs few of its columns.
    """
    clean = M.train_clean(training(spark, sf_dir))
    _, cats, nums = M.feature_columns(clean)
    codes, scale = EN.label_codes(clean, cats), EN.fit_scale(clean, nums)
    out = EN.sparse_features(prediction(spark, sf_dir), codes, scale, cats, nums)
    known = F.array_join(F.transform(F.slice("slots", len(nums) + 1, len(cats)), lambda x: x.cast("string")), ",")
    scaled = [round_half_even(F.col("slot_values")[i], 4).alias(c) for i, c in enumerate(nums)]
    return out.select("forecast_id", known.alias("one_hot_slots"), *scaled)


@query("time_split")
def q_time_split(spark, sf_dir):
    return M.time_split(written(training(spark, sf_dir).select("forecast_id", "cutoff_date"), "split-training")).select("forecast_id", "is_train")


@query("rolling_metrics")
def q_rolling_metrics(spark, sf_dir):
    """Metrics of every rolling test window, of predictions by the hand-made node table."""
    clean = M.train_clean(training(spark, sf_dir)).select("cutoff_date", M.TARGET_COLUMN, *FX.TREE_FEATURES)
    folds = M.rolling_windows(written(clean, "rolling-training"))
    scored = folds.withColumn("s", node_table_walk(spark)).select(
        "fold", "train_until", M.TARGET_COLUMN, F.exp("s._log_revenue_q10").alias("q10"), F.exp("s._log_revenue_q50").alias("q50"))
    stored = written(scored, "rolling-predictions")
    return M.quantile_metrics(stored, ["fold", "train_until"], M.TARGET_COLUMN, {"q10": ("q10", 0.1), "q50": ("q50", 0.5)}, "q50")


@query("model_metrics")
def q_model_metrics(spark, sf_dir):
    """Hold-out rows only, scored by the fitted model."""
    model, _, _ = fitted(spark, sf_dir)
    t = training(spark, sf_dir)
    scored = model.scorer(M.train_clean(t.where(~M.holdout_split(t))))
    clipped = scored.withColumns({c: F.greatest(F.col(c), F.lit(0.0)) for c in M.RAW_NAMES.values()})
    return M.quantile_metrics(clipped, ["forecast_window_days"], M.TARGET_COLUMN, {c: (c, M.QUANTILES[n]) for n, c in M.RAW_NAMES.items()}, "raw_q50")


@query("fit_quantile_models")
def q_fit(spark, sf_dir):
    model, _, _ = fitted(spark, sf_dir)
    return model.node_table(spark)


@query("score_quantiles")
def q_score(spark, sf_dir):
    model, _, _ = fitted(spark, sf_dir)
    return model.scorer(prediction(spark, sf_dir)).select(*_PK, "raw_q10", "raw_q50", "raw_q90")


@query("score_node_table")
def q_score_nodes(spark, sf_dir):
    """Every prediction row walked through a hand-made node table."""
    scored = prediction(spark, sf_dir).withColumn("s", node_table_walk(spark))
    return scored.select(*_PK, F.col("s._log_revenue_q10").alias("log_q10"), F.col("s._log_revenue_q50").alias("log_q50"))


@query("campaign_forecast_model")
def q_forecast_model(spark, sf_dir):
    model, _, _ = fitted(spark, sf_dir)
    return R.forecast_table(P.campaign_forecast(prediction(spark, sf_dir), model.scorer))


@query("regression_metrics")
def q_metrics(spark, sf_dir):
    t = training(spark, sf_dir)
    s = P.linear_rule_scorer(M.train_clean(t.where(~M.holdout_split(t))))
    s = s.withColumn("prediction", F.greatest(F.col("raw_q50"), F.lit(0.0)))
    return M.regression_metrics(s, M.TARGET_COLUMN, "prediction")


@query("model_card")
def q_model_card(spark, sf_dir):
    model, ntr, nte = fitted(spark, sf_dir)
    return M.model_card(spark, model, ntr, nte)
