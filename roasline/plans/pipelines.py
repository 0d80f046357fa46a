"""End-to-end jobs, each one lazy DAG from the exports to the sink.

``predict``  exports -> unified -> prediction set -> scores -> forecast table
``train``    exports -> unified -> training set -> quantile boosting -> model dir
``scenarios`` exports -> prediction set x scenarios -> comparison
``report``   forecast (+ comparison) -> insight and report tables
``audit``    exports -> unified -> data-quality report + profile
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roasline.operators import features as FE
from roasline.operators import insights as E
from roasline.operators import normalize as N
from roasline.operators import quality as Q
from roasline.operators import quantile as M
from roasline.operators import rollup as R
from roasline.operators import scenario as B
from roasline.operators import scoring as P
from roasline.session import ensure_checkpoint_dir
from roasline.sources import csv_io as S


def unified_from_dir(spark: SparkSession, data_dir: str, **options) -> DataFrame:
    return N.normalize_all(S.load_exports(spark, data_dir), **options)


def quarantine(spark: SparkSession, data_dir: str) -> dict[str, DataFrame]:
    """Lines that ``unified_from_dir`` leaves out and the counts of every file, to be written beside its forecast."""
    files = [path for paths in S.export_files(spark, data_dir).values() for path in paths]
    return {"quarantine": S.quarantined(spark, files), "quarantine_counts": S.quarantine_counts(spark, files)}


def audit(unified: DataFrame) -> dict[str, DataFrame]:
    return {"report": Q.quality_report(unified), "profile": Q.quality_profile(unified)}


def predict(unified: DataFrame, scorer: P.Scorer, cache: bool = True) -> DataFrame:
    """Forecast table; the campaign forecasts are cached because four levels reuse them."""
    cf = P.campaign_forecast(FE.prediction_set(N.dated_rows(unified), check_empty=True), scorer)
    if cache:
        cf = cf.cache()
    return R.forecast_table(cf)


def train(unified: DataFrame, params: M.QuantileBoostingParams | None = None, model_dir: str | None = None):
    training = FE.training_set(N.dated_rows(unified), check_empty=True)
    model, n_train, n_test = M.train(training, params)
    if model_dir:
        model.save(model_dir)
    return model, n_train, n_test


def scenarios(unified: DataFrame, plans: B.Scenarios | DataFrame, scorer: P.Scorer) -> DataFrame:
    prediction = FE.prediction_set(N.dated_rows(unified), check_empty=True).cache()
    return B.run_scenarios(prediction, plans, scorer)


def report(forecast: DataFrame, comparison: DataFrame | None = None) -> dict[str, DataFrame]:
    """Report tables, all from one stored copy of the forecast (in the shared checkpoint folder)."""
    ensure_checkpoint_dir(forecast.sparkSession)
    fc = E.forecast_contract(forecast).checkpoint()
    out = {
        "insights": E.insights_table(fc),
        "executive_summary": E.executive_summary(fc),
        "channel_leaderboard": E.channel_leaderboard(fc),
        "best_roas_channel": E.best_roas_channel(fc),
        "top_campaign_types": E.top_campaign_types(fc),
        "risk_watchlist": E.risk_watchlist(fc),
        "scaling_candidates": E.scaling_candidates(fc),
        "window_campaign_types": E.window_campaign_types(fc),
        "window_watchlist": E.window_watchlist(fc),
        "window_scaling": E.window_scaling(fc),
        "portfolio_summary": E.portfolio_summary(fc),
    }
    if comparison is not None:
        out["scenario_summary"] = E.scenario_interpretation(E.scenario_contract(comparison))
    return out


# Tables whose files are read in a presentation order.
ORDERED = {"unified": N.sort_unified, "forecast": R.sort_forecast, "insights": E.sort_insights}


def write_outputs(tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> None:
    """Write each table below ``out_dir``; those named in ``ORDERED`` in their presentation order."""
    for name, df in tables.items():
        S.write_table(ORDERED[name](df) if name in ORDERED else df, f"{out_dir}/{name}", fmt=fmt)
