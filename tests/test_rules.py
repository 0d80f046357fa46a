"""Branch tables for the row rules (confidence, risk, texts, scenarios, explanations).

Expected values are worked out by hand.
"""

import pytest
from pyspark.sql import functions as F

from roasline.operators import insights as E
from roasline.operators import rollup as R
from roasline.operators import scenario as B
from roasline.operators import scoring as P


def test_confidence_branches(spark):
    rows = [(0.0, 0.0, 0.0, 100.0, 20), (90.0, 100.0, 110.0, 100.0, 20), (0.0, 100.0, 500.0, 0.0, 3),
            (99.0, 100.0, 101.0, 100.0, 5), (10.0, 100.0, 300.0, -1.0, 50), (100.0, 100.0, 100.0, 1.0, 10)]
    df = spark.createDataFrame(rows, "l double, e double, h double, b double, r long")
    got = df.select(P.confidence_score(F.col("l"), F.col("e"), F.col("h"), F.col("b"), F.col("r"))).collect()
    # no revenue; width 7; floor after 60 + 15 + 10; width 0.7 and few rows; floor after 60 + 15; ceiling
    assert [g[0] for g in got] == pytest.approx([40.0, 93.0, 30.0, 89.3, 30.0, 95.0])


def test_risk_branches(spark):
    rows = [(0.5, 90.0, 1.0, 1.0), (3.0, 40.0, 1.0, 1.0), (3.0, 90.0, 1.5, 0.5), (1.5, 90.0, 1.0, 1.0),
            (3.0, 60.0, 1.0, 1.0), (3.0, 90.0, 1.0, 1.0), (3.0, 90.0, 1.31, 0.95)]
    df = spark.createDataFrame(rows, "roas double, conf double, st double, rt double")
    got = df.select(P.risk_level(F.col("roas"), F.col("conf"), F.col("st"), F.col("rt"))).collect()
    assert [g[0] for g in got] == ["High", "High", "High", "Medium", "Medium", "Low", "Low"]


def test_insight_texts(spark):
    rows = [("campaign", "Google Ads", "SEARCH", "Brand", 30, 2.125, "Low", 1.5, 0.5),
            ("campaign_type", "Meta Ads", "Remarketing", "x", 60, 0.5, "High", 1.0, 1.5),
            ("blended", "ALL", "ALL", "ALL", 90, 3.0, "Medium", 1.0, 0.7),
            ("channel", "Microsoft Ads", "ALL", "ALL", 30, 1.0, "Low", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "forecast_level string, channel string, campaign_type string, "
                                     "campaign_name string, forecast_window_days int, roas_expected double, "
                                     "risk_level string, spend_trend_7d_vs_30d double, revenue_trend_7d_vs_30d double")
    got = [r[0] for r in df.select(P.insight_summary(df)).collect()]
    assert got[0] == ("For the next 30 days, Google Ads campaign 'Brand' is forecasted with expected ROAS around "
                      f"{2.125:.2f}. Risk level is Low. The main reason is that recent spend is increasing faster "
                      "than revenue, which may reduce efficiency.")
    assert "Meta Ads Remarketing" in got[1] and "improving faster than spend" in got[1]
    assert "overall blended marketing performance" in got[2] and "momentum is weak" in got[2]
    assert got[3].startswith("For the next 30 days, Microsoft Ads is forecasted") and "relatively stable" in got[3]


def test_rollup_worst_risk_and_sums(spark):
    rows = [("Google Ads", "SEARCH", "1", "a", 30, 10.0, 1.0, 2.0, 3.0, 50.0, "Low"),
            ("Google Ads", "SEARCH", "2", "b", 30, 20.0, 2.0, 4.0, 6.0, 70.0, "Medium"),
            ("Meta Ads", "Generic", "3", "c", 30, 30.0, 3.0, 6.0, 9.0, 90.0, "High")]
    cf = spark.createDataFrame(rows, "channel string, campaign_type string, campaign_id string, campaign_name string, "
                                     "forecast_window_days int, future_budget double, revenue_low double, "
                                     "revenue_expected double, revenue_high double, confidence_score double, "
                                     "risk_level string")
    cf = cf.withColumns({"forecast_level": F.lit("campaign"), "forecast_start_date": F.lit(None).cast("date"),
                         "forecast_end_date": F.lit(None).cast("date"), "roas_low": F.lit(0.0),
                         "roas_expected": F.lit(0.0), "roas_high": F.lit(0.0), "forecast_id": F.lit("x"),
                         "insight_summary": F.lit("")})
    out = {(r.forecast_level, r.channel, r.campaign_type): r for r in R.rollup_levels(cf).collect()}
    assert out[("blended", "ALL", "ALL")].risk_level == "High"
    assert out[("channel", "Google Ads", "ALL")].risk_level == "Medium"
    assert out[("blended", "ALL", "ALL")].revenue_expected == 12.0
    assert out[("channel", "Google Ads", "ALL")].confidence_score == 60.0
    assert out[("campaign_type", "Meta Ads", "Generic")].roas_expected == 6.0 / 30.0
    assert out[("blended", "ALL", "ALL")].forecast_id == "blended_ALL_ALL_30"


def test_scenario_name_and_recommendation(spark):
    plans = {1: {"Google Ads": 1.2, "Meta Ads": 0.9, "Microsoft Ads": 1.0}, 2: {"Meta Ads": 0.5, "Google Ads": 2.0}}
    names = {n.scenario_id: n.scenario_name for n in B.scenario_names(B.scenario_table(spark, plans)).collect()}
    assert names == {1: "Google Ads: +20% | Meta Ads: -10% | Microsoft Ads: +0%", 2: "Meta Ads: -50% | Google Ads: +100%"}
    rows = [(1.0, 0.0), (1.0, -0.1), (0.0, 0.2), (-1.0, 0.0), (0.0, 0.0)]
    df = spark.createDataFrame(rows, "rc double, roc double")
    got = [r[0] for r in df.select(B.recommendation(F.col("rc"), F.col("roc"))).collect()]
    assert got == [B.ACTION_POSITIVE, B.ACTION_GROWTH_LOWER_ROAS, B.ACTION_EFFICIENCY, B.ACTION_WEAK, B.ACTION_WEAK]


def test_explanations_actions_priority(spark):
    rows = [("High", 0.5, 90.0, 10.0, 20.0, 30.0), ("High", 2.0, 40.0, 10.0, 20.0, 30.0),
            ("High", 2.0, 50.0, 0.0, 20.0, 30.0), ("High", 2.0, 50.0, 19.0, 20.0, 21.0),
            ("Medium", 3.0, 60.0, 1.0, 2.0, 3.0), ("Medium", 2.0, 60.0, 1.0, 2.0, 3.0),
            ("Low", 3.0, 70.0, 19.0, 20.0, 21.0), ("Low", 3.0, 70.0, 0.0, 20.0, 40.0), ("high", 1.0, 1.0, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "risk_level string, roas_expected double, confidence_score double, "
                                     "revenue_low double, revenue_expected double, revenue_high double")
    got = df.select(E.risk_explanation(), E.recommended_action(), E.risk_priority(), E.uncertainty_ratio()).collect()
    assert [g[0] for g in got[:4]] == [E.RISK_HIGH_ROAS, E.RISK_HIGH_CONF, E.RISK_HIGH_WIDE, E.RISK_HIGH_OTHER]
    assert got[4][0] == E.RISK_MEDIUM and got[6][0] == E.RISK_LOW
    assert [g[1] for g in got[:2]] == [E.ACT_HIGH_ROAS, E.ACT_HIGH]
    assert [g[1] for g in got[4:8]] == [E.ACT_MEDIUM_SCALE, E.ACT_MEDIUM, E.ACT_LOW_SCALE, E.ACT_LOW]
    assert [g[2] for g in got] == [1, 1, 1, 1, 2, 2, 3, 3, 1]
    assert got[8][3] == 1.0 and got[7][3] == 2.0


def test_scenarios_from_a_table(spark):
    rows = [("1", "Google Ads", 100.0, 30), ("2", "Meta Ads", 50.0, 30), ("3", None, 10.0, 60)]
    prediction = spark.createDataFrame(rows, "campaign_id string, channel string, future_budget double, forecast_window_days int")
    table = spark.createDataFrame(
        [(7, 0, "Google Ads", 1.5), (7, 0, "Meta Ads", None), (8, 0, "Meta Ads", 3.0), (8, 1, "Meta Ads", 2.0),
         (9, 0, None, None), (None, 0, "Google Ads", 9.0)], B.SCENARIO_SCHEMA)
    got = {(r.scenario_id, r.campaign_id): (r.budget_multiplier, r.future_budget, r.future_budget_per_day)
           for r in B.scenario_budgets(prediction, table).collect()}
    assert len(got) == 4 * 3
    assert got[7, "1"] == (1.5, 150.0, 5.0) and got[7, "2"][0] == 1.0 and got[8, "2"] == (2.0, 100.0, 100.0 / 30)
    assert all(got[i, c][0] == 1.0 for i, c in got if i in (0, 9) or c == "3")
    names = {r.scenario_id: r.scenario_name for r in B.scenario_names(table).collect()}
    assert names == {7: "Google Ads: +50% | Meta Ads: +0%", 8: "Meta Ads: +100%", 9: ""}
    assert B.scenario_budgets(prediction, table.limit(0)).count() == 3
    assert B.scenario_budgets(prediction.limit(0), table).count() == 0


def test_ten_thousand_scenarios(spark):
    rows = [("1", "Google Ads", 100.0, 30), ("2", "Meta Ads", 50.0, 30)]
    prediction = spark.createDataFrame(rows, "campaign_id string, channel string, future_budget double, forecast_window_days int")
    channel = F.element_at(F.array(F.lit("Google Ads"), F.lit("Meta Ads")), (F.col("n") + 1).cast("int"))

    def plans(many):
        return spark.range(1, many + 1).select(F.col("id").cast("int").alias("scenario_id"), F.explode(F.array(F.lit(0), F.lit(1))).alias("n")).select(
            "scenario_id", F.col("n").alias("position"), channel.alias("channel"), (F.col("scenario_id") / 1000 + F.col("n")).alias("multiplier"))

    def size(df):
        return len(df._jdf.queryExecution().optimizedPlan().toString())

    out = B.scenario_budgets(prediction, plans(10_000))
    wrong = out.where(F.col("budget_multiplier") != F.when(F.col("scenario_id") == 0, 1.0).otherwise(
        F.col("scenario_id") / 1000 + F.when(F.col("channel") == "Meta Ads", 1).otherwise(0)))
    assert out.count() == 2 * 10_001 and out.distinct().count() == 2 * 10_001 and wrong.count() == 0
    assert size(out) < size(B.scenario_budgets(prediction, plans(3))) + 200
