"""Frames from running sums: large and non-finite days, long campaigns, and what the plans read and store."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from roasline.functions import parse_date
from roasline.operators import features as FE
from roasline.plans import registry as RG

from conftest import SF_SMALL
from test_features_small import SCHEMA

D0 = dt.date(2020, 1, 1)


def test_large_days_are_added_frame_by_frame(spark):
    rnd = random.Random(3)
    value = {d: rnd.choice([1.5, -7.25, 3e8, -4e12, 1e15 + 0.5]) for d in range(0, 400, 2)}
    value[300] = math.inf
    rows = [(D0 + dt.timedelta(days=d), "Google Ads", "big", "n", "t", 1.0, 2.0, 1.0, 1.0, 1.0, v) for d, v in value.items()]
    got = {(r.cutoff_date - D0).days: r for r in FE.spine_features(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sorted(got) == list(range(29, 369, 7))
    for cut, row in got.items():
        for w in FE.WINDOWS:
            want = math.fsum(v for d, v in value.items() if cut - w < d <= cut) if not (cut - w < 300 <= cut) else math.inf
            assert row[f"hist_{w}d_revenue"] == want or abs(row[f"hist_{w}d_revenue"] - want) <= 16, (cut, w)   # two units in the last place of the largest sums
    future = {((r.cutoff_date - D0).days, r.forecast_window_days): r.target_future_revenue for r in FE.training_set(spark.createDataFrame(rows, SCHEMA)).collect()}
    for (cut, h), got_sum in future.items():
        want = math.fsum(v for d, v in value.items() if cut < d <= cut + h) if not (cut < 300 <= cut + h) else math.inf
        assert got_sum == want or abs(got_sum - want) <= 32, (cut, h)


def test_running_sums_of_a_long_campaign_do_not_overflow(spark):
    """30,000 days of almost 1e7: 3e19 units, more than a long holds."""
    df = spark.range(30_000).select(
        F.expr("date_add(date'1950-01-01', cast(id as int))").alias("date"), *[F.lit("a").alias(k) for k in FE.GROUP_KEYS],
        *[F.lit(9_999_999.0 if c == "revenue" else 1.0).alias(c) for c in ["daily_budget", *FE.SUMS]])
    row = FE.spine_features(df).agg(F.min("hist_90d_revenue"), F.max("hist_30d_revenue"), F.count("*")).first()
    assert row[0] < row[1] * 3 and row[1] == 30 * 9_999_999.0 and row[2] > 4000


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_frame_slides_over_its_rows(spark):
    """Every frame starts at the campaign's first row: the window adds a row once for each edge."""
    text = plan(RG.QUERIES["training_set"](spark, SF_SMALL))
    assert "RangeFrame, unboundedpreceding" in text
    frames = text.split("specifiedwindowframe(RangeFrame, ")[1:]
    assert {f.split(",")[0] for f in frames} == {"unboundedpreceding$()"}


def test_splits_store_only_the_columns_they_use(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(RG, "written", lambda rows, name: stored.append(rows.columns) or rows)
    RG.QUERIES["time_split"](spark, SF_SMALL)
    RG.QUERIES["rolling_metrics"](spark, SF_SMALL)
    assert stored[0] == ["forecast_id", "cutoff_date"]
    assert set(stored[1]) == {"cutoff_date", "target_future_revenue", "hist_30d_revenue", "future_budget", "forecast_window_days"}


def test_layouts_are_tried_in_their_order(spark):
    texts = ["2024-03-09", "03/09/2024", "2024/03/09", "20240309", "n/a", None, " 2024-03-09 11:12:13 "]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_date("t").alias("d")).collect()
    assert [r.d for r in rows] == [dt.date(2024, 3, 9)] * 4 + [None, None, dt.date(2024, 3, 9)]
    first = spark.createDataFrame([("10/11/2012",)], "t string").select(parse_date("t", formats=("dd/MM/yyyy", "MM/dd/yyyy")).alias("d")).first().d
    assert first == dt.date(2012, 11, 10)


def test_frames_are_few_sums_and_spine_rows_come_without_a_lambda(spark):
    """Ten running sums for each of the nine edges; the spine is generated in compiled code from rows in date order."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    text = FE.training_set(RG.dated(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    window = max((line for line in text.splitlines() if "Window [" in line), key=len)
    assert window.count("specifiedwindowframe(RangeFrame") == 10 * len(FE._EDGES)
    spine = next(line for line in text.splitlines() if "Generate posexplode" in line)
    assert "sequence(" in spine and "lambda" not in spine


def test_extreme_days_keep_their_last_unit(spark):
    """Negative and largest days whose low bits share a long, rows and days in another, over the whole range of dates."""
    low, high = -9_999_999.99999999, 9_999_999.99999999
    days = [dt.date(1, 1, 1), *[D0 + dt.timedelta(days=d) for d in range(0, 200)], dt.date(9999, 12, 31)]
    rows = [(d, "Google Ads", None, "n", "t", low, low, high, low, high, high if i % 2 else low) for i, d in enumerate(days)]
    cut = FE.spine_features(spark.createDataFrame(rows, SCHEMA)).where("cutoff_date between '2020-02-01' and '2020-06-01'").collect()
    assert len(cut) > 10
    for r in cut:
        inside = [x for x in rows if 0 <= (r.cutoff_date - x[0]).days < 30]
        assert (r.hist_30d_rows, r.hist_30d_active_days) == (30, 30) and len(inside) == 30
        units = sum(round(x[10] * 1e8) for x in inside)
        assert r.hist_30d_revenue == units / 1e8 and r.hist_30d_spend == -999_999_999_999_999 * 30 / 1e8 and r.hist_30d_clicks == 999_999_999_999_999 * 30 / 1e8
