"""Features on hand-made campaigns against a brute-force loop over cutoffs.

The brute force restates the per-campaign loop (cutoffs every 7 days from
first+29 while cutoff <= last-30; for each horizon skip when the horizon ends
after the last date or holds no rows) with plain Python lists.
"""

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roasline.operators import features as FE

D0 = dt.date(2024, 1, 1)
KEYS = ("channel", "campaign_id", "campaign_name", "campaign_type")


def make_rows():
    rnd = random.Random(7)
    rows = []

    def add(cid, ctype, days):
        for d in days:
            for _ in range(1 + (d % 3 == 0)):          # duplicate campaign-days
                rows.append((D0 + dt.timedelta(days=d), "Google Ads", cid, f"name {cid}", ctype,
                             float(rnd.randint(0, 3)), round(rnd.uniform(0, 50), 2), float(rnd.randint(0, 9)),
                             float(rnd.randint(0, 90)), float(rnd.randint(0, 2)), round(rnd.uniform(-5, 80), 2)))

    add("59", "SEARCH", range(59))
    add("60", "SEARCH", range(60))
    add("61", "DISPLAY", range(61))
    add("gap", "SEARCH", list(range(0, 35)) + list(range(75, 200)))
    add("nulltype", None, range(0, 150, 2))
    return rows


SCHEMA = ("date date, channel string, campaign_id string, campaign_name string, campaign_type string, "
          "daily_budget double, spend double, clicks double, impressions double, conversions double, revenue double")


def brute_training(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1:5], []).append(r)
    out = {}
    for key, g in groups.items():
        first = min(r[0] for r in g)
        last = max(r[0] for r in g)
        cut = first + dt.timedelta(days=29)
        while cut <= last - dt.timedelta(days=30):
            for h in (30, 60, 90):
                end = cut + dt.timedelta(days=h)
                if end > last:
                    continue
                fut = [r for r in g if cut < r[0] <= end]
                if not fut:
                    continue
                hist7 = [r for r in g if cut - dt.timedelta(days=6) <= r[0] <= cut]
                hist30 = [r for r in g if cut - dt.timedelta(days=29) <= r[0] <= cut]
                hist90 = [r for r in g if cut - dt.timedelta(days=89) <= r[0] <= cut]
                fb = sum(r[5] for r in fut) / len(fut) * h
                if fb <= 0:
                    fb = sum(r[6] for r in fut)
                out[(key, cut, h)] = {
                    "hist_7d_rows": len(hist7),
                    "hist_30d_active_days": len({r[0] for r in hist30}),
                    "hist_90d_spend": round(sum(r[6] for r in hist90), 6),
                    "target_future_revenue": round(sum(r[10] for r in fut), 6),
                    "future_budget": round(fb, 6),
                    "campaign_age_days": (cut - first).days + 1,
                }
            cut += dt.timedelta(days=7)
    return out


def spark_training(spark, rows, partitions=None):
    df = spark.createDataFrame(rows, SCHEMA)
    if partitions:
        df = df.repartition(partitions)
    t = FE.training_set(df).collect()
    return {(tuple(r[k] for k in KEYS), r.cutoff_date, r.forecast_window_days): {
        "hist_7d_rows": r.hist_7d_rows, "hist_30d_active_days": r.hist_30d_active_days,
        "hist_90d_spend": round(r.hist_90d_spend, 6), "target_future_revenue": round(r.target_future_revenue, 6),
        "future_budget": round(r.future_budget, 6), "campaign_age_days": r.campaign_age_days} for r in t}


def test_training_matches_brute_force(spark):
    rows = make_rows()
    got = spark_training(spark, rows)
    want = brute_training(rows)
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-6), k
    # the 59-day campaign has no cutoff; the 60-day one has exactly one with a 30-day horizon
    assert not [k for k in got if k[0][1] == "59"]
    assert sorted(k[2] for k in got if k[0][1] == "60") == [30]
    assert [k for k in got if k[0][3] is None]


def test_prediction_cutoff_is_each_campaigns_last_date(spark):
    rows = make_rows()
    p = FE.prediction_set(spark.createDataFrame(rows, SCHEMA)).collect()
    last = {}
    for r in rows:
        last[r[2]] = max(last.get(r[2], r[0]), r[0])
    assert len(p) == 3 * len(last)
    for r in p:
        assert r.cutoff_date == last[r.campaign_id]
        assert r.forecast_id == f"predict_Google Ads_{r.campaign_id}_{r.forecast_window_days}_{r.cutoff_date}"


@settings(max_examples=3, deadline=None)
@given(st.integers(min_value=1, max_value=9))
def test_features_do_not_depend_on_partitioning(spark, n):
    rows = make_rows()
    random.Random(n).shuffle(rows)
    assert spark_training(spark, rows, partitions=n) == spark_training(spark, make_rows())


def test_nothing_to_predict_is_an_error(spark):
    import pytest

    from roasline.operators import features as FE
    from roasline.plans import registry as RG
    from conftest import SF_SMALL

    with pytest.raises(ValueError, match="nothing to predict"):
        FE.prediction_set(RG.dated(spark, SF_SMALL).where("false"), check_empty=True)


def test_infinite_and_huge_values_do_not_end_the_job(spark):
    import datetime as dt
    import math

    from roasline.operators import features as FE

    day = dt.date(2024, 1, 1)
    rows = [("Google Ads", "1", "a", "SEARCH", day + dt.timedelta(days=i), 1.0, 1e13 if i == 95 else 2.0,
             math.inf if i == 96 else 4.0, 1.0, 1.0, 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "channel string, campaign_id string, campaign_name string, campaign_type string, "
                                     "date date, daily_budget double, spend double, revenue double, clicks double, "
                                     "impressions double, conversions double")
    p = FE.prediction_set(df).first()
    assert p.hist_30d_spend == 1e13 + 58.0 and p.hist_30d_revenue == math.inf and p.hist_30d_clicks == 30.0
    t = {(r.cutoff_date, r.forecast_window_days): r for r in FE.training_set(df).collect()}
    assert t[(day + dt.timedelta(days=29), 30)].target_future_revenue == 120.0
    assert any(r.target_future_spend >= 1e13 for r in t.values())
