"""The probes of the as-of query: distinct without a table of all of them in one task."""

import datetime as dt

from roasline.operators import features as FE
from roasline.plans import registry as RG

from conftest import SF_SMALL
from test_features_small import SCHEMA


def test_cutoffs_without_horizons_are_distinct(spark):
    """NULL keys, copies of a row and several rows a day: one probe for each campaign and cutoff."""
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=d) for d in range(0, 120, 3)]
    keys = [("Google Ads", "a", "n", "t"), ("Google Ads", None, None, None), ("Google Ads", "a", "n", None)]
    rows = [(day, *k, 1.0, 2.0, 1.0, 1.0, 1.0, 3.0) for day in days for k in keys for _ in range(2)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in FE.cutoff_spine(df, horizons=None).collect()]
    want = {tuple(r) for r in FE.cutoff_spine(df).select(*FE.GROUP_KEYS, "cutoff_date").collect()}
    assert len(got) == len(set(got)) == 3 * len(range(29, 117 - 30 + 1, 7)) and set(got) == want


def test_asof_holds_no_table_of_probes(spark):
    plan = RG.QUERIES["asof_latest"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    heads = [line for line in plan.splitlines() if "Aggregate [" in line]
    assert heads and not any("cutoff_date" in line for line in heads)
