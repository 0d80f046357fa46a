"""Column helpers: lenient parsing, safe division, rounding and number text."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roasline.functions import clean_numeric, fmt_fixed, money, parse_date, round_half_even, safe_divide


def test_clean_numeric(spark):
    rows = [(" 3 ",), ("1d",), ("inf",), ("1,000",), ("",), (None,), ("NaN",), ("-2.5e1",), ("n/a",), (".5",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(clean_numeric("s")).collect()]
    assert got[:3] == [3.0, 0.0, math.inf]
    assert got[3:] == [0.0, 0.0, 0.0, 0.0, -25.0, 0.0, 0.5]


def test_parse_date(spark):
    import datetime as dt

    rows = [("2024-01-02",), ("01/02/2024",), ("not-a-date",), (None,), ("2024-01-02 10:00:00",)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").select(parse_date("s")).collect()]
    assert got == [dt.date(2024, 1, 2), dt.date(2024, 1, 2), None, None, dt.date(2024, 1, 2)]


def test_safe_divide_forms(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (0.0, float("nan")), (float("inf"), 2.0), (3.0, 2.0)],
                               "n double, d double")
    scalar = [r[0] for r in df.select(safe_divide("n", "d")).collect()]
    clean = [r[0] for r in df.select(safe_divide("n", "d", clean_inf=True)).collect()]
    assert scalar[:3] == [0.0, 0.0, 0.0] and scalar[3] == math.inf and scalar[4] == 1.5
    assert clean == [0.0, 0.0, 0.0, 0.0, 1.5]


@pytest.mark.parametrize("digits", [2, 4])
def test_rounding_matches_numpy(spark, digits):
    vals = [55232.53635, 0.00005, 1.00015, 2.675, 1.005, -3.14159, 123456.789012]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(round_half_even("x", digits)).collect()]
    assert got == [float(np.round(v, digits)) for v in vals]


def test_number_text_matches_python(spark):
    vals = [0.125, 1234567.891, -0.5, 2.675, 1e9 + 0.005, 0.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    rows = df.select(fmt_fixed("x", 2), money("x"), fmt_fixed("x", 0)).collect()
    assert [r[0] for r in rows] == [f"{v:.2f}" for v in vals]
    assert [r[1] for r in rows] == [f"{v:,.2f}" for v in vals]
    assert [r[2] for r in rows] == [f"{v:.0f}" for v in vals]


def test_iso_dates_in_every_spelling(spark):
    texts = ["2024-01-02T10:00:00", "2024-01-02 10:00:00.000", "2024-1-2", "2024-01-02", "01/02/2024", "20240102", "2024", "2024-13-01", "n/a"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_date("t").cast("string").alias("d")).collect()
    assert [r.d for r in rows] == ["2024-01-02"] * 6 + [None] * 3


def test_sums_of_any_size(spark):
    from roasline.functions import parts_value, sum_parts

    rows = [("small", 1e-8)] * 3 + [("cents", 0.1)] * 10 + [("large", 9.3e12), ("large", 1.0), ("inf", math.inf),
            ("inf", 5.0), ("hot", 9.9e8)] + [("hot", 9.9e8)] * 20_000
    df = spark.createDataFrame(rows, "k string, x double").repartition(7)
    got = {r.k: r.v for r in df.groupBy("k").agg(*sum_parts("x", "s")).select("k", parts_value("s").alias("v")).collect()}
    assert got == {"small": 3e-8, "cents": 1.0, "large": 9.3e12 + 1.0, "inf": math.inf, "hot": 9.9e8 * 20_001}


def test_python_rounding(spark):
    from roasline.functions import round_decimal

    vals = [i / 1000 for i in range(1005, 100_000, 10)] + [math.inf, -0.125, 2.675]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "x double").select(round_decimal("x", 2)).collect()]
    assert got == [round(v, 2) if math.isfinite(v) else v for v in vals]
