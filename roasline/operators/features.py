"""Time-series features: period aggregates, trailing windows, cutoff spine,
training targets and the prediction set.

Plan shape (see ``training_set``):

1. ``daily``: one row per (campaign, date) with exact sums in long units.  This is
   the only aggregation over raw rows; partial aggregation runs map-side, so a
   campaign holding a third of all rows still ships one row per day and task.
2. ``cutoff_spine``: per campaign, cutoffs every 7 days (a tiny table).
3. ``daily ∪ spine``, one shuffle by the four campaign keys, one sort, and running
   sums up to the edges of all trailing (w days up to the cutoff) and leading (h days
   after it) frames in a single window pass; then keep the spine rows, whose frames
   are differences of two running sums.

A campaign's rows sit in one task after step 1, but that is at most one row per
calendar day, so the task size is bounded by the calendar, not by volume.  No
range join is used: each row would otherwise match ~13 cutoffs per direction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roasline.functions import divide_sql, exact_sum_parts, join_parts, safe_divide, units_sql
from roasline.operators.normalize import GROUP_KEYS

# Forecast horizons, trailing windows and the spine rule.
HORIZONS = [30, 60, 90]
WINDOWS = [7, 14, 30, 60, 90]
MIN_HISTORY_DAYS = 30
STEP_DAYS = 7

SUMS = ["spend", "revenue", "clicks", "impressions", "conversions"]
AGG_SUFFIXES = ["rows", "active_days", "spend", "revenue", "clicks", "impressions", "conversions",
                "avg_daily_budget", "ctr", "cpc", "cpm", "conversion_rate", "roas"]
TREND_COLUMNS = ["spend_trend_7d_vs_30d", "revenue_trend_7d_vs_30d", "roas_trend_7d_vs_30d"]
TARGET_COLUMNS = ["target_future_spend", "target_future_revenue", "target_future_clicks",
                  "target_future_impressions", "target_future_conversions", "target_future_roas"]
ID_COLUMNS = ["forecast_id", "mode", "forecast_level", "channel", "campaign_id", "campaign_name", "campaign_type",
              "cutoff_date", "forecast_start_date", "forecast_end_date", "forecast_window_days",
              "campaign_age_days", "forecast_month", "forecast_quarter", "forecast_year"]
HIST_COLUMNS = [f"hist_{w}d_{s}" for w in WINDOWS for s in AGG_SUFFIXES]
BUDGET_COLUMNS = ["future_budget", "future_budget_per_day"]
PREDICTION_COLUMNS = ID_COLUMNS + HIST_COLUMNS + TREND_COLUMNS + BUDGET_COLUMNS
TRAINING_COLUMNS = PREDICTION_COLUMNS + TARGET_COLUMNS

# text standing in for a NULL key inside the forecast id
NULL_TEXT = "nan"

_SUMMED = SUMS + ["budget"]
_PARTS = [f"{c}_{k}" for c in _SUMMED for k in "ux"]   # long units, and what is too large for them

# Running sums of the units are kept as units >> _SHIFT and the bits below, two measures' bits in one long; rows and days
# share another.  With all days of the years 1 to 9999 in one campaign none of them overflows (below 2.2e12 rows).
_SHIFT, _LOW, _DAYS = 9, 32, 22
_PAIRS = list(zip(_SUMMED[::2], _SUMMED[1::2]))
# Edges of the frames as days from the cutoff: c the cutoff, b<w> the last day before a trailing window, f<h> a horizon's end.
_EDGES = {"c": 0, **{f"b{w}": -w for w in WINDOWS}, **{f"f{h}": h for h in HORIZONS}}


# --------------------------------------------------------------------------- daily
def daily(df: DataFrame, keys: list[str] = GROUP_KEYS) -> DataFrame:
    """One row per (campaign, date): row count and exact sums (``join_parts``)."""
    g = (
        df.where(F.col("date").isNotNull())
        .groupBy(*keys, "date")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *exact_sum_parts({**{c: c for c in SUMS}, "budget": "daily_budget"}),
        )
    )
    return g.select(*keys, "date", "n", *[x for c in _SUMMED for x in join_parts(c)], F.lit(1).alias("has"))


def _values(name) -> dict[str, str]:
    """Measure -> its sum as SQL text; ``name(measure, "u" | "x")`` names the two parts."""
    return {c: units_sql(name(c, "u"), name(c, "x")) for c in _SUMMED}


def _period_metrics(prefix: str, rows: str, days: str, sums: dict[str, str]) -> list[Column]:
    """The 13 period columns from a row count, a day count and the sums of the measures (all SQL text)."""
    texts = {
        "rows": f"CAST({rows} AS BIGINT)",
        "active_days": f"CAST({days} AS BIGINT)",
        **{c: sums[c] for c in SUMS},
        "avg_daily_budget": divide_sql(sums["budget"], rows),
        "ctr": divide_sql(sums["clicks"], sums["impressions"]),
        "cpc": divide_sql(sums["spend"], sums["clicks"]),
        "cpm": f"({divide_sql(sums['spend'], sums['impressions'])}) * 1000D",
        "conversion_rate": divide_sql(sums["conversions"], sums["clicks"]),
        "roas": divide_sql(sums["revenue"], sums["spend"]),
    }
    return [F.expr(f"{text} AS {prefix}_{name}") for name, text in texts.items()]


def period_aggregate(df: DataFrame, start: str, end: str, keys: list[str] = GROUP_KEYS,
                     prefix: str = "period") -> DataFrame:
    """The 13 period metrics of each campaign over ``[start, end]`` (inclusive).

    A campaign without rows in the period has no output row.
    """
    d = daily(df.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))), keys)
    g = d.groupBy(*keys).agg(
        F.sum("n").alias("_n"), F.count(F.lit(1)).alias("_days"),
        *[F.sum(p).alias(f"_{p}") for p in _PARTS],
    )
    return g.select(*keys, *_period_metrics(prefix, "_n", "_days",
                                            _values(lambda c, k: f"_{c}_{k}")))


# --------------------------------------------------------------------------- spine
def campaign_bounds(d: DataFrame, keys: list[str] = GROUP_KEYS) -> DataFrame:
    return d.groupBy(*keys).agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def spine_dates(bounds: DataFrame, min_history_days: int = MIN_HISTORY_DAYS, step_days: int = STEP_DAYS,
                min_horizon: int = min(HORIZONS)) -> DataFrame:
    """Cutoffs first+(min_history-1), every ``step_days``, up to last-min_horizon."""
    s = F.date_add("first_date", min_history_days - 1)
    e = F.date_sub("last_date", min_horizon)
    return bounds.where(s <= e).withColumn(
        "cutoff_date", F.explode(F.sequence(s, e, F.expr(f"INTERVAL {step_days} DAYS")))
    )


def cutoff_spine(df: DataFrame, keys: list[str] = GROUP_KEYS, horizons: list[int] | None = HORIZONS) -> DataFrame:
    """(campaign, cutoff, horizon) candidates before the future-data filters.

    Without ``horizons`` one row for each campaign and cutoff: they are distinct as they come, one
    campaign having one row of bounds.
    """
    b = spine_dates(campaign_bounds(daily(df, keys), keys)).select(*keys, "cutoff_date")
    return b if horizons is None else b.select("*", F.explode(F.array(*[F.lit(h) for h in horizons])).alias("forecast_window_days"))


# --------------------------------------------------------------------------- columns
def _trend_columns() -> list[Column]:
    return [
        safe_divide(F.col("hist_7d_spend") / 7, F.col("hist_30d_spend") / 30).alias("spend_trend_7d_vs_30d"),
        safe_divide(F.col("hist_7d_revenue") / 7, F.col("hist_30d_revenue") / 30).alias("revenue_trend_7d_vs_30d"),
        safe_divide("hist_7d_roas", "hist_30d_roas").alias("roas_trend_7d_vs_30d"),
    ]


def _id_columns(mode: str) -> list[Column]:
    h = F.col("forecast_window_days")
    start = F.date_add("cutoff_date", 1)
    return [
        F.concat_ws("_", F.lit(mode), F.coalesce(F.col("channel"), F.lit(NULL_TEXT)),
                    F.coalesce(F.col("campaign_id"), F.lit(NULL_TEXT)), h.cast("string"),
                    F.col("cutoff_date").cast("string")).alias("forecast_id"),
        F.lit(mode).alias("mode"),
        F.lit("campaign").alias("forecast_level"),
        *[F.col(k) for k in GROUP_KEYS],
        F.col("cutoff_date"),
        start.alias("forecast_start_date"),
        F.date_add("cutoff_date", h).alias("forecast_end_date"),
        h.cast("int").alias("forecast_window_days"),
        (F.datediff("cutoff_date", "first_date") + 1).cast("int").alias("campaign_age_days"),
        F.month(start).cast("int").alias("forecast_month"),
        F.quarter(start).cast("int").alias("forecast_quarter"),
        F.year(start).cast("int").alias("forecast_year"),
    ]


def estimated_future_budget(h: Column) -> Column:
    """Recent mean daily budget x horizon, else recent spend per active day x horizon."""
    per_day_spend = safe_divide("hist_30d_spend", F.greatest(F.col("hist_30d_active_days"), F.lit(1)))
    return (
        F.when(F.col("hist_30d_avg_daily_budget") > 0, F.col("hist_30d_avg_daily_budget") * h)
        .otherwise(per_day_spend * h)
    )


# --------------------------------------------------------------------------- prediction set
def prediction_set(df: DataFrame, keys: list[str] = GROUP_KEYS, check_empty: bool = False) -> DataFrame:
    """One row per campaign and horizon, cut off at the campaign's own last date.

    One shuffle of the daily rows by campaign: a partition-wide window gives
    first/last dates, then conditional sums over the last 90 days aggregate in
    the same stage (the hash partitioning on the keys is reused).
    """
    d = daily(df, keys)
    whole = Window.partitionBy(*keys)
    d = d.withColumns({"first_date": F.min("date").over(whole), "last_date": F.max("date").over(whole)})
    d = d.where(F.col("date") >= F.date_sub("last_date", max(WINDOWS) - 1))
    aggs: list[Column] = [F.min("first_date").alias("first_date"), F.max("last_date").alias("cutoff_date")]
    for w in WINDOWS:
        inside = f"date >= date_sub(last_date, {w - 1})"
        aggs.append(F.expr(f"count_if({inside}) AS _d{w}"))
        aggs += [F.expr(f"sum(CASE WHEN {inside} THEN {c} ELSE 0 END) AS {out}{w}")
                 for c, out in [("n", "_r"), *[(p, f"_{p}") for p in _PARTS]]]
    g = d.groupBy(*keys).agg(*aggs)
    hist: list[Column] = []
    for w in WINDOWS:
        hist += _period_metrics(f"hist_{w}d", f"_r{w}", f"_d{w}",
                                _values(lambda c, k: f"_{c}_{k}{w}"))
    g = g.select(*keys, "first_date", "cutoff_date", *hist)
    g = g.select("*", *_trend_columns())
    g = g.withColumn("forecast_window_days", F.explode(F.array(*[F.lit(h) for h in HORIZONS])))
    h = F.col("forecast_window_days")
    fb = estimated_future_budget(h)
    g = g.withColumns({"future_budget": fb})
    g = g.withColumn("future_budget_per_day", safe_divide("future_budget", h))
    out = g.select(*_id_columns("predict"), *HIST_COLUMNS, *TREND_COLUMNS, *BUDGET_COLUMNS)
    if check_empty and df.isEmpty():      # without dated rows there is no campaign to predict
        raise ValueError("No campaign has a dated row, so there is nothing to predict.")
    return out


# --------------------------------------------------------------------------- training set
def _framed(d: DataFrame, keys: list[str]) -> DataFrame:
    """Every trailing and leading frame at the spine rows, from running sums of daily rows plus spine rows.

    A frame is the difference of two running sums, one up to each of its edges: whole numbers, so
    nothing is lost, and a row is added nine times instead of once for each day of each frame.
    Days that a long does not hold (``join_parts``) are rare and added up frame by frame, in date order.

    First/last dates come from a partition-wide window over the daily rows;
    each campaign's first-date row then also emits that campaign's spine rows
    (a ``posexplode`` of day numbers, zero measures).  One branch, one scan, and the
    campaign partitioning carries into the frame pass with no further shuffle.
    Both windows want the rows in date order, so the second sort finds them almost sorted.
    """
    whole = Window.partitionBy(*keys).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = d.withColumns({"first_date": F.min("date").over(whole), "last_date": F.max("date").over(whole)}).withColumn("_i", F.unix_date("date"))
    s, e = f"unix_date(first_date) + {MIN_HISTORY_DAYS - 1}", f"unix_date(last_date) - {min(HORIZONS)}"
    # whole expressions, no lambda: this step is compiled
    days = F.expr(f"concat(array(_i), CASE WHEN date = first_date AND {s} <= {e} THEN sequence({s}, {e}, {STEP_DAYS}) ELSE CAST(array() AS ARRAY<INT>) END)")
    large = " OR ".join(f"{c}_x <> 0D" for c in _SUMMED)
    held = ", ".join(["_i", *[f"{c}_x" for c in _SUMMED]])
    terms = {"nh": f"n * {1 << _DAYS}L + has", **{f"{c}_h": f"shiftright({c}_u, {_SHIFT})" for c in _SUMMED}}
    terms |= {f"{a}_l": f"({a}_u & {(1 << _SHIFT) - 1}L) + ({b}_u & {(1 << _SHIFT) - 1}L) * {1 << _LOW}L" for a, b in _PAIRS}
    d = d.select(*keys, "first_date", "last_date", *[F.expr(f"{text} AS {name}") for name, text in terms.items()],
                 F.expr(f"CASE WHEN {large} THEN struct({held}) END AS _x"), F.posexplode(days).alias("_cut", "_i"))
    u = d.select(*keys, "first_date", "last_date", "_cut", "_i", F.expr("CASE WHEN _cut = 0 THEN _x END AS _x"),
                 *[F.expr(f"CASE WHEN _cut = 0 THEN {m} ELSE 0L END AS {m}") for m in terms])
    base = Window.partitionBy(*keys).orderBy("_i")
    running = {f"_upto{name}_{at}": F.sum(name).over(base.rangeBetween(Window.unboundedPreceding, days))
               for at, days in _EDGES.items() for name in terms}
    running["_large"] = F.collect_list("_x").over(base.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    cut = u.withColumns(running).where("_cut > 0").withColumn("date", F.expr("date_from_unix_date(_i)"))
    # the few days of the campaign that a long does not hold, near this cutoff
    cut = cut.withColumn("_large", F.expr(f"CASE WHEN size(_large) > 0 THEN filter(_large, d -> d._i > _i - {max(WINDOWS)} AND d._i <= _i + {max(HORIZONS)}) END"))
    frames = [("_", f"b{w}", "c", w, f"d._i > _i - {w} AND d._i <= _i") for w in WINDOWS]
    frames += [("_f", "c", f"f{h}", h, f"d._i > _i AND d._i <= _i + {h}") for h in HORIZONS]
    cols: list[str] = []
    for out, low, high, days, inside in frames:
        def between(name):
            return f"(coalesce(_upto{name}_{high}, 0L) - coalesce(_upto{name}_{low}, 0L))"

        cols += [f"shiftright({between('nh')}, {_DAYS}) AS {out}r{days}", f"{between('nh')} & {(1 << _DAYS) - 1}L AS {out}d{days}"]
        lows = {a: f"({between(a + '_l')} & {(1 << _LOW) - 1}L)" for a, _ in _PAIRS} | {b: f"shiftright({between(a + '_l')}, {_LOW})" for a, b in _PAIRS}
        for c in _SUMMED:
            cols.append(f"{between(c + '_h')} * {1 << _SHIFT}L + {lows[c]} AS {out}{c}_u{days}")
            cols.append(f"CASE WHEN size(_large) > 0 THEN aggregate(filter(_large, d -> {inside}), 0D, (s, d) -> s + d.{c}_x) ELSE 0D END AS {out}{c}_x{days}")
    return cut.selectExpr(*[f"`{k}`" for k in keys], "date", "first_date", "last_date", *cols)


def spine_features(df: DataFrame, keys: list[str] = GROUP_KEYS) -> DataFrame:
    """Trailing-window and trend columns at every spine cutoff of every campaign."""
    f = _framed(daily(df, keys), keys)
    hist: list[Column] = []
    for w in WINDOWS:
        hist += _period_metrics(f"hist_{w}d", f"_r{w}", f"_d{w}",
                                _values(lambda c, k: f"_{c}_{k}{w}"))
    out = f.select(*keys, F.col("date").alias("cutoff_date"), "first_date", "last_date", *hist)
    return out.select("*", *_trend_columns())


def training_set(df: DataFrame, keys: list[str] = GROUP_KEYS, check_empty: bool = False) -> DataFrame:
    """Features and future targets for every (campaign, cutoff, horizon) whose
    horizon ends by the campaign's last date and holds at least one row."""
    f = _framed(daily(df, keys), keys)
    t = f.select("*", F.explode(F.array(*[F.lit(h) for h in HORIZONS])).alias("forecast_window_days"))

    def at_horizon(text) -> str:
        return f"CASE {' '.join(f'WHEN forecast_window_days = {h} THEN {text(h)}' for h in HORIZONS)} END"

    future = {c: at_horizon(lambda h: _values(lambda m, k: f"_f{m}_{k}{h}")[c]) for c in _SUMMED}
    n = at_horizon(lambda h: f"_fr{h}")
    t = t.where(F.expr(f"date_add(date, forecast_window_days) <= last_date AND {n} > 0")).withColumnRenamed("date", "cutoff_date")
    # all wide columns come from one projection
    hist: list[Column] = []
    past = {}
    for w in WINDOWS:
        past[w] = _values(lambda c, k: f"_{c}_{k}{w}")
        hist += _period_metrics(f"hist_{w}d", f"_r{w}", f"_d{w}", past[w])
    week, month = ({**past[w], "roas": divide_sql(past[w]["revenue"], past[w]["spend"])} for w in (7, 30))
    trends = [divide_sql(f"({week['spend']} / 7)", f"({month['spend']} / 30)"),
              divide_sql(f"({week['revenue']} / 7)", f"({month['revenue']} / 30)"), divide_sql(week["roas"], month["roas"])]
    mean_budget_x_h = f"({future['budget']} / {n} * forecast_window_days)"
    budget = f"(CASE WHEN {mean_budget_x_h} <= 0 THEN {future['spend']} ELSE {mean_budget_x_h} END)"
    wide = dict(zip(TREND_COLUMNS, trends))
    wide |= {"future_budget": budget, "future_budget_per_day": divide_sql(budget, "forecast_window_days")}
    wide |= {f"target_future_{c}": future[c] for c in SUMS}
    wide["target_future_roas"] = divide_sql(future["revenue"], future["spend"])
    out = t.select(*_id_columns("train"), *hist, *[F.expr(f"{wide[c]} AS {c}") for c in [*TREND_COLUMNS, *BUDGET_COLUMNS, *TARGET_COLUMNS]])
    if check_empty and out.isEmpty():
        raise ValueError("Training feature dataset is empty. "
                         "Check if campaigns have enough date history for 30/60/90 day forecasting.")
    return out


def asof_latest(df: DataFrame, probes: DataFrame, keys: list[str] = GROUP_KEYS,
                probe_date: str = "cutoff_date") -> DataFrame:
    """As-of join: for each probe (campaign, date) the latest daily row on or before it.

    Expressed as a union and one ordered window (no range join): probes and
    daily rows share the campaign partition; ``last(..., ignorenulls)`` over the
    running frame carries the latest data row forward to each probe.
    """
    d = daily(df, keys)
    p = probes.select(*keys, F.col(probe_date).alias("date")).withColumn("_probe", F.lit(1))
    rows = d.select(*keys, "date", "n", *_PARTS).withColumn("_probe", F.lit(0))
    u = rows.unionByName(p, allowMissingColumns=True).withColumn("_i", F.unix_date("date"))
    run = Window.partitionBy(*keys).orderBy("_i", "_probe").rowsBetween(Window.unboundedPreceding, 0)
    is_row = F.col("_probe") == 0
    latest = {
        "latest_date": F.last(F.when(is_row, F.col("date")), ignorenulls=True).over(run),
        "latest_rows": F.last(F.when(is_row, F.col("n")), ignorenulls=True).over(run),
        **{f"latest_{c}": F.last(F.when(is_row, F.expr(units_sql(f"{c}_u", f"{c}_x"))), ignorenulls=True).over(run)
           for c in ("spend", "revenue")},
    }
    out = u.withColumns(latest).where(F.col("_probe") == 1)
    return out.select(*keys, F.col("date").alias(probe_date), *latest.keys())
