"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "unified_campaigns",   # scan + normalise the three exports
    "dq_report",           # one-pass audit + duplicate keys
    "training_set",        # daily pre-agg + spine + single window pass
    "prediction_set",      # per-campaign conditional sums
    "forecast_table",      # scoring + grouping-sets roll-up
    "scenario_comparison", # baseline + scenario scored together, null-safe join
    "insights_table",      # report layer
    "risk_watchlist",      # ordered top-k
    "fit_quantile_models", # the whole model fit at its default rounds
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from roasline.session import get_spark
    from roasline.plans.registry import QUERIES

    spark = get_spark(f"local[{cpus}]", app="roasline-bench",
                      **{"spark.sql.shuffle.partitions": str(max(8, int(cpus)))})
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    # warm-up: JVM, parquet footers, Python workers
    QUERIES["dated_rows"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
