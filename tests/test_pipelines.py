"""Outputs are written in their presentation order."""

import os
import tempfile

from roasline.operators import scoring as P
from roasline.plans import pipelines
from roasline.operators import normalize as N
from roasline.sources.fixtures import raw_exports

from conftest import SF_SMALL


def test_forecast_is_written_in_order(spark):
    forecast = pipelines.predict(N.normalize_all(raw_exports(spark, SF_SMALL)), P.linear_rule_scorer, cache=False)
    out = tempfile.mkdtemp(prefix="roasline-out-", dir=os.environ.get("TMPDIR", "/tmp"))
    pipelines.write_outputs({"forecast": forecast}, out)
    back = [(r.forecast_window_days, r.forecast_level) for r in spark.read.parquet(f"{out}/forecast").collect()]
    assert back == sorted(back) and len(back) > 0
