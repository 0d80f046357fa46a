"""The normalisers on a file stream give the same rows as the batch path."""

import os
import tempfile

from roasline.operators import normalize as N
from roasline.sources.fixtures import raw_exports
from roasline.streaming import ingest

from conftest import SF_SMALL


def test_stream_ingest_matches_batch(spark):
    raw = raw_exports(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="roasline-stream-", dir=os.environ.get("TMPDIR", "/tmp"))
    paths = {}
    for p, df in raw.items():
        paths[p] = f"{d}/in_{p}"
        df.repartition(3).write.option("header", True).csv(paths[p])
    q = ingest.start_ingest(ingest.normalized_stream(spark, paths), f"{d}/unified", f"{d}/ckpt")
    q.awaitTermination(300)
    streamed = spark.read.parquet(f"{d}/unified")
    batch = N.normalize_all(raw)
    cols = batch.columns
    a = sorted((tuple(r) for r in streamed.select(*cols).collect()), key=repr)
    b = sorted((tuple(r) for r in batch.collect()), key=repr)
    assert a == b
